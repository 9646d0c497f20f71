"""Operators against brute force on whole small tables and on awkward rows."""

import itertools
import random

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from casebook.llm import (jaccard_join, language_id, licenses, packing, piece_lattice, quality, substring_dedup,
                          suffix_dedup, token_files, tokens, topk)
from casebook.session import ship_package
from tests.llm import brute

SF = "/root/testdata/sf0.001"
BPE = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def lab(spark):
    ship_package(spark)
    return spark


def awkward():
    rng = random.Random(5)
    word = lambda: "".join(rng.choice("abcdefghij") for _ in range(rng.randint(1, 7)))
    base = [word() for _ in range(400)]
    near = base[:]
    near[200] = "Changed"
    passage = " ".join(base[100:170])
    texts = [None, "", " \n\t ", "one", "One two three", "one TWO three", " ".join(base), " ".join(base), " ".join(near),
             "\n".join(base), passage + " tail", "head " + passage, "same " * 300, "same " * 280, "é ß 中 " * 120,
             " ".join(word() for _ in range(20_000)), "x" * 5000, "x" * 5000 + " y", "Kurz und gut, sagt man hier."]
    return list(enumerate(texts))


def rows_of(spark, rows):
    """With an extra column whose name clashes with names that the operators use inside."""
    return spark.createDataFrame([(d, t, "a", 1) for d, t in rows], "doc_id long, text string, bucket string, rep int")


@pytest.fixture(scope="module")
def corpus(lab):
    got = lab.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text")
    return got, [(r.doc_id, r.text) for r in got.collect()]


def both(lab, corpus):
    return [(rows_of(lab, awkward()), awkward()), corpus]


def test_substring_dedup(lab, corpus):
    for docs, rows in both(lab, corpus):
        got = {r.doc_id: (r.n_words, r.n_removed, r.kept) for r in substring_dedup.remove_repeats(docs).collect()}
        assert got == brute.repeated_windows(rows)


def test_anchors_are_told_apart_by_bucket():
    """A run that has only the low bits of a mark is no anchor."""
    text = " ".join(f"w{i}" for i in range(60)).encode()
    off, data = substring_dedup.utf8(pa.array([text], pa.binary()))
    _, _, _, hashes, at, _ = substring_dedup._runs(off, data, 50, 25)
    code = int(hashes(at, at + 25)[5])
    emit = substring_dedup._emit_windows(50, 25, 1 << 20)
    for bucket, found in (((code >> 32) % (1 << 20), True), (((code >> 32) + 1) % (1 << 20), False)):
        marks = np.array([bucket, code & 0xFFFFFFFF], dtype=np.uint32).tobytes()
        rows = pa.RecordBatch.from_arrays([pa.array([1], pa.int64()), pa.array([substring_dedup.X.squeeze(text)], pa.binary()),
                                           pa.array([[marks]], pa.list_(pa.binary()))], names=["doc_id", "ztext", "marks"])
        assert any(b.num_rows for b in emit(iter([rows]))) == found


def test_suffix_dedup(lab, corpus):
    for docs, rows in both(lab, corpus):
        got = {r.doc_id: (r.n_bytes, r.n_removed, len(r.starts), bytes(r.kept))
               for r in suffix_dedup.remove_repeated_bytes(docs).collect()}
        assert got == brute.repeated_bytes(rows)


@pytest.mark.parametrize("depth", [7, 40, 43, 400])
def test_suffix_refinement_at_passage_edges(lab, depth):
    """Passages a little shorter and longer than the depth, between other bytes, with equal grams everywhere."""
    rng = random.Random(depth)
    noise = lambda n: "".join(rng.choice("abcdefghij klmnop\u00e9") for _ in range(n))
    common = noise(60 if depth >= 400 else 6)
    passages = [noise(depth + k - 20 if depth > 20 else depth - 2 + k % 5) for k in range(0, 44, 4)]
    rows = []
    for d in range(60):
        parts = [rng.choice([noise(rng.randrange(depth)), common, rng.choice(passages), "aa" * rng.randrange(depth)])
                 for _ in range(8)]
        rows.append((d, "".join(parts)))
    rows += [(60, rows[3][1]), (61, rows[3][1] + "x"), (62, rows[5][1][1:]), (63, None), (64, "")]
    got = {r.doc_id: (r.n_bytes, r.n_removed, len(r.starts), bytes(r.kept))
           for r in suffix_dedup.remove_repeated_bytes(rows_of(lab, rows), depth=depth).collect()}
    assert got == brute.repeated_bytes(rows, depth)


def test_jaccard_components(lab, corpus):
    for docs, rows in both(lab, corpus):
        got = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard_join.jaccard_components(docs).collect()}
        assert got == brute.components(rows)


def test_jaccard_links_are_whole_degrees(lab, corpus):
    """Every link between different sets counts, also inside a component that is connected already."""
    rng = random.Random(8)
    base = [f"v{rng.randrange(10 ** 6)}" for _ in range(300)]
    group = [(k, " ".join([*base[:5 * k], f"other{k}", *base[5 * k + 1:]])) for k in range(40)]
    for docs, rows in [(rows_of(lab, group), group), *both(lab, corpus)]:
        sets = brute.shingle_sets(rows)
        distinct = {frozenset(s) for s in sets.values() if s}
        degree = {s: sum(s != t and 100 * len(s & t) >= 80 * len(s | t) for t in distinct) for s in distinct}
        got = {r.doc_id: r.n_links for r in jaccard_join.jaccard_components(docs).collect()}
        assert got == {d: degree.get(frozenset(s), 0) for d, s in sets.items()}


def test_jaccard_with_too_few_segments(lab, monkeypatch):
    """Sets whose shingles fall into too few segments are run again with another partition."""
    rows = [(k, " ".join(f"w{k // 2}x{i}" for i in range(12)) + f" e{k % 2}") for k in range(40)]
    calls = []
    emit = jaccard_join._emit

    def few(shingle, percent, n, seed, only):
        calls.append(seed)
        return emit(shingle, percent, n, seed, only)

    short = jaccard_join._short
    monkeypatch.setattr(jaccard_join, "_emit", few)
    monkeypatch.setattr(jaccard_join, "_short", lambda index, percent, only=None: (
        [jaccard_join.band_of(9, percent)] if only is None else short(index, percent, only)))
    got = {r.doc_id: (r.n_shingles, r.component_id)
           for r in jaccard_join.jaccard_components(rows_of(lab, rows)).collect()}
    assert got == brute.components(rows) and calls == [0, 1]


def test_parity_sketch_bounds_the_difference():
    rng = np.random.default_rng(3)
    for n in (5, 90, 700):
        u = np.unique(rng.integers(0, 1 << 62, n).astype(np.uint64))
        v = np.unique(np.r_[u[n // 5:], rng.integers(0, 1 << 62, n // 6).astype(np.uint64)])
        a, b = (np.frombuffer(jaccard_join.sketch(x, 80), dtype=np.uint8) for x in (u, v))
        while len(a) != len(b):
            a, b = (x[:len(x) // 2] ^ x[len(x) // 2:] if len(x) > min(len(a), len(b)) else x for x in (a, b))
        assert np.bitwise_count(a ^ b).sum() <= len(np.setxor1d(u, v))


def test_quality_counts_and_verdicts(lab, corpus):
    docs = rows_of(lab, awkward())
    got = docs.select("doc_id", quality.rule_counts(F.col("text")).alias("c")).collect()
    for r in got:
        assert tuple(r.c)[:5] == brute.rule_counts(dict(awkward())[r.doc_id])
    labels = lab.read.parquet(f"{SF}/labels.parquet")
    forest = quality.fit(corpus[0], labels)
    judged = quality.judge(corpus[0], forest, "rules").join(labels, "doc_id").select(
        "rules.*", F.col("quality").alias("q"), "doc_id")
    rows = judged.collect()
    texts = dict(corpus[1])
    for r in rows:
        w = brute.rule_counts(texts[r.doc_id])
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == w
        assert r.base_failed == (w[0] < 50 or 100 * w[4] > 50 * w[0])
    soft = [r for r in rows if not r.base_failed]
    assert np.mean([r.kept for r in soft if r.q == 1]) >= 0.97
    assert np.mean([r.kept for r in soft if r.q == 0]) <= 0.2


def test_quality_without_labels(lab):
    docs = rows_of(lab, awkward())
    forest = quality.fit(docs, lab.createDataFrame([], "doc_id long, quality int"))
    assert all(r.kept != r.base_failed for r in quality.judge(docs, forest).select("quality.*").collect())


def test_quality_learns_from_every_labelled_row(lab):
    """Statistics' weights and the threshold equal those of all rows, repeated ones included, and trees draw from all."""
    rng = random.Random(3)
    rows = []
    for d in range(6600):
        bad = d % 11 == 0
        text = " ".join(f"w{rng.randint(0, 10 ** 6)}" + "#!" * (rng.random() < (0.4 if bad else 0.03)) for _ in range(60))
        rows.append((d, text, 0 if bad else 1))
    rows += [rows[5]] * 40 + [(None, "no id " * 40, 0), (7000, None, 1), (7001, "short", 0)]
    docs = lab.createDataFrame([r[:2] for r in rows], "doc_id long, text string").repartition(7)
    labels = lab.createDataFrame([(d, q) for d, _, q in rows] + [(8000, 0), (3, None)], "doc_id long, quality int")
    forest = quality.fit(docs, labels)
    used = [r for r in rows if r[0] is not None and r[0] < 7000]
    table = np.array([quality.counts(*quality.utf8(pa.array([r[1]])))[0] for r in used])
    x, good = quality.features(table), np.array([r[2] == 1 for r in used])
    s = forest.scores(x)
    floor = np.quantile(s[good], quality.KEEP)
    choices = np.unique(np.r_[floor, s[good].max(), s[~good & (s >= floor)]])
    gains = [(s[~good] > t).mean() - (s[good] > t).mean() for t in choices]
    assert max(gains) > 0.5 and forest.threshold == pytest.approx(choices[int(np.argmax(gains))], abs=1e-12)
    learned = quality._labelled(docs, labels)
    for k, w in enumerate(quality.separation(learned)):
        higher = sum((x[good, k] < v).sum() + (x[good, k] == v).sum() / 2 for v in x[~good, k])
        assert w == pytest.approx((2 * higher / ((~good).sum() * good.sum()) - 1) ** 2, abs=1e-12)
    drawn = quality.draw(learned)
    assert len(drawn) == quality.TREES and all(len(t) == quality.SUBSAMPLE for t in drawn)
    assert len(np.unique(np.concatenate(drawn), axis=0)) > 0.6 * len(np.unique(x, axis=0))
    again = quality.draw(quality._labelled(docs.repartition(2), labels))
    assert all(np.array_equal(a, b) for a, b in zip(drawn, again, strict=True))


def test_language_id(lab):
    docs = lab.read.parquet("/root/testdata/sf0.01/documents.parquet")
    held = language_id.held_out(F.col("doc_id"))
    model = language_id.fit(docs.filter(~held))
    rows = language_id.predict(docs.filter(held), model).select("lang", "language.*").collect()
    assert np.mean([r.lang == r.lang_pred for r in rows]) > 0.98
    assert all(0 <= r.score <= 1 for r in rows)
    odd = language_id.predict(rows_of(lab, [(1, None), (2, ""), (3, "123 !?"), (4, "a")]), model)
    assert [r.lang_pred == "und" for r in odd.orderBy("doc_id").select("language.*").collect()] == [True, True, True, False]
    empty = language_id.fit(docs.filter("false"))
    assert {r.lang_pred for r in language_id.predict(docs, empty).select("language.*").collect()} == {"und"}


def test_codewords_are_apart():
    for n in (2, 4, 6, 9, 30):
        code = language_id.codewords(n)
        assert min((code[a] != code[b]).sum() for a, b in itertools.combinations(range(n), 2)) >= code.shape[1] // 4 + (n == 2)


def test_top_k(lab):
    v = lab.read.parquet(f"{SF}/embeddings.parquet").select("vec_id", "embedding")
    extra = lab.createDataFrame([(10_000, None), (10_001, [1.0, None]), (10_002, [float("nan")] * 64), (10_003, [1.0])],
                                "vec_id long, embedding array<double>")
    rows = {r.vec_id: np.floor(1024 * np.array(r.embedding, dtype=float)).astype(int) for r in v.collect()}
    table = v.select("vec_id", F.col("embedding").cast("array<double>").alias("embedding")).unionByName(extra)
    got = sorted(tuple(r) for r in topk.top_k(table, table.filter("vec_id % 100 = 0")).collect())
    want = []
    for q in (k for k in rows if k % 100 == 0):
        best = sorted((-int(rows[q] @ x), k) for k, x in rows.items() if k != q)[:10]
        want += [(q, n + 1, k, -s) for n, (s, k) in enumerate(best)]
    assert got == sorted(want)


def test_top_k_ties_and_few(lab):
    rows = [(k, [float(k % 3), 1.0]) for k in range(30)]
    v = lab.createDataFrame(rows, "vec_id long, embedding array<double>")
    for k in (3, 40):
        got = sorted(tuple(r) for r in topk.top_k(v, v.filter("vec_id = 4"), k=k).collect())
        best = sorted((-int(1024 * 1024 * (1 * (i % 3) + 1)), i) for i in range(30) if i != 4)[:k]
        assert got == [(4, n + 1, i, -s) for n, (s, i) in enumerate(best)]
    assert topk.top_k(v.filter("false"), v).isEmpty()


def test_ids_equal_the_library():
    from tokenizers import Tokenizer
    t, e, rng = Tokenizer.from_file(BPE), tokens.encoder(BPE), random.Random(2)
    parts = ["a", "bé", "'", "s", "'ll", "ve", " ", "  ", "\n", "\t", "12", "!.", "×", "中", "\xa0", "\x1c", "<|endoftext|>"]
    texts = ["".join(rng.choice(parts) for _ in range(rng.randint(0, 14))) for _ in range(3000)] + ["", "word " * 5000]
    ids, off = e(pa.array([*texts, None]))
    assert [ids[a:b].tolist() for a, b in zip(off[:-1], off[1:])] == [
        x.ids for x in t.encode_batch([*texts, ""], add_special_tokens=False)]


@pytest.mark.parametrize("capacity", [8, 2048])
def test_packing(lab, corpus, capacity):
    for docs, rows in both(lab, corpus)[:1 if capacity == 8 else 2]:
        got = packing.pack(docs, BPE, capacity=capacity).collect()
        ids, off = tokens.encoder(BPE)(pa.array([t for _, t in rows], pa.string()))
        want = {d: int(n) + 1 for (d, _), n in zip(rows, np.diff(off), strict=True)}
        bins, by_doc = {}, {}
        for r in got:
            by_doc.setdefault(r.doc_id, []).append(r)
            bins.setdefault(r.sequence_id, []).append((r.offset, r.length))
        for d, n in want.items():
            p = sorted(by_doc[d], key=lambda r: r.piece)
            assert [r.start for r in p] == np.r_[0, np.cumsum([r.length for r in p])[:-1]].tolist()
            assert sum(r.length for r in p) == n and all(r.length == capacity for r in p[1:])
            assert n > capacity or len(p) == 1
        for items in bins.values():
            end = 0
            for at, n in sorted(items):
                assert at == end
                end += n
            assert end <= capacity
        assert len(bins) <= 1.02 * -(-sum(want.values()) // capacity) + 1


def test_fullest_combination():
    rng = random.Random(1)
    for _ in range(60):
        counts = {rng.randint(1, 12): rng.randint(1, 2) for _ in range(4)}
        room = rng.randint(1, 30)
        items = [x for x, n in counts.items() for _ in range(n)]
        best = max(s for k in range(len(items) + 1) for c in itertools.combinations(items, k) if (s := sum(c)) <= room)
        got = packing.fullest(counts, room)
        assert sum(x * n for x, n in got.items()) == best and all(n <= counts[x] for x, n in got.items())


def test_token_files(lab, corpus, tmp_path):
    for k, (docs, rows) in enumerate(both(lab, corpus)):
        token_files.write(docs, BPE, f"file://{tmp_path}/{k}")
        back = sorted(token_files.read(lab, f"file://{tmp_path}/{k}").collect(), key=lambda r: r.doc_id)
        ids, off = tokens.encoder(BPE)(pa.array([t for _, t in rows], pa.string()))
        want = {d: [*ids[a:b].tolist(), 2] for (d, _), a, b in zip(rows, off[:-1], off[1:], strict=True)}
        start = 0
        for r in back:
            assert np.frombuffer(r.ids, dtype="<u4").tolist() == want[r.doc_id] and r.start == start
            start += r.n_tokens
        assert len(back) == len(rows)


def test_one_document_of_a_shard():
    import hashlib
    import zstandard
    raw = [np.arange(n, dtype="<u4").tobytes() for n in (3, 0, 500)]
    frames = [zstandard.ZstdCompressor().compress(x) for x in raw]
    blob = token_files.shard([1, None, 9], [3, 0, 500], frames, hashlib.sha256(b"").digest())
    assert token_files.document(blob, 2, b"").tobytes() == raw[2]
    with pytest.raises(ValueError):
        token_files.document(blob, 2, b"other")


def test_licenses(lab):
    rows = [(1, "a/b/x.txt", "text\nLicensed under CC BY-NC 4.0.\nmore"), (2, "a/b/c/y.txt", "nothing"), (3, "a/z.txt", "no"),
            (4, "q/LICENSE", "Released under the\nMIT License."), (5, "q/r/s.txt", None), (6, None, "Released under the MIT License."),
            (7, "a/b/c/d/e.txt", ""), (8, "x.txt", "the license of a work is to be under the version")]
    docs = lab.createDataFrame(rows, "doc_id long, path string, text string")
    got = {r.doc_id: (r.license, r.licensed_by) for r in licenses.scan(docs, gives=F.lit(True)).collect()}
    assert got == {1: ("CC-BY-NC-4.0", None), 2: ("CC-BY-NC-4.0", "a/b"), 3: (None, None), 4: ("MIT", None),
                   5: ("MIT", "q"), 6: ("MIT", None), 7: ("CC-BY-NC-4.0", "a/b"), 8: (None, None)}


def plain_cosines(text, path=""):
    """Best (cosine, license) of a text, by the definitions, without Spark."""
    import collections
    import math
    import re
    cut = lambda t: [w for w in re.split(r"[^\w]+|_", t.lower()) if w]
    forms = [(n, collections.Counter(cut(t))) for n, t in licenses.TEMPLATES]
    df = collections.Counter(w for _, c in forms for w in c)
    idf = lambda w: math.log((len(forms) + 1) / (df[w] + 1)) + 1
    vector = lambda c: {w: n * idf(w) for w, n in c.items()}
    length = lambda v: math.sqrt(sum(x * x for x in v.values()))
    bare = re.sub(r"(?m)^[ \t]*(?:/\*+|\*+/?|//+|#+|--+|;+|%+|<!--|REM\b|dnl\b)?[ \t]*", "", text)
    paragraphs = re.split(r"\n\s*\n", bare)
    units = bare.split("\n") + paragraphs + [s for p in paragraphs for s in re.split(r"(?<=[.!?;])\s+", re.sub(r"\s+", " ", p))]
    if re.search(licenses.LICENSE_FILE, path):
        units.append(bare)
    best = (0, None)
    for u in units:
        if re.search(licenses.ANCHOR, u):
            v = vector(collections.Counter(cut(u)))
            for name, c in forms:
                t = vector(c)
                best = max(best, (round(sum(x * t.get(w, 0) for w, x in v.items()) / length(v) / length(t), 6), name),
                           key=lambda x: x[0])
    return best


def real_licenses():
    """Usual license files and headers: (path, text, license)."""
    by_name = {}
    for name, text in licenses.TEMPLATES:
        by_name.setdefault(name, []).append(text)
    whole = lambda name: max(by_name[name], key=len)
    head = next(t for t in by_name["Apache-2.0"] if "you may not use this file" in t)
    gnu = next(t for t in by_name["GPL-3.0"] if "redistribute" in t)
    wrap = lambda t, lead, n=60: "\n".join(lead + x for x in __import__("textwrap").wrap(t, n))
    return [
        ("a/LICENSE", "MIT License\n\nCopyright (c) 2020 Some One\n\n" + whole("MIT"), "MIT"),
        ("b/LICENSE.txt", "Copyright 2019 The Authors. All rights reserved.\n\n" + whole("BSD-3-Clause"), "BSD-3-Clause"),
        ("c/COPYING", "BSD 2-Clause License\n\nCopyright (c) 2001, X\n\n" + whole("BSD-2-Clause"), "BSD-2-Clause"),
        ("d/LICENSE", "Copyright (c) 4-digit year, Company or Person\n\n" + whole("ISC"), "ISC"),
        ("e/x.py", wrap(head, "# ") + "\nimport os\n", "Apache-2.0"),
        ("f/x.c", "/*\n" + wrap(gnu, " * ") + "\n *\n * more\n */\nint main() {}\n", "GPL-3.0"),
        ("g/x.rs", "// SPDX-License-Identifier: MPL-2.0\nfn main() {}", "MPL-2.0"),
        ("h/x.sh", "# SPDX-License-Identifier: GPL-2.0-or-later\n", "GPL-2.0"),
        ("i/x.md", "Plenty of words about nothing " * 60 + "and so on. Released under the MIT License. " + "More of it " * 90, "MIT"),
        ("j/COPYING", "                    GNU GENERAL PUBLIC LICENSE\n                       Version 3, 29 June 2007\n\n"
                      "Everyone is permitted to copy and distribute verbatim copies.\n\n" + "The licenses for most works. " * 50, "GPL-3.0"),
        ("k/x.md", "This work is licensed under a Creative Commons Attribution 4.0 International License.", "CC-BY-4.0"),
        ("l/x.md", "She had a driving licence and no permission to park. " * 20, None),
        ("m/x.md", "All rights reserved. Copyright by the house.", None),
        ("n/x.txt", "This is free and unencumbered software released into the public domain.", "Unlicense")]


def test_licenses_of_usual_files_and_headers(lab):
    rows = [(k, p, t, "clash") for k, (p, t, _) in enumerate(real_licenses())]
    docs = lab.createDataFrame(rows, "doc_id long, path string, text string, unit string")
    got = {r.doc_id: (r.license, r.cosine) for r in licenses.own_licenses(docs).collect()}
    assert {k: got.get(k, (None,))[0] for k in range(len(rows))} == {k: n for k, (_, _, n) in enumerate(real_licenses())}
    for k, path, text, _ in rows:
        cosine, name = plain_cosines(text, path)
        if "SPDX" not in text:
            assert (cosine >= licenses.LEAST) == (k in got)
            assert k not in got or got[k][1] == pytest.approx(cosine, abs=1e-6)


def test_licenses_of_long_texts_and_nothing(lab):
    docs = lab.createDataFrame([(1, "LICENSE", "license " + " ".join(f"w{i}" for i in range(60_000))), (2, "x", None),
                                (None, "y", "Released under the MIT License.")], "doc_id long, path string, text string")
    assert licenses.own_licenses(docs).collect() == []
    none = lab.createDataFrame([], "doc_id long, path string, text string")
    assert licenses.scan(none, gives=F.lit(True)).collect() == []


def test_cosines_of_the_query_against_plain_python(lab):
    from casebook.llm import catalogue
    docs = catalogue._paths(lab.read.parquet("/root/testdata/sf0.01/documents.parquet"))
    got = {r.doc_id: r.cosine for r in licenses.own_licenses(docs).collect()}
    rows = {r.doc_id: (r.text or "", r.path) for r in docs.collect()}
    assert len(got) > 30
    for d, (text, path) in rows.items():
        cosine, _ = plain_cosines(text, path)
        assert (d in got) == (cosine >= licenses.LEAST) and (d not in got or got[d] == pytest.approx(cosine, abs=1e-6))


def test_licenses_of_the_query_against_brute_force(lab):
    """Every file with a license of its own gives it, at several depths, license files too; the nearest one holds."""
    from casebook.llm import catalogue
    docs = catalogue._paths(lab.read.parquet("/root/testdata/sf0.01/documents.parquet"))
    paths = {r.doc_id: r.path for r in docs.collect()}
    own = {r.doc_id: (r.license, r.cosine) for r in licenses.own_licenses(docs).collect()}
    held = {}
    for d, (name, cosine) in own.items():
        home = paths[d].rpartition("/")[0]
        held[home] = min(held.get(home, (0, "")), (-cosine, name))
    want = {}
    for d, path in paths.items():
        at = path.rpartition("/")[0]
        while at and at not in held:
            at = at.rpartition("/")[0]
        want[d] = (path, own[d][0], None) if d in own else (path, held[at][1], at) if at in held else (path, None, None)
    got = {r.doc_id: (r.path, r.license, r.licensed_by)
           for r in catalogue.op2_license_scans(lab, "/root/testdata/sf0.01").collect()}
    assert got == want and len({p.count("/") for p in paths.values()}) == 4
    assert any(d % 10 for d in own) and len({x[2].count("/") for x in got.values() if x[2]}) > 1
    assert any("LICENSE" in p for p in paths.values()) and any("COPYING" in p for p in paths.values())


def test_licenses_run_no_python(lab):
    docs = lab.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text", F.lit("a/b").alias("path"))
    plan = licenses.scan(docs, gives=F.lit(True))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan


def viterbi(word, scores, least):
    best = {0: (0, 0, 0, [])}
    for end in range(1, len(word) + 1):
        ways = []
        for n in range(1, min(16, end) + 1):
            piece = word[end - n:end]
            s = scores.get(piece, least if n == 1 else None)
            if s is not None:
                t, c, _, p = best[end - n]
                ways.append((t + s, c - 1, n, [*p, piece]))
        best[end] = max(ways, key=lambda w: w[:3])
    return best[len(word)][3]


def test_packing_leaves_no_encoder_in_workers(lab):
    """Workers outlive a stage; what they keep adds to the memory of all later ones."""
    from casebook.llm import packing, tokens
    docs = lab.createDataFrame([(k, f"some text {k}") for k in range(64)], "doc_id long, text string").repartition(16)
    assert packing.pack(docs, public_tokenizers.path("byte_bpe_50k.json")).count() == 64

    def held(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array([tokens.encoder.cache_info().currsize], pa.int32())], names=["n"])
    assert sum(r.n for r in lab.range(0, 64, 1, 16).mapInArrow(held, "n int").collect()) == 0


def test_piece_lattice(lab):
    pieces = piece_lattice.piece_table(lab, public_tokenizers.path("piece_bpe_32k.model")).cache()
    rows = pieces.collect()
    normal = {r.piece: (r.id, r.score) for r in rows if r.kind == "normal"}
    bytes_ = {int(r.piece[1:-1], 16): r.id for r in rows if r.kind == "byte"}
    least = min(r.score for r in rows) - piece_lattice.PENALTY
    texts = ["", None, " ", "a  b", "\n\tx y\n", "中文字 ☃ Straße", "The license of the quick brown fox", "z" * 300, "same", "same"]
    coded = piece_lattice.encode(lab.createDataFrame([(t, 1) for t in texts], "text string, ids_of int"), pieces)
    out = piece_lattice.decode(coded, pieces).collect()
    assert len(out) == len(texts)
    import re
    for r in out:
        text = r.text or ""
        assert r.decoded == text
        marked = "▁" + text.replace(" ", "▁") if text else ""
        want = []
        for word in re.findall("[\x00-\x1f]|▁+[^▁\x00-\x1f]*|[^▁\x00-\x1f]+", marked):
            for piece in viterbi(word, {p: s for p, (_, s) in normal.items()}, least):
                want += [normal[piece][0]] if piece in normal else [bytes_[b] for b in piece.encode()]
        assert r.ids == want


def test_piece_lattice_folds_a_batch_like_one_word(lab, monkeypatch):
    """Paths of many lattices at once, ties included, equal those of a plain fold; words go to many partitions."""
    rng = random.Random(8)
    lattices, want = [], []
    for k in range(300):
        size = rng.randint(1, 9) if k else 0
        edges = [{"end": e, "n": n, "score": -rng.randint(1, 3), "id": None if n == 1 and rng.random() < 0.3 else rng.randint(0, 9)}
                 for e in range(1, size + 1) for n in range(1, e + 1) if n == 1 or rng.random() < 0.6]
        best = [((0, 0, 0, 0), [])]
        for e in range(1, size + 1):
            ways = [((best[e - x["n"]][0][0] + x["score"], best[e - x["n"]][0][1] - 1, x["n"], -1 if x["id"] is None else x["id"]), x)
                    for x in edges if x["end"] == e]
            key, x = max(ways, key=lambda w: w[0])
            best.append((key, best[e - x["n"]][1] + [{"id": x["id"], "at": e}]))
        rng.shuffle(edges)
        lattices.append(edges)
        want.append(best[-1][1])
    kind = pa.list_(pa.struct([("end", pa.int32()), ("n", pa.int32()), ("score", pa.int64()), ("id", pa.int32())]))
    column = pa.array(lattices, kind)
    assert piece_lattice._best_paths(column).to_pylist() == want
    assert piece_lattice._best_paths(column.slice(40, 7)).to_pylist() == want[40:47]
    assert piece_lattice._best_paths(column.slice(0, 0)).to_pylist() == []
    seen, plain = [], piece_lattice.encode_words
    monkeypatch.setattr(piece_lattice, "encode_words", lambda d, p: (seen.append(d.rdd.getNumPartitions()), plain(d, p))[1])
    pieces = piece_lattice.piece_table(lab, public_tokenizers.path("piece_bpe_32k.model"))
    piece_lattice.encode(lab.createDataFrame([("a few words",)], "text string"), pieces)
    assert seen == [piece_lattice.SHARE * int(lab.conf.get("spark.sql.shuffle.partitions"))]


def test_piece_lattice_of_long_words_and_clashing_columns(lab):
    import time
    pieces = piece_lattice.piece_table(lab, public_tokenizers.path("piece_bpe_32k.model")).cache()
    normal = {r.piece: (r.id, r.score) for r in pieces.collect() if r.kind == "normal"}
    bytes_ = {int(r.piece[1:-1], 16): r.id for r in pieces.collect() if r.kind == "byte"}
    least = min(r.score for r in pieces.collect()) - piece_lattice.PENALTY
    rng = random.Random(2)
    texts = ["".join(rng.choice("abcdefghé☃") for _ in range(n)) for n in (62, 63, 64, 65, 200, 300_000)]
    rows = lab.createDataFrame([(k, t, [1], "x") for k, t in enumerate(texts)], "k int, text string, ids array<int>, decoded string")
    began = time.time()
    got = {r.k: r for r in piece_lattice.decode(piece_lattice.encode(rows, pieces), pieces).collect()}
    assert time.time() - began < 90 and got[0].__fields__ == ["k", "text", "ids", "decoded"]
    for k, t in enumerate(texts):
        assert got[k].decoded == t
        if len(t) < 1000:
            want = []
            for piece in viterbi("▁" + t, {p: s for p, (_, s) in normal.items()}, least):
                want += [normal[piece][0]] if piece in normal else [bytes_[b] for b in piece.encode()]
            assert got[k].ids == want
    none = lab.createDataFrame([], "text string")
    assert piece_lattice.decode(piece_lattice.encode(none, pieces), pieces).collect() == []


def test_piece_lattice_asks_for_words_by_bucket(lab, monkeypatch):
    """Each distinct word is encoded once; slices ask in a row a bucket at most, not in a row a word."""
    tables, encoded, plain = [], [], piece_lattice.X.table
    monkeypatch.setattr(piece_lattice.X, "table", lambda df: (tables.append(plain(df)), tables[-1])[1])
    monkeypatch.setattr(piece_lattice, "encode_words", lambda d, p, f=piece_lattice.encode_words: (
        encoded.extend(r.word for r in d.collect()), f(d, p))[1])
    pieces = piece_lattice.piece_table(lab, public_tokenizers.path("piece_bpe_32k.model")).cache()
    rng = random.Random(4)
    texts = [" ".join(f"w{rng.randint(0, 400)}" for _ in range(60)) + "\n\n\u2581\t\U0001f600 é" for _ in range(300)] + [None, "", "\n"] * 3
    got = piece_lattice.decode(piece_lattice.encode(lab.createDataFrame([(k, t) for k, t in enumerate(texts)], "k int, text string"),
                                                    pieces), pieces).collect()
    assert sorted(r.k for r in got) == list(range(len(texts)))
    assert all(r.decoded == (r.text or "").replace("\u2581", " ") and r.text == texts[r.k] for r in got)
    assert len(encoded) == len(set(encoded)) > 400
    n = int(lab.conf.get("spark.sql.shuffle.partitions"))
    assert tables[0].count() <= n * n


def test_piece_lattice_query_reads_all_documents(lab):
    from casebook.llm import catalogue
    got = catalogue.op7_piece_lattice(lab, SF).collect()
    docs, turns = (lab.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "conversations"))
    assert sorted(r.doc_id for r in got if r.doc_id is not None) == sorted(r.doc_id for r in docs.select("doc_id").collect())
    assert sorted((r.conv_id, r.turn) for r in got if r.doc_id is None) == sorted(
        tuple(r) for r in turns.select("conv_id", "turn").collect())
    assert all(r.round_trip for r in got)


def test_empty_tables(lab):
    none = rows_of(lab, []).withColumn("lang", F.lit("en"))
    assert substring_dedup.remove_repeats(none).isEmpty()
    assert suffix_dedup.remove_repeated_bytes(none).isEmpty()
    assert jaccard_join.jaccard_components(none).isEmpty()
    assert packing.pack(none, BPE).isEmpty()
    assert licenses.scan(none.withColumn("path", F.lit("a")), gives=F.lit(True)).isEmpty()
    assert language_id.predict(none, language_id.fit(none)).isEmpty()


def test_rows_without_id_and_repeated_rows(lab):
    text = " ".join(f"w{i}" for i in range(80))
    docs = lab.createDataFrame([(None, text), (1, text), (1, text), (2, text)], "doc_id long, text string")
    got = sorted((r.doc_id or 0, r.n_removed) for r in substring_dedup.remove_repeats(docs).collect())
    assert got == [(0, 0), (1, 0), (1, 0), (2, 80)]
    got = sorted((r.doc_id, r.component_id) for r in jaccard_join.jaccard_components(docs).collect())
    assert got == [(1, 1), (2, 1)]
    assert packing.pack(docs, BPE).count() == 4


def test_pipeline_against_brute_force(lab, tmp_path):
    """Each stage on its own input: filters keep rows as they are, groups keep their smallest, passages go."""
    import corpus_pipeline as P
    docs = lab.read.parquet(f"{SF}/documents.parquet")
    stages = dict(P.STAGES)
    assert [n for n, _ in P.STAGES] == ["quality rules", "language ID", "n-gram Jaccard join", "substring dedup",
                                        "best-fit packing"]
    kept = []
    for name in list(stages)[:4]:
        stages[name](lab, docs, SF).write.parquet(f"{tmp_path}/{len(kept)}")
        after = lab.read.parquet(f"{tmp_path}/{len(kept)}")
        rows, left = [(r.doc_id, r.text) for r in docs.collect()], {r.doc_id: r.text for r in after.collect()}
        kept.append(left)
        assert after.columns == P.COLUMNS
        if name in ("quality rules", "language ID"):
            assert all(dict(rows)[d] == t for d, t in left.items())
        if name == "n-gram Jaccard join":
            assert set(left) == {c for _, c in brute.components(rows).values()}
        if name == "substring dedup":
            want = brute.repeated_windows(rows)
            assert left == {d: (want[d][2] if want[d][1] else t) for d, t in rows}
        docs = after
    assert stages["best-fit packing"](lab, docs, SF).select("doc_id").distinct().count() == len(kept[-1])
