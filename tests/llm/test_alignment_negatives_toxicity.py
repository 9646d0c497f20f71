"""Token alignment, hard negatives and toxicity against brute force and held-out labels."""

import collections
import hashlib
import math
import random
import re

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

from casebook.llm import alignment, catalogue, hard_negatives, toxicity
from casebook.session import ship_package

SF = "/root/testdata/sf0.001"
BPE, PIECES = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def lab(spark):
    ship_package(spark)
    return spark


# ---------------------------------------------------------------- alignment
def plain_alignment(texts):
    """Per text: ids and group ends of both sides, straight from the two libraries on whole texts."""
    import sentencepiece
    from tokenizers import Tokenizer
    a_side = Tokenizer.from_file(BPE)
    a_side.encode_special_tokens = True
    b_side = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    letters = alignment.byte_letters()
    out = []
    for text in texts:
        a, b = [], []
        if text:
            e = a_side.encode(" " + text, add_special_tokens=False)
            a = [(i, bytes(letters[c] for c in t)) for i, t in zip(e.ids, e.tokens)]
            names = [(i, b_side.id_to_piece(i)) for i in b_side.encode(text)]
            b = [(i, bytes([int(p[3:5], 16)]) if b_side.is_byte(i) else p.replace("▁", " ").encode()) for i, p in names]
            if any(b"".join(x for _, x in side) != (" " + text).encode() for side in (a, b)):
                a, b = [], []
        ends = []
        for side in (a, b):
            total, at = 0, {}
            for k, (_, raw) in enumerate(side):
                total += len(raw)
                at[total] = k + 1
            ends.append(at)
        common = sorted(set(ends[0]) & set(ends[1]))
        out.append(([i for i, _ in a], [i for i, _ in b], [ends[0][c] for c in common], [ends[1][c] for c in common]))
    return out


def digest(a, b, a_ends, b_ends):
    parts = [",".join(map(str, a[i:j])) + "|" + ",".join(map(str, b[k:m])) for i, j, k, m in
             zip([0, *a_ends], a_ends, [0, *b_ends], b_ends)]
    return hashlib.sha256(";".join(parts).encode()).hexdigest() if parts else ""


def odd_texts():
    rng = random.Random(3)
    bits = ["a", "b", " ", "  ", "\n", "\t", "é", " ", "　", "中", "'s", "'ll", "1", "!", "<|endoftext|>", "<s>",
            " ", "foo", "ﬁ", "😀", "\r\n", "\u0085", "Ж", "The ", "word "]
    made = ["".join(rng.choice(bits) for _ in range(rng.randint(0, 25))) for _ in range(400)]
    return [None, "", " ", "x ", "▁", "a▁b", "same text", "same text", "w " * 20_000, "x" * 4000, *made]


def test_alignment_equals_libraries_on_whole_texts(lab):
    real = [(r.doc_id, r.text) for r in lab.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]
    for rows in (list(enumerate(odd_texts())), real):
        docs = lab.createDataFrame([(d, t, 1, "x") for d, t in rows], "doc_id long, text string, slice int, pairs string")
        want = plain_alignment([t for _, t in rows])
        got = {r.doc_id: (r.a_ids, r.b_ids, r.a_ends, r.b_ends) for r in
               alignment.align(docs.repartition(5), BPE, PIECES).collect()}
        assert [got[d] for d, _ in rows] == [tuple(w) for w in want]
        # corpus-wide counts of the pairs that end together
        links = [[(a[i - 1], b[j - 1]) for i, j in zip(x, y)] for a, b, x, y in want]
        count = collections.Counter(p for own in links for p in own)
        top = collections.defaultdict(int)
        for (_, b), n in count.items():
            top[b] = max(top[b], n)
        expected = {d: (len(a), len(b), len(x), len(own), sum(count[p] == top[p[1]] for p in own),
                        sum(count[p] for p in own), digest(a, b, x, y))
                    for (d, _), (a, b, x, y), own in zip(rows, want, links)}
        for parts in (1, 6):
            found = alignment.count_links(docs.repartition(parts), BPE, PIECES).collect()
            assert {r[0]: tuple(r)[1:] for r in found} == expected


def test_alignment_of_nothing_and_rows_without_id(lab):
    empty = lab.createDataFrame([], "doc_id long, text string")
    assert alignment.count_links(empty, BPE, PIECES).collect() == [] and alignment.align(empty, BPE, PIECES).collect() == []
    rows = alignment.count_links(lab.createDataFrame([(None, "one two"), (None, None)], "doc_id long, text string"),
                                 BPE, PIECES).collect()
    assert sorted((r.doc_id, r.n_links > 0) for r in rows) == [(None, False), (None, True)]


def test_sums_merge_when_a_task_holds_too_many_pairs(lab, monkeypatch):
    monkeypatch.setattr(alignment, "MERGED", 100)
    import pyarrow as pa
    rng = np.random.default_rng(1)
    rows = [(np.unique(rng.integers(0, 300, 80).astype(np.uint64))) for _ in range(20)]
    batch = pa.RecordBatch.from_arrays([pa.array([r.tobytes() for r in rows], pa.binary()),
                                        pa.array([np.ones(len(r), dtype=np.int64).tobytes() for r in rows], pa.binary())],
                                       names=["pairs", "n"])
    total = collections.Counter()
    for out in alignment._merged(4)([batch]):
        by = collections.defaultdict(list)
        for k, r in enumerate(out.column(0).to_pylist()):
            by[r].append(out.slice(k, 1))
        for parts in by.values():
            for one in alignment._totals(parts):
                total.update(dict(zip(np.frombuffer(one.column(1)[0].as_py(), np.uint64).tolist(),
                                      np.frombuffer(one.column(2)[0].as_py(), np.int64).tolist())))
    assert total == collections.Counter(int(x) for r in rows for x in r)


# ----------------------------------------------------------- hard negatives
def plain_negatives(rows, anchors, k=5, low=80, scale=256):
    def usable(r):
        return r[0] is not None and r[1] is not None and r[2] and all(x is not None and math.isfinite(x) for x in r[2])

    def whole(r):
        return r[0], r[1], [math.floor(scale * float(x)) for x in r[2]]
    rows, firsts = [whole(r) for r in rows if usable(r)], {}
    for a in sorted(whole(r) for r in anchors if usable(r)):
        firsts.setdefault(a[0], a)
    out = []
    for a in firsts.values():
        scored = sorted((-sum(x * y for x, y in zip(a[2], r[2])), r[0], r[1]) for r in rows if r[0] != a[0] and len(r[2]) == len(a[2]))
        once = {}
        for s, i, _ in [x for x in scored if x[2] == a[1]][:k]:
            once.setdefault(i, s)  # a positive of several rows counts with its highest score
        for i, s in once.items():
            good = [x for x in scored if x[2] != a[1] and low * -s <= 100 * -x[0] <= 100 * -s][:k]
            out += [(a[0], i, r, x[1], -s, -x[0]) for r, x in enumerate(good, 1)]
    return sorted(out)


def test_hard_negatives_equal_brute_force(lab, monkeypatch):
    rng = random.Random(9)
    rows = [(i, rng.randint(0, 3), [rng.gauss(1, 1) for _ in range(6)]) for i in range(300)]
    rows += [(300 + i, i % 2, [1.0, 1.0, 0.5, 0.5, 0.5, 1.0]) for i in range(150)]  # a third of all rows on one spot
    rows += [(500, None, [1.0] * 6), (501, 1, None), (502, 1, []), (503, 1, [1.0, None, 1.0, 1.0, 1.0, 1.0]), (None, 1, [1.0] * 6),
             (504, 1, [float("nan")] * 6), (505, 1, [float("inf")] * 6), (506, 2, [2.0]), (507, 1, [1.5]), (508, 2, [1.4]),
             (600, 0, [0.0] * 6), (700, 3, [-1.0] * 6), (20, 3, [2.0] * 6), (801, 2, [3.0] * 6), (801, 2, [3.0] * 6),
             (801, 2, [2.0] * 6), (802, 3, [2.9] * 6), (802, 3, [2.9] * 6)]
    schema = "vec_id long, label int, embedding array<double>"
    df = lab.createDataFrame(rows, schema).withColumn("dim", F.lit("clash")).withColumn("v", F.lit(1))
    pick = F.col("vec_id") % 10 == 0
    anchors = df.filter(pick).unionByName(df.filter("vec_id = 506"))
    want = plain_negatives(rows, [r for r in rows if r[0] is not None and (r[0] % 10 == 0 or r[0] == 506)])
    assert len(want) > 100
    for shard, block, parts in ((8192, 256, 3), (64, 8, 5)):
        monkeypatch.setattr(hard_negatives, "SHARD", shard)
        monkeypatch.setattr(hard_negatives, "BLOCK", block)
        monkeypatch.setattr(hard_negatives, "WAVE_BYTES", 1000)
        got = hard_negatives.mine(df.repartition(parts), anchors)
        assert got.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
        assert sorted(tuple(r) for r in got.collect()) == want


def test_cells_are_visited_by_falling_bounds_that_hold(lab):
    rng = np.random.default_rng(4)
    rows = [(int(i), 0, v) for i, v in enumerate(np.floor(64 * rng.normal(size=(500, 7))))]
    books = {7: (hard_negatives.centres(np.stack([r[2][:3] for r in rows]), 6),
                 hard_negatives.centres(np.stack([r[2][3:] for r in rows]), 6))}
    import pyarrow as pa
    batch = pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows]), pa.array([0] * 500, pa.int32()),
                                        pa.array([r[2].tolist() for r in rows])], names=["vec_id", "label", "v"])
    out = next(hard_negatives._shards(books, 1000)([batch]))
    shard = hard_negatives.Shard({c: out.column(c)[0].as_py() for c in out.schema.names})
    q = rows[3][2]
    first, second = (h[0] for h in shard.halves(q[None, :]))
    seen = list(shard.visit(first, second))
    assert sum(b - a for _, (a, b) in seen) == 500 and [b for b, _ in seen] == sorted((b for b, _ in seen), reverse=True)
    assert all(shard.scores(at, q).max() <= bound for bound, at in seen)


def test_hard_negatives_of_nothing(lab):
    none = lab.createDataFrame([], "vec_id long, label int, embedding array<float>")
    assert hard_negatives.mine(none, none).collect() == []
    some = lab.createDataFrame([(0, 1, [1.0]), (100, 1, [2.0])], "vec_id long, label int, embedding array<float>")
    assert hard_negatives.mine(some, some).collect() == []  # nobody has another label


# ------------------------------------------------------------------ toxicity
def test_toxicity_on_held_out_rows(lab):
    got = catalogue.op12_toxicity(lab, "/root/testdata/sf0.01").collect()
    docs = {r.doc_id: r.text for r in lab.read.parquet("/root/testdata/sf0.01/documents.parquet").collect()}
    marks = {r.doc_id: r.toxic for r in lab.read.parquet("/root/testdata/sf0.01/labels.parquet").collect()}
    assert {r.doc_id for r in got} == set(docs) and all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.7) for r in got)
    import zlib
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for r in got)
    given = set(toxicity.LEXICON)
    plain = [r for r in got if r.held_out and not set(re.findall(r"[^\W\d_]+", (docs[r.doc_id] or "").lower())) & given]
    insulting = [r for r in got if r.held_out and r not in plain]
    assert sum(r.predicted for r in insulting) / len(insulting) >= 0.85
    assert sum(r.predicted for r in plain) / len(plain) <= 0.02
    known = [(r.score, marks[r.doc_id]) for r in got if r.held_out and marks.get(r.doc_id) is not None]
    bad, good = [s for s, y in known if y == 1], [s for s, y in known if y == 0]
    area = sum((b > g) + (b == g) / 2 for b in bad for g in good) / len(bad) / len(good)
    assert area > 0.8


def plain_features(text, learned):
    """The features that are easy to say in words, by regular expressions."""
    own = re.findall(r"[^ \t-\r]+", text or "")
    fold = ["".join(c.lower() for c in w if c.isalpha() or not c.isascii()) for w in own]
    n = max(len(own), 1)
    given, you = set(toxicity.LEXICON), set(toxicity.PRONOUNS)
    hits, people = [k for k, w in enumerate(fold) if w in given], [k for k, w in enumerate(fold) if w in you]
    marks = [c for c in text or "" if c in "!?"]
    return {"given": len(hits) / n,
            "given_most": max((sum(h <= x < h + toxicity.WINDOW for x in hits) for h in hits), default=0),
            "near_pronoun": math.log1p(sum(any(abs(p - h) <= toxicity.NEAR for p in people) for h in hits)),
            "pronouns": len(people) / n, "marks": len(marks) / n,
            "capital_words": sum(len(w) >= 2 and w.isascii() and w.isupper() and w.isalpha() for w in own) / n}


def test_toxicity_features_equal_plain_ones():
    rng = random.Random(2)
    bits = ["you", "idiot", "house", "Tree", "GREAT", "moron", "tu", "fine!", "why??", "été", "\n", "scum", "the", "x1y"]
    texts = [" ".join(rng.choice(bits) for _ in range(rng.randint(0, 120))) for _ in range(60)] + ["", "   ", "you idiot " * 500]
    raw = [t.encode() for t in texts]
    off = np.r_[0, np.cumsum([len(r) for r in raw])].astype(np.int64)
    data = np.frombuffer(b"".join(raw), dtype=np.uint8)
    none = np.zeros(0, dtype=np.uint64)
    got = toxicity.features(off, data, none, toxicity.word_hashes(toxicity.LEXICON), toxicity.word_hashes(toxicity.PRONOUNS))
    assert got.shape == (len(texts), len(toxicity.NAMES))
    for row, text in zip(got, texts, strict=True):
        for name, value in plain_features(text, ()).items():
            assert row[toxicity.NAMES.index(name)] == pytest.approx(value), (name, text[:60])
    each = [toxicity.features(np.array([0, len(r)]), np.frombuffer(r, dtype=np.uint8), none,
                              toxicity.word_hashes(toxicity.LEXICON), toxicity.word_hashes(toxicity.PRONOUNS))[0] for r in raw]
    assert np.allclose(got, np.stack(each))  # a text's features do not depend on its slice


def test_hidden_insults_show():
    raw = "you are an 1d!0t and a m.o.r.o.n but no house".encode()
    none = np.zeros(0, dtype=np.uint64)
    got = toxicity.features(np.array([0, len(raw)]), np.frombuffer(raw, dtype=np.uint8), none,
                            toxicity.word_hashes(toxicity.LEXICON), toxicity.word_hashes(toxicity.PRONOUNS))[0]
    assert got[toxicity.NAMES.index("hidden")] == pytest.approx(math.log1p(2))


def test_isotonic_levels_rise_and_fit_best():
    rng = np.random.default_rng(1)
    m = rng.integers(0, 12, 200).astype(float)
    y = (rng.random(200) < m / 12).astype(float)
    at, level = toxicity.isotonic(m, y)
    assert (np.diff(at) > 0).all() and (np.diff(level) > 0).all()
    # the largest of the smallest means over all runs around a margin (the max-min form of isotonic regression)
    values = sorted(set(m.tolist()))
    for v in values:
        want = max(min(y[(m >= lo) & (m <= hi)].mean() for hi in values if hi >= v) for lo in values if lo <= v)
        block = np.argmin([abs(want - x) for x in level])
        assert level[block] == pytest.approx(want)


def test_toxicity_without_labels_and_awkward_rows(lab):
    docs = lab.createDataFrame([(1, None, "x"), (2, "", "y"), (None, "you idiot", "z"), (2, "a " * 100_000, "y")],
                               "doc_id long, text string, toxicity string")
    labels = lab.createDataFrame([], "doc_id long, toxic int")
    got = toxicity.score(docs, toxicity.fit(docs, labels))
    assert got.columns == ["doc_id", "text", "toxicity"] and {r.toxicity.score for r in got.collect()} == {0.0}
    one = toxicity.fit(docs, lab.createDataFrame([(1, 1), (2, 1), (2, None)], "doc_id long, toxic int"))
    assert {r.toxicity.predicted for r in toxicity.score(docs, one).collect()} == {1}
    empty = lab.createDataFrame([], "doc_id long, text string")
    assert toxicity.score(empty, toxicity.fit(empty, labels)).collect() == []
    rows = [(i, "you are an idiot friend" if i % 2 else f"a fine day number {i}", i % 2) for i in range(200)]
    many = lab.createDataFrame(rows, "doc_id long, text string, toxic int")
    many = many.withColumn("text", F.concat("text", F.lit(" "), F.col("doc_id").cast("string")))
    model = toxicity.fit(many, many)
    found = toxicity.score(docs.unionByName(many.select("doc_id", "text"), allowMissingColumns=True), model).collect()
    assert all(r.toxicity.predicted == int("idiot" in (r.text or "")) for r in found)
