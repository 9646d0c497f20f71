"""Exact Jaccard self-join on word shingles (universe partition and pigeonhole).

A document's set holds its distinct ``SHINGLE``-word shingles. Two sets link
when ``100 * |A & B| >= percent * |A | B|``. If A is the smaller, they differ
in at most ``H = (100 - percent) * |A| // percent`` shingles.

* *Universe partition.* Sets are put into size bands, each so wide that a
  partner of a set is in its band or the next. Each band cuts the hash range of
  shingles into segments of its own number; a set is indexed with all its
  non-empty segments in its own band, and in the band below for smaller sets.
* *Pigeonhole.* Of any segments of A whose allowances (0: equal, 1: up to one
  shingle apart, counted as allowance + 1) sum to more than H, one keeps within
  its allowance for every partner. One-deletion neighbourhoods serve allowance
  1 in small bands; large bands have segments enough for allowance 0.
* *Cost-based allocation.* The index says for each segment of A how many other
  sets share it. Segments shared with nobody cost nothing and come first, so a
  set with H + 1 of these has no partner and asks nothing; the others take the
  cheapest segments that are still needed.
* *Exact verification*. Pairs (asking set, member) of a group are looked at in
  blocks: the parities of the shingles in each of a few thousand cells differ in
  no more cells than the sets differ in shingles, so pairs that differ in too
  many cells are no links. Of the others a block writes a spanning forest, not
  the pairs. Every link lies inside a connected group of these candidates, so the
  members of such a group meet on whole texts, in blocks, each pair in one pair
  of blocks; a block gives every member's number of links and a spanning forest
  of the links. So ``n_links`` is a set's whole degree, though no pair of a group
  becomes a row, and what is written grows with the members.

Equal sets are one class from the start (128-bit digest and size); they travel
once per slice of text and are expanded only in the result. Should a set's
segments not suffice (its shingles fall into very few), its bands are run again
with another partition; nothing is dropped.

Defined results: A-Z are lower-cased; fewer words than a shingle has make one
shingle; without words, or with a null text, the set is empty and links with
nothing; rows without ``doc_id`` are left out (they cannot be named); repeated
rows of one ``doc_id`` are one document and come back once, with their first
set if they differ. Other columns, whatever their names, are not read.
"""

from __future__ import annotations

from functools import lru_cache
from math import exp, sqrt

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from casebook.llm import exchange as X
from casebook.llm.arrays import Runs, byte_runs, mix, slices, tidy, utf8, window_starts, words
from casebook.operators.common import connected_components

SHINGLE = 5
PERCENT = 80
SMALL = 256  # bands of sets below this size also index one-deletion neighbourhoods
DELETED, OWN, PAIRED = 1, 2, 4  # flags of a small band's entries: a deletion; of the own band; two shingles or more

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def allowance(size: int, percent: int) -> int:
    return (100 - percent) * size // percent


@lru_cache(maxsize=8)
def bands(percent: int) -> tuple[int, ...]:
    """First sizes of the bands: a partner of a set in band k is in band k or k + 1."""
    lows = [1]
    while lows[-1] < 1 << 31:
        lows.append(lows[-1] * 100 // percent + 1)
    return tuple(lows)


def band_of(size: int, percent: int) -> int:
    return int(np.searchsorted(bands(percent), size, side="right")) - 1


@lru_cache(maxsize=1024)
def segments(band: int, percent: int) -> int:
    """Segments of a band: as few as leave its largest sets enough non-empty ones, by eight standard deviations."""
    top = bands(percent)[band + 1] - 1
    need = allowance(top, percent) + 1
    if top < SMALL:
        return max(2, -(-top // (3 if top > 32 else 1)))
    load = 3.8
    while load > 0.5:
        m = top / load
        mean = m * (1 - exp(-load))
        if mean - 8 * sqrt(m * exp(-load) * (1 - (1 + load) * exp(-load))) > need:
            return int(m) + 1
        load -= 0.1
    return 2 * top


def shingle_hashes(off, data, n: int):
    """Hashes of all shingles, and each text's range of them; short texts have one, texts without words none."""
    starts, ends, by = words(off, data)
    hashes = Runs(byte_runs(data)(starts, ends))
    at = window_starts(by, n)
    bounds = np.searchsorted(at, by)
    return hashes(at, at + n), bounds, hashes, by


def sets_of(off, data, n: int):
    """Sorted distinct shingle hashes of each text."""
    every, bounds, hashes, by = shingle_hashes(off, _LOWER[data], n)
    for k in range(len(off) - 1):
        count = by[k + 1] - by[k]
        if count >= n:
            yield np.unique(every[bounds[k]:bounds[k + 1]])
        elif count:
            yield hashes(by[k:k + 1], by[k + 1:k + 2])
        else:
            yield every[:0]


_DIGEST = np.dtype([("doc_id", "<i8"), ("second", "<i8"), ("segments", "<i4"), ("pairs", "<i4")])
_SMALL = np.dtype([("flags", "u1"), ("segment", "<u2")])


def _cut(v: np.ndarray, band: int, m: int):
    """Segment numbers, starts, sizes and content sums of a set's non-empty segments (v sorted)."""
    segment = ((v >> np.uint64(32)) * np.uint64(m)) >> np.uint64(32)
    head = np.flatnonzero(np.r_[True, segment[1:] != segment[:-1]])
    code = mix(v + np.uint64(band + 1))
    return segment[head], head, np.diff(np.r_[head, len(v)]), code, np.add.reduceat(code, head)


def _emit(shingle, percent, n_buckets, seed, only):
    twist = np.uint64(seed * 0x9E3779B97F4A7C15 % (1 << 64))

    def emit(batches):
        for part in slices(batches):
            ids = part.column(0).to_numpy(zero_copy_only=False)
            off, data = utf8(part.column(1))
            keys, info, sizes = [], np.zeros(len(ids), dtype=_DIGEST), np.zeros(len(ids), dtype=np.uint32)
            plain, small, seen = {True: [], False: []}, [], set()
            for k, u in enumerate(sets_of(off, data, shingle)):
                key = int(mix(u ^ np.uint64(0xA5A5A5A5)).sum(dtype=np.uint64)) if len(u) else 0
                second = int(np.bitwise_xor.reduce(mix(u + np.uint64(0x5A5A5A5A5A)))) if len(u) else 0
                keys.append(key)
                sizes[k] = len(u)
                info[k]["doc_id"] = ids[k]
                info[k]["second"] = np.uint64(second).astype(np.int64)
                if not len(u):
                    continue
                own = band_of(len(u), percent)
                v = np.sort(mix(u ^ twist))
                for band in (own, own - 1):
                    if band < 0 or (only is not None and band not in only):
                        continue
                    m = segments(band, percent)
                    segment, head, size, code, total = _cut(v, band, m)
                    sig = mix(total + mix(segment + np.uint64(band << 32)))
                    deletions = bands(percent)[band + 1] - 1 < SMALL
                    if band == own:
                        info[k]["segments"] = len(head)
                        info[k]["pairs"] = int((size > 1).sum()) if deletions else 0
                    if key in seen:
                        continue
                    if not deletions:
                        plain[band == own].append((k, sig))
                        continue
                    flag = np.where(size > 1, PAIRED, 0) | (OWN if band == own else 0)
                    small.append((k, sig, flag, segment))
                    each = np.repeat(np.arange(len(head)), size)
                    many = size[each] > 1
                    less = mix(total[each] - code + mix(segment[each] + np.uint64(band << 32)))
                    small.append((k, less[many], flag[each][many] | DELETED, segment[each][many]))
                seen.add(key)
            key64 = np.array(keys, dtype=np.uint64).astype(np.int64)
            every = np.arange(len(ids))
            yield X.packed(0, key64.astype(np.uint64) % np.uint64(n_buckets), every, key64, sizes, info, n_buckets)
            for own, kind in ((True, 1), (False, 2)):
                if plain[own]:
                    sig = np.concatenate([s for _, s in plain[own]])
                    doc = np.repeat([k for k, _ in plain[own]], [len(s) for _, s in plain[own]])
                    yield X.packed(kind, (sig >> np.uint64(32)) % np.uint64(n_buckets), doc, key64,
                                   sig.astype(np.uint32), None, n_buckets)
            if small:
                sig = np.concatenate([s[1] for s in small])
                doc = np.repeat([s[0] for s in small], [len(s[1]) for s in small])
                extra = np.empty(len(sig), dtype=_SMALL)
                extra["flags"] = np.concatenate([s[2] for s in small])
                extra["segment"] = np.concatenate([s[3] for s in small])
                yield X.packed(3, (sig >> np.uint64(32)) % np.uint64(n_buckets), doc, key64,
                               sig.astype(np.uint32), extra, n_buckets)
    return emit


# kind 0: a document (owner = doc_id, tail = second digest, a = shingles, b = segments, c = those of two or more)
# kind 1: a set in a shared segment of a large band (owner = group, a = others in it, b = own segments there)
# kind 2: the same in a small band (a = sets with the segment, b = sets with it as a deletion, c = flags and segment)
INDEX = "kind int, key long, owner long, tail long, a int, b int, c int"
_NAMES = [c.split()[0] for c in INDEX.split(", ")]


def _rows(kind, key, owner, tail, a, b, c):
    n = len(key)
    wide = lambda x: np.broadcast_to(np.asarray(x, dtype=np.int64), n)
    return pa.RecordBatch.from_arrays(
        [pa.array(np.full(n, kind, dtype=np.int32)), *(pa.array(wide(x)) for x in (key, owner, tail)),
         *(pa.array(wide(x).astype(np.int32)) for x in (a, b, c))], names=_NAMES)


def _groups(batches):
    """Of one bucket: the documents' digests, and the segments that two sets or more share."""
    large, small = [], []
    bucket = 0
    for batch in batches:
        kinds, bucket = batch.column(1).to_pylist(), batch.column(0)[0].as_py()
        for kind, doc, sig, extra, _ in X.unpacked(batch, np.uint32, np.uint8):
            if kind == 0:
                info = extra.view(_DIGEST)
                yield _rows(0, doc, info["doc_id"], info["second"], sig, info["segments"], info["pairs"])
            elif kind == 3:
                small.append((sig, doc, extra.view(_SMALL)))
            else:
                large.append((sig, doc, np.full(len(sig), kind == 1)))
        del kinds
    if large:
        sig, key, own = (np.concatenate([x[i] for x in large]) for i in range(3))
        order = np.lexsort((key, sig))
        sig, key, own = sig[order], key[order], own[order]
        once = np.r_[True, (sig[1:] != sig[:-1]) | (key[1:] != key[:-1])]
        sig, key, own = sig[once], key[once], own[once]
        head = np.flatnonzero(np.r_[True, sig[1:] != sig[:-1]])
        size = np.diff(np.r_[head, len(sig)])
        # segments that the same sets share are one group, named by its members
        group = np.add.reduceat(mix(key.astype(np.uint64)), head)
        many = np.repeat(size > 1, size)
        group, size = np.repeat(group, size)[many].astype(np.int64), np.repeat(size, size)[many]
        key, own = key[many], own[many]
        if len(key):
            order = np.lexsort((key, group))
            group, key, own, size = group[order], key[order], own[order], size[order]
            head = np.flatnonzero(np.r_[True, (group[1:] != group[:-1]) | (key[1:] != key[:-1])])
            yield _rows(1, key[head], group[head], 0, size[head] - 1, np.add.reduceat(own.astype(np.int64), head), 0)
    if small:
        sig, key, extra = (np.concatenate([x[i] for x in small]) for i in range(3))
        order = np.lexsort((extra["flags"] & DELETED, key, sig))
        sig, key, extra = sig[order], key[order], extra[order]
        gone = (extra["flags"] & DELETED).astype(bool)
        once = np.r_[True, (sig[1:] != sig[:-1]) | (key[1:] != key[:-1]) | (gone[1:] != gone[:-1])]
        sig, key, extra, gone = sig[once], key[once], extra[once], gone[once]
        new = np.r_[True, sig[1:] != sig[:-1]]
        at = np.cumsum(new) - 1
        whole, less = np.bincount(at, ~gone).astype(np.int64), np.bincount(at, gone).astype(np.int64)
        # deletions meet whole segments only
        many = (whole[at] > 0) & (whole[at] + less[at] > 1)
        if many.any():
            group = mix(sig.astype(np.uint64) + np.uint64(bucket << 33)).astype(np.int64)
            yield _rows(2, key[many], group[many], 0, whole[at][many], less[at][many],
                        extra["flags"][many].astype(np.int64) | extra["segment"][many].astype(np.int64) << 3)


def _allocate(percent):
    """Per set: the groups it must ask, cheapest first, after the segments that nobody shares."""
    def own_groups(n, n_segments, n_pairs, kinds, owners, a, b, c):
        need = allowance(n, percent) + 1
        if 1 in kinds:
            free = n_segments - sum(b)
            for cost, gain, owner in sorted((x / max(1, y), y, o) for x, y, o in zip(a, b, owners, strict=True) if y):
                if free >= need:
                    return
                free += gain
                yield owner
            return
        # small band: steps (cost, groups) of each segment, for allowance 0 and for 1
        zero, one, pair = {}, {}, set()
        for owner, whole, less, tag in zip(owners, a, b, c, strict=True):
            if not tag & OWN:
                continue
            s = tag >> 3
            if tag & PAIRED:
                pair.add(s)
            zero.setdefault(s, [0, []])
            one.setdefault(s, [0, []])
            if tag & DELETED:
                one[s][0] += whole
                one[s][1].append(owner)
            else:
                zero[s][0] += whole - 1
                one[s][0] += less
                if whole > 1:
                    zero[s][1].append(owner)
                if less:
                    one[s][1].append(owner)
        gain = (n_segments - len(zero)) + (n_pairs - len(pair))
        steps = [(cost, s, 0, groups) for s, (cost, groups) in zero.items()]
        steps += [(max(cost, zero[s][0]), s, 1, groups) for s, (cost, groups) in one.items() if s in pair]
        for _, _, _, groups in sorted(steps, key=lambda x: x[:3]):
            if gain >= need:
                return
            gain += 1
            yield from groups

    def apply(batches):
        for batch in batches:
            keys, out = [], []
            for row in batch.to_pylist():
                n, seg, pairs = row["a"], row["b"], row["c"]
                entries = row["entries"]
                mine = list(dict.fromkeys(own_groups(n, seg, pairs, {e["kind"] for e in entries},
                                                     *([e[x] for e in entries] for x in ("owner", "a", "b", "c")))))
                keys += [row["key"]] * len(mine)
                out += mine
            yield pa.RecordBatch.from_arrays([pa.array(keys, pa.int64()), pa.array(out, pa.int64())],
                                             names=["key", "owner"])
    return apply


class Forest:
    """Joins members of a block; ``edges`` are the first pairs that joined two parts (fewer than members)."""

    def __init__(self, names: np.ndarray):
        self.names, self.part, self.edges = names, np.arange(len(names)), []

    def join(self, one: int, others: np.ndarray) -> None:
        for part, first in zip(*np.unique(self.part[others], return_index=True), strict=True):
            if part != self.part[one]:
                self.edges.append((int(self.names[one]), int(self.names[others[first]])))
                self.part[self.part == part] = self.part[one]


def _bits(sketches: list[bytes]) -> np.ndarray:
    """Sketches as rows of 64-bit words; those of the next band are folded to the width of the first."""
    width = min(map(len, sketches))
    bits = np.empty((len(sketches), width), dtype=np.uint8)
    for k, raw in enumerate(sketches):
        b = np.frombuffer(raw, dtype=np.uint8)
        while len(b) > width:
            b = b[:len(b) // 2] ^ b[len(b) // 2:]
        bits[k] = b
    return bits.view(np.uint64)


def _close(left: np.ndarray, right: np.ndarray, bits: np.ndarray, n: np.ndarray, percent: int):
    """(member of ``left``, members of ``right`` that it may link with), by the parity sketches."""
    step = max(1, (1 << 20) // max(1, len(right) * bits.shape[1]))
    for lo in range(0, len(left), step):
        at = left[lo:lo + step]
        apart = np.bitwise_count(bits[at][:, None, :] ^ bits[right][None, :, :]).sum(axis=2, dtype=np.int64)
        good = apart * (100 + percent) <= (n[at][:, None] + n[right][None, :]) * (100 - percent)
        for k, row in zip(at.tolist(), good, strict=True):
            yield k, right[row]


def _keyed(batches, width: int):
    """Rows in runs of equal first ``width`` columns."""
    held, key = [], None
    for batch in batches:
        for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if row[:width] != key:
                if held:
                    yield key, held
                held, key = [], row[:width]
            held.append(row[width:])
    if held:
        yield key, held


def _linked(shingle, percent):
    """Sorted rows (comp, i, j, block, rep, ztext): of block i and block j of a group of candidates each member's number
    of links between them (y null), and a forest of these links (degree 0)."""
    def apply(batches):
        for (_, i, j), rows in _keyed(batches, 3):
            block, rep, texts = (list(x) for x in zip(*rows, strict=True))
            block, rep = np.array(block), np.array(rep, dtype=np.int64)
            sets = []
            for lo in range(0, len(texts), 256):
                sets += sets_of(*X.as_texts([X.unsqueeze(t) for t in texts[lo:lo + 256]]), shingle)
            del rows, texts
            n = np.array([len(u) for u in sets])
            bits = _bits([sketch(u, percent) for u in sets])
            known, flat = np.unique(np.concatenate(sets), return_inverse=True)
            bound = np.r_[0, np.cumsum(n)]
            here, degree, forest = np.zeros(len(known), dtype=bool), np.zeros(len(rep), dtype=np.int64), Forest(rep)
            left, right = np.flatnonzero(block == i), np.flatnonzero(block == j)
            for one, others in _close(left, right, bits, n, percent):
                if i == j:
                    others = others[others > one]  # each pair once
                if not len(others):
                    continue
                own = flat[bound[one]:bound[one + 1]]
                here[own] = True
                size = n[others]
                ends = np.cumsum(size)
                of = np.repeat(bound[others] - (ends - size), size) + np.arange(ends[-1])
                both = np.add.reduceat(here[flat[of]].astype(np.int64), ends - size)
                here[own] = False
                others = others[100 * both >= percent * (n[one] + size - both)]
                degree[one] += len(others)
                degree[others] += 1
                if len(others):
                    forest.join(one, others)
            some = np.flatnonzero(degree)
            edges = np.array(forest.edges, dtype=np.int64).reshape(-1, 2)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.r_[rep[some], edges[:, 0]]),
                 pa.array([None] * len(some) + edges[:, 1].tolist(), pa.int64()),
                 pa.array(np.r_[degree[some], np.zeros(len(edges), dtype=np.int64)])], names=["x", "y", "degree"])
    return apply


def cells(size: int, percent: int) -> int:
    """Cells of a set's parity sketch: four times the least size of its band, as a power of two."""
    return max(256, 1 << (4 * bands(percent)[band_of(size, percent)] - 1).bit_length())


def sketch(u: np.ndarray, percent: int) -> bytes:
    """One bit per cell: whether an odd number of the set's shingles fall into it."""
    m = cells(max(len(u), 1), percent)
    at = (mix(u + np.uint64(77)) & np.uint64(m - 1)).astype(np.int64)
    return np.packbits((np.bincount(at, minlength=m) & 1).astype(np.uint8), bitorder="little").tobytes()


def _prepared(shingle, percent):
    def apply(batches):
        for part in slices(batches):
            raw = [t or b"" for t in part.column(1).to_pylist()]
            sets = list(sets_of(*X.as_texts(raw), shingle))
            yield pa.RecordBatch.from_arrays(
                [part.column(0), pa.array([len(u) for u in sets], pa.int32()), pa.array([X.squeeze(t) for t in raw], pa.binary()),
                 pa.array([sketch(u, percent) for u in sets], pa.binary())], names=["rep", "n_shingles", "ztext", "sketch"])
    return apply


BLOCK = 2048  # members of a group compared at once
TOGETHER = 400_000  # shingles of a group of candidates in a block, whose texts are verified with another block's


def _near(percent):
    """Sorted rows (owner, i, j, block, rep, n, asks, sketch): a forest of the pairs of block i and block j that may
    link, one of which asks."""
    def apply(batches):
        for (_, i, j), rows in _keyed(batches, 3):
            block, rep, n, asks, sketches = (list(x) for x in zip(*rows, strict=True))
            bits, rep = _bits(sketches), np.array(rep, dtype=np.int64)
            n, asks, block, forest = np.array(n), np.array(asks), np.array(block), Forest(rep)
            for one, others in _close(np.flatnonzero(block == i), np.flatnonzero(block == j), bits, n, percent):
                others = others[(asks[others] | asks[one]) & (others != one)]
                if len(others):
                    forest.join(one, others)
            edges = np.array(forest.edges, dtype=np.int64).reshape(-1, 2)
            edges.sort(axis=1)
            yield pa.RecordBatch.from_arrays([pa.array(edges[:, 0].copy()), pa.array(edges[:, 1].copy())],
                                             names=["x", "y"])
    return apply


def jaccard_components(docs: DataFrame, shingle: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """``docs`` (doc_id, text) -> doc_id, n_shingles, component_id, class_id (smallest doc_id with an
    equal set), n_links (of the document's set to other sets)."""
    spark = docs.sparkSession
    n = X.bucket_count(spark)
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("binary").alias("text")) \
        .filter(F.col("doc_id").isNotNull())

    def indexed(seed, only):
        return X.table(X.routed(docs, _emit(shingle, percent, n, seed, only), _groups, INDEX, n))

    def asked(index):
        """Groups that sets ask, and the members of these groups."""
        entries = (index.filter((F.col("kind") == 2) | ((F.col("kind") == 1) & (F.col("b") > 0)))
                   .groupBy("key").agg(F.collect_list(F.struct("kind", "owner", "a", "b", "c")).alias("entries")))
        sets = index.filter("kind = 0 and a > 0").groupBy("key").agg(*(F.first(x).alias(x) for x in "abc"))
        asks = X.table(sets.join(entries, "key").mapInArrow(tidy(_allocate(percent)), "key long, owner long"))
        members = (index.filter("kind > 0").select("owner", "key").distinct()
                   .join(asks.select("owner").distinct(), "owner", "left_semi"))
        return asks, X.table(members)

    index = indexed(0, None)
    everyone = index.filter("kind = 0").select("key", F.col("owner").alias("doc_id"), "tail", F.col("a").alias("n_shingles"))
    asks, members = asked(index)
    short, seed = _short(index, percent), 0
    while short:
        seed += 1
        again = indexed(seed, frozenset(short))
        more_asks, more = asked(again)
        asks, members = asks.unionByName(more_asks), members.unionByName(more)
        short = _short(again, percent, frozenset(short))

    classes = everyone.filter("n_shingles > 0").groupBy("key", "tail", "n_shingles").agg(F.min("doc_id").alias("rep"))
    wanted = X.table(classes.join(members.select("key").distinct(), "key", "left_semi").select("key", "rep", "n_shingles"))
    # one plan at every size: the candidates' list is never broadcast, as it grows with the corpus
    texts = X.table(docs.join(wanted.select(F.col("rep").alias("doc_id")).hint("merge"), "doc_id", "left_semi")
                    .dropDuplicates(["doc_id"]).select(F.col("doc_id").alias("rep"), "text")
                    .mapInArrow(tidy(_prepared(shingle, percent)), "rep long, n_shingles int, ztext binary, sketch binary"))
    within = X.table(members.distinct().join(wanted, "key").select("owner", "rep", "n_shingles"))

    def verified(candidates):
        """Rows of ``_linked``: all pairs of a connected group of candidates are compared, each in one pair of blocks."""
        at = _components(candidates).join(texts.select("rep", "n_shingles", "ztext"), "rep")
        blocks = at.groupBy("comp").agg(F.ceil(F.sum("n_shingles") / TOGETHER).alias("blocks"))
        at = at.join(blocks, "comp").withColumn("block", F.pmod(F.xxhash64("rep"), F.col("blocks")))
        at = at.withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)))
        at = at.select("comp", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"), "block", "rep",
                       "ztext")
        return X.table(at.repartition("comp", "i", "j").sortWithinPartitions("comp", "i", "j")
                       .mapInArrow(tidy(_linked(shingle, percent)), "x long, y long, degree long"))

    askers = asks.join(wanted, "key").select("owner", "rep", F.lit(True).alias("asks"))
    placed = (within.join(within.groupBy("owner").agg(F.ceil(F.count(F.lit(1)) / BLOCK).alias("blocks")), "owner")
              .join(askers.distinct(), ["owner", "rep"], "left").join(texts.select("rep", "sketch"), "rep")
              .withColumn("block", F.pmod(F.xxhash64("rep"), F.col("blocks")))
              .withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1))))
    placed = placed.select("owner", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"), "block",
                           "rep", "n_shingles", F.coalesce("asks", F.lit(False)).alias("asks"), "sketch")
    near = X.table(placed.repartition("owner", "i", "j").sortWithinPartitions("owner", "i", "j")
                   .mapInArrow(tidy(_near(percent)), "x long, y long"))
    links = verified(near)
    found = _components(links.filter("y is not null").select("x", "y"))
    degree = links.groupBy(F.col("x").alias("rep")).agg(F.sum("degree").alias("n_links"))
    linked = (classes.join(found, "rep", "left").join(degree, "rep", "left")
              .select("key", "tail", "n_shingles", F.col("rep").alias("class_id"),
                      F.coalesce("comp", "rep").alias("component_id"), F.coalesce("n_links", F.lit(0)).alias("n_links")))
    result = everyone.join(linked, ["key", "tail", "n_shingles"], "left").select(
        "doc_id", F.col("n_shingles").cast("long").alias("n_shingles"),
        F.coalesce("component_id", "doc_id").alias("component_id"), F.coalesce("class_id", "doc_id").alias("class_id"),
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"))
    return result.dropDuplicates(["doc_id"])


def _components(links: DataFrame) -> DataFrame:
    return connected_components(links, src="x", dst="y", vid="rep").withColumnRenamed("component", "comp")


def _short(index: DataFrame, percent: int, only: frozenset | None = None) -> list[int]:
    """Bands with sets whose segments do not suffice (a bounded number of bands)."""
    sets = index.filter((F.col("kind") == 0) & (F.col("a") > 0))
    lacking = sets.filter(F.col("b") + F.col("c") <= F.floor(F.col("a") * (100 - percent) / percent))
    found = {band_of(r.a, percent) for r in lacking.select("a").distinct().collect()} if not lacking.isEmpty() else set()
    return sorted(b for b in found if only is None or b in only)
