"""Removal of byte strings that occur more than once, by bucket-pointer refinement.

A suffix is followed for ``DEPTH`` bytes: two suffixes that share a bucket at
that depth begin the same DEPTH-byte string, and every byte such a string
covers goes - in all its places, the same document included.

Buckets start from q-grams and are refined by the bucket identifiers of later
offsets. These lie in the same document, so a task pairs them itself; only which
identifiers occur once is learned by an exchange, after each round. Buckets of
one suffix are finished and leave at once.

1. Initial buckets. In the window of each suffix the smallest ``GRAM``-byte gram
   is its pointer; neighbours share pointers, so there is one per some 180
   bytes. Pointers are put into buckets by their gram; single ones finish, with
   all the suffixes that hang on them.
2. Copies. Pointers that agree on everything their suffixes read finish as
   repeats; of each such class one stays, if its bucket has other classes.
3. Refinement at later offsets. Offsets that are multiples of s = DEPTH / 4 from
   the pointer get the identifier of their s bytes. One that occurs once in its
   bucket is dropped. An identifier of 2 s bytes is the pair of those at an
   offset and s later, where both are still there: an offset whose later offset
   has been dropped is dropped too, without any exchange. Singles of these pairs
   are dropped in turn.
4. Suffixes. A suffix is still open if all offsets are, whose 2 s bytes lie in
   its DEPTH bytes. Its bucket is the pair of the identifiers at its start and
   at its later half.

A group of copies costs one entry per copy and round; no pairs are made.
Identifiers are content hashes (equal strings have equal ones everywhere); 96
bits decide.

Defined results: a null text counts as empty; a row without ``doc_id`` takes
part in no comparison and keeps its bytes; repeated rows of one ``doc_id`` are
repeats of each other. Other columns, whatever their names, are not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from casebook.llm import exchange as X
from casebook.llm.arrays import byte_runs, mix, slices, tidy, utf8
from casebook.llm.substring_dedup import squeezed

DEPTH = 400
GRAM = 40
_PLACE = np.uint64((1 << 28) - 1)  # low bits of a gram hash give way to its place, so that the leftmost wins ties


def _least(values: np.ndarray, width: int) -> np.ndarray:
    """Minimum of each ``width`` neighbours (blockwise running minima from both sides)."""
    n = len(values) - width + 1
    short = -len(values) % width
    blocks = np.concatenate([values, np.full(short, np.iinfo(np.uint64).max, dtype=np.uint64)]).reshape(-1, width)
    left = np.minimum.accumulate(blocks, axis=1).ravel()
    blocks = np.ascontiguousarray(np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1]).ravel()
    return np.minimum(blocks[:n], left[width - 1:width - 1 + n])


def _pointers(off, data, depth, gram):
    """Hashes of byte runs; for each pointer its place, first suffix, number of suffixes, text and gram hash."""
    hashes = byte_runs(data)
    n = len(data)
    if n < depth:
        none = np.zeros(0, dtype=np.int64)
        return hashes, none, none, none, none, np.zeros(0, dtype=np.uint64)
    at = np.arange(n - gram + 1)
    grams = (hashes(at, at + gram) & ~_PLACE) | at.astype(np.uint64)
    places = (_least(grams, depth - gram + 1) & _PLACE).astype(np.int64)
    doc = np.searchsorted(off, np.arange(len(places)), side="right") - 1
    whole = np.arange(len(places)) + depth <= off[doc + 1]
    head = np.flatnonzero(whole & np.r_[True, (places[1:] != places[:-1]) | ~whole[:-1] | (doc[1:] != doc[:-1])])
    # a run of suffixes ends before the next head or before the first that is not whole
    stop = np.flatnonzero(whole & np.r_[(places[1:] != places[:-1]) | ~whole[1:] | (doc[1:] != doc[:-1]), True])
    place = places[head]
    return hashes, place, head, stop - head + 1, doc[head], hashes(place, place + gram)


def _emit_pointers(depth, gram, n_buckets):
    def emit(batches):
        for part in slices(batches):
            off, data = utf8(part.column(1))
            _, _, _, _, doc, code = _pointers(off, data, depth, gram)
            if len(doc):
                ids = part.column(0).to_numpy(zero_copy_only=False)
                yield X.packed(0, (code >> np.uint64(32)) % np.uint64(n_buckets), doc, ids,
                               code.astype(np.uint32), None, n_buckets)
    return emit


def _shared(batches):
    parts = [x[1:3] for b in batches for x in X.unpacked(b, np.uint32)]
    if not parts:
        return
    doc, sig = np.concatenate([p[0] for p in parts]), np.concatenate([p[1] for p in parts])
    _, at, n = np.unique(sig, return_inverse=True, return_counts=True)
    many = n[at] > 1
    if many.any():
        yield X.per_document(doc[many], sig[many], ["doc_id", "marks"])


_CLASS = np.dtype([("back", "<i4"), ("n", "<i4"), ("whole", "<u8")])
# suffixes: their offset to the pointer, and both identifiers as one to sort on: within pointer and offset 64 bits decide
_SUFFIX = np.dtype([("offset", "<u2"), ("pair", "<u8")])


def _marked(batches, depth, gram):
    """Slices of texts with their marked pointers: ids, offsets, marks' rest column, hashes, pointer arrays."""
    for part in slices(_open(batches), "text"):
        ids = part.column(0).to_numpy(zero_copy_only=False)
        off, data = utf8(part.column(1))
        hashes, place, head, n, doc, code = _pointers(off, data, depth, gram)
        yield part, ids, off, hashes, place, head, n, doc, code


def _open(batches):
    for batch in batches:
        texts = [X.unsqueeze(z) for z in batch.column(1).to_pylist()]
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.binary()), batch.column(2)],
                                         names=["doc_id", "text", "marks"])


def _chosen(part, doc, values, dtype):
    """Which entries have (text, value) among the binary lists of the third column."""
    lists = [np.unique(np.frombuffer(b"".join(m), dtype=dtype)) for m in part.column(2).to_pylist()]
    wanted = np.concatenate([m.astype(np.uint64) | np.uint64(k << 32) for k, m in enumerate(lists)])
    return np.isin(doc.astype(np.uint64) << np.uint64(32) | values.astype(np.uint64), wanted)


def _emit_classes(depth, gram, n_buckets):
    def emit(batches):
        for part, ids, off, hashes, place, head, n, doc, code in _marked(batches, depth, gram):
            keep = _chosen(part, doc, code & np.uint64(0xFFFFFFFF), np.uint32) if len(doc) else np.zeros(0, dtype=bool)
            place, head, n, doc, code = (v[keep] for v in (place, head, n, doc, code))
            if not len(doc):
                continue
            extra = np.empty(len(doc), dtype=_CLASS)
            extra["back"] = place - head
            extra["n"] = n
            span = hashes(head, head + n - 1 + depth)
            extra["whole"] = mix(span ^ mix((place - head).astype(np.uint64)))
            yield X.packed(0, (code >> np.uint64(32)) % np.uint64(n_buckets), doc, ids,
                           code.astype(np.uint32), extra, n_buckets, place - off[doc])
    return emit


def _classes(batches):
    """Of one bucket of pointers: runs of suffixes settled as repeats, and the places of pointers still to refine."""
    parts = [x[1:] for b in batches for x in X.unpacked(b, np.uint32, _CLASS)]
    if not parts:
        return
    doc, sig, extra, place = (np.concatenate([p[k] for p in parts]) for k in range(4))
    order = np.lexsort((place, doc, extra["whole"], sig))
    doc, sig, extra, place = doc[order], sig[order], extra[order], place[order].astype(np.int64)
    new_sig = np.r_[True, sig[1:] != sig[:-1]]
    new_class = new_sig | np.r_[True, extra["whole"][1:] != extra["whole"][:-1]]
    heads = np.flatnonzero(new_class)
    size = np.diff(np.r_[heads, len(sig)])
    of_class = np.cumsum(new_class) - 1
    of_sig = np.cumsum(new_sig) - 1
    classes = np.bincount(of_sig[heads], minlength=of_sig[-1] + 1)
    done = size[of_class] > 1
    if done.any():
        batch = X.spans(doc[done], (place - extra["back"])[done], ["doc_id", "value"], extra["n"][done])
        yield _tagged(0, batch)
    todo = new_class & (classes[of_sig] > 1)  # one of each class, where there are others
    if todo.any():
        yield _tagged(1, X.per_document(doc[todo], place[todo].astype(np.uint32), ["doc_id", "value"]))


def _tagged(kind, batch):
    return pa.RecordBatch.from_arrays([batch.column(0), pa.array(np.full(batch.num_rows, kind, dtype=np.int32)),
                                       batch.column(1)], names=["doc_id", "kind", "value"])


_OFFSET = np.dtype([("offset", "<i2"), ("id", "<u8")])  # offset from the pointer, in steps
_OPEN = np.dtype([("place", "<i4"), ("offset", "<i2"), ("code", "<u4"), ("id", "<u8")])


def _step(depth):
    return -(-depth // 4)


def _dealt(code, offset, n_buckets):
    """Bucket of a pointer's gram and an offset, so that a common gram is split."""
    return mix((code.astype(np.uint64) << np.uint64(16)) + offset.astype(np.int16).view(np.uint16).astype(np.uint64)) \
        % np.uint64(n_buckets)


def _counted(n):
    """0 .. n[0] - 1, 0 .. n[1] - 1, and so on, and to which each belongs."""
    each = np.repeat(np.arange(len(n)), n)
    return each, np.arange(len(each)) - np.repeat(np.cumsum(n) - n, n)


def _pair(first, later):
    return mix(first + mix(later))


def _emit_offsets(depth, gram, n_buckets):
    """First identifiers: the step's bytes at every offset that is a whole number of steps from its pointer."""
    step = _step(depth)

    def emit(batches):
        for part, ids, off, hashes, place, head, n, doc, code in _marked(batches, depth, gram):
            keep = _chosen(part, doc, place - off[doc], np.uint32) if len(doc) else np.zeros(0, dtype=bool)
            place, head, n, doc, code = (v[keep] for v in (place, head, n, doc, code))
            if not len(doc):
                continue
            first = -((place - head) // step)
            last = (head - place + n - 1 + depth - step) // step
            each, k = _counted(last - first + 1)
            extra = np.empty(len(each), dtype=_OFFSET)
            extra["offset"] = first[each] + k
            at = place[each] + (first[each] + k) * step
            extra["id"] = hashes(at, at + step)
            code, doc = code[each].astype(np.uint32), doc[each]
            yield X.packed(0, _dealt(code, extra["offset"], n_buckets), doc, ids, code, extra, n_buckets,
                           place[each] - off[doc])
    return emit


def _emit_pairs(n_buckets):
    """Pairs of an open offset's identifier with that of the next, where that is open too."""
    def emit(batches):
        for batch in batches:
            lists = [np.frombuffer(b"".join(m), dtype=_OPEN) for m in batch.column(1).to_pylist()]
            if not lists:
                continue
            ids = batch.column(0).to_numpy(zero_copy_only=False)
            doc = np.repeat(np.arange(len(lists)), [len(m) for m in lists])
            have = np.concatenate(lists)
            order = np.lexsort((have["offset"], have["place"], doc))
            doc, have = doc[order], have[order]
            both = np.flatnonzero((doc[1:] == doc[:-1]) & (have["place"][1:] == have["place"][:-1])
                                  & (have["offset"][1:] == have["offset"][:-1] + 1))
            if not len(both):
                continue
            extra = np.empty(len(both), dtype=_OFFSET)
            extra["offset"] = have["offset"][both]
            extra["id"] = _pair(have["id"][both], have["id"][both + 1])
            code = have["code"][both]
            yield X.packed(0, _dealt(code, extra["offset"], n_buckets), doc[both], ids, code, extra, n_buckets,
                           have["place"][both])
    return emit


def _open_offsets(batches):
    """Of one bucket: the offsets whose identifier occurs more than once, with the identifiers."""
    parts = [x[1:] for b in batches for x in X.unpacked(b, np.uint32, _OFFSET)]
    if not parts:
        return
    doc, code, extra, place = (np.concatenate([p[k] for p in parts]) for k in range(4))
    order = np.lexsort((extra["id"], extra["offset"], code))
    c, o, v = code[order], extra["offset"][order], extra["id"][order]
    head = np.r_[True, (c[1:] != c[:-1]) | (o[1:] != o[:-1]) | (v[1:] != v[:-1])]
    many = np.diff(np.r_[np.flatnonzero(head), len(c)])[np.cumsum(head) - 1] > 1
    if many.any():
        out = np.empty(int(many.sum()), dtype=_OPEN)
        out["place"], out["offset"], out["code"], out["id"] = place[order][many], o[many], c[many], v[many]
        yield X.per_document(doc[order][many], out, ["doc_id", "value"])


def _still_open(part, off, place, head, n, doc, depth):
    """Pointers with open offsets, and their suffixes all of whose offsets are open."""
    step = _step(depth)
    lists = [np.frombuffer(b"".join(m), dtype=_OPEN) for m in part.column(2).to_pylist()]
    owner = np.repeat(np.arange(len(lists)), [len(m) for m in lists])
    have = np.concatenate(lists)
    # a pointer's row: its text and place; a column per offset
    mine = doc.astype(np.int64) << 32 | (place - off[doc])
    row = np.searchsorted(mine, owner.astype(np.int64) << 32 | have["place"])
    low = depth // step + 1
    is_open = np.zeros((len(mine), 2 * low + 2), dtype=bool)
    is_open[row, have["offset"].astype(np.int64) + low] = True
    some = np.flatnonzero(is_open.any(axis=1))
    each, k = _counted(n[some])
    each = some[each]
    at = head[each] + k
    back = place[each] - at
    first = -(back // step)
    keep = np.ones(len(at), dtype=bool)
    for more in range((depth - 2 * step) // step + 1):
        inside = (first + more) * step <= depth - 2 * step - back
        keep &= ~inside | is_open[each, first + more + low]
    return each[keep], at[keep]


def _emit_suffixes(depth, gram, n_buckets):
    step = _step(depth)

    def emit(batches):
        for part, ids, off, hashes, place, head, n, doc, code in _marked(batches, depth, gram):
            if not len(doc):
                continue
            each, at = _still_open(part, off, place, head, n, doc, depth)
            if not len(each):
                continue

            def twice(i):
                return _pair(hashes(i, i + step), hashes(i + step, i + 2 * step))

            extra = np.empty(len(each), dtype=_SUFFIX)
            extra["offset"] = place[each] - at
            extra["pair"] = _pair(twice(at), twice(at + depth - 2 * step))
            code, doc = code[each], doc[each]
            # suffixes of one pointer go to several buckets by their offset, so that a common gram is split
            bucket = mix((code >> np.uint64(32)) + (extra["offset"] // 32).astype(np.uint64)) % np.uint64(n_buckets)
            yield X.packed(0, bucket, doc, ids, code.astype(np.uint32), extra, n_buckets, at - off[doc])
    return emit


def _repeats(batches):
    parts = [x[1:] for b in batches for x in X.unpacked(b, np.uint32, _SUFFIX)]
    if not parts:
        return
    doc, sig, extra, at = (np.concatenate([p[k] for p in parts]) for k in range(4))
    del parts
    order = np.lexsort((extra["pair"], sig.astype(np.uint64) << np.uint64(16) | extra["offset"]))
    s, o, p = sig[order], extra["offset"][order], extra["pair"][order]
    head = np.r_[True, (s[1:] != s[:-1]) | (o[1:] != o[:-1]) | (p[1:] != p[:-1])]
    size = np.diff(np.r_[np.flatnonzero(head), len(s)])
    many = size[np.cumsum(head) - 1] > 1
    if many.any():
        yield X.spans(doc[order][many], at[order][many].astype(np.int64), ["doc_id", "value"])


def _rewrite(depth):
    def apply(batches):
        for batch in batches:
            out = []
            for z, runs in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True):
                raw = X.unsqueeze(z)
                pairs = np.frombuffer(b"".join(runs or []), dtype="<i4").reshape(-1, 2)
                gone = X.covered(pairs, len(raw), depth)
                edges = np.flatnonzero(np.diff(np.r_[False, gone, False].astype(np.int8)))
                kept = np.frombuffer(raw, dtype=np.uint8)[~gone].tobytes() if len(edges) else raw
                out.append((len(raw), int(gone.sum()), kept, edges.tolist()))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([o[0] for o in out], pa.int64()), pa.array([o[1] for o in out], pa.int64()),
                 pa.array([o[3][::2] for o in out], pa.list_(pa.int64())),
                 pa.array([o[3][1::2] for o in out], pa.list_(pa.int64())), pa.array([o[2] for o in out], pa.binary())],
                names=["doc_id", "n_bytes", "n_removed", "starts", "ends", "kept"])
    return apply


def remove_repeated_bytes(docs: DataFrame, depth: int = DEPTH, gram: int | None = None) -> DataFrame:
    """``docs`` (doc_id, text) -> doc_id, n_bytes, n_removed, starts and ends of the removed runs, kept (binary)."""
    if depth < 4:
        raise ValueError("depth must be at least 4")
    gram = gram or max(1, min(GRAM, depth // 10))
    n = X.bucket_count(docs.sparkSession)
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("binary").alias("text"))
    marks = X.routed(docs.filter(F.col("doc_id").isNotNull()), _emit_pointers(depth, gram, n), _shared,
                     "doc_id long, marks binary", n)
    marks = marks.groupBy("doc_id").agg(F.collect_list("marks").alias("marks"))
    held = X.table(docs.join(marks, "doc_id", "left").select("doc_id", "text", "marks")
                   .mapInArrow(tidy(squeezed), "doc_id long, ztext binary, marks array<binary>"))
    touched = held.filter(F.col("marks").isNotNull())
    found = X.table(X.routed(touched, _emit_classes(depth, gram, n), _classes,
                             "doc_id long, kind int, value binary", n))
    todo = found.filter("kind = 1").groupBy("doc_id").agg(F.collect_list("value").alias("marks"))
    rest = touched.select("doc_id", "ztext").join(todo, "doc_id").select("doc_id", "ztext", "marks")
    opened = X.routed(rest, _emit_offsets(depth, gram, n), _open_offsets, "doc_id long, value binary", n)
    lists = opened.groupBy("doc_id").agg(F.collect_list("value").alias("marks"))
    opened = X.routed(lists, _emit_pairs(n), _open_offsets, "doc_id long, value binary", n)
    lists = opened.groupBy("doc_id").agg(F.collect_list("value").alias("marks"))
    rest = touched.select("doc_id", "ztext").join(lists, "doc_id").select("doc_id", "ztext", "marks")
    last = X.routed(rest, _emit_suffixes(depth, gram, n), _repeats, "doc_id long, value binary", n)
    spans = (found.filter("kind = 0").select("doc_id", "value").unionByName(last)
             .groupBy("doc_id").agg(F.collect_list("value").alias("spans")))
    schema = "doc_id long, n_bytes long, n_removed long, starts array<long>, ends array<long>, kept binary"
    judged = touched.select("doc_id", "ztext").join(spans, "doc_id", "left").mapInArrow(tidy(_rewrite(depth)), schema)
    plain = (held.filter(F.col("marks").isNull())
             .select("doc_id", "ztext", F.lit(None).cast("array<binary>").alias("spans"))
             .mapInArrow(tidy(_rewrite(depth)), schema))
    return judged.unionByName(plain)
