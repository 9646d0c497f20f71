"""Removal of word passages that an earlier document already has (fixed-block anchors).

A window is ``WINDOW`` consecutive words. Each document is cut into
non-overlapping blocks of ``BLOCK`` words; as ``2 * BLOCK - 1 < WINDOW``, every
window holds one whole block of its own document. So whatever a document shares
with another as a window, the other has an *anchor* there: a rolling BLOCK-word
run that equals an indexed block.

1. Index all blocks; probe them with every rolling run of BLOCK words. Runs and
   blocks travel as 32-bit codes within hash buckets (``exchange``), an anchor
   counts if two different documents are involved.
2. Documents get their anchors back. Each window around an anchor belongs to
   the first anchor inside it - the same one, at the same offset, wherever the
   window stands - and goes there with its 64-bit hash.
3. Equal windows of one anchor: all but those of the smallest document are
   marked. Runs of marked windows are the maximal exact repeats; the words they
   cover go.

A group of copies costs one entry per window and document; no pairs are made.
Equality is decided on 96 bits (window hash and anchor code); texts are whole.

Defined results: a null or empty text has no words; windows are judged on the
input; a row without ``doc_id`` can neither be earlier nor later than another
and keeps its text; repeated rows of one ``doc_id`` are one document and stay
alike. Other columns, whatever their names, are not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from casebook.llm import exchange as X
from casebook.llm.arrays import SLICE_BYTES, Runs, byte_runs, slices, tidy, utf8, window_starts, words

WINDOW = 50
BLOCK = 25


def _runs(off, data, width, block):
    """Word ranges by text, rolling block-run starts and hashes of texts with a whole window, texts of the starts."""
    starts, ends, by = words(off, data)
    hashes = Runs(byte_runs(data)(starts, ends))
    at = window_starts(by, block)
    doc = np.repeat(np.arange(len(off) - 1), np.diff(by))[at]
    long_enough = np.diff(by)[doc] >= width
    at, doc = at[long_enough], doc[long_enough]
    return starts, ends, by, hashes, at, doc


def _emit_anchors(width, block, n_buckets):
    def emit(batches):
        for part in slices(batches, size=SLICE_BYTES // 2):
            ids = part.column(0)
            off, data = utf8(part.column(1))
            _, _, by, hashes, at, doc = _runs(off, data, width, block)
            if not len(at):
                continue
            code = hashes(at, at + block)
            ids = ids.to_numpy(zero_copy_only=False)
            bucket = (code >> np.uint64(32)) % np.uint64(n_buckets)
            sig = code.astype(np.uint32)
            aligned = (at - by[doc]) % block == 0
            yield X.packed(0, bucket[aligned], doc[aligned], ids, sig[aligned], None, n_buckets)
            fresh = np.r_[True, (code[1:] != code[:-1]) | (doc[1:] != doc[:-1])]
            yield X.packed(1, bucket[fresh], doc[fresh], ids, sig[fresh], None, n_buckets)
    return emit


def _anchors(batches):
    """Of one bucket: which probing documents hit an indexed block that two documents have. A document's marks
    are the bucket, then the low bits of its blocks there."""
    index, owners, hits, hitters = [], [], [], []
    known = None

    def settle():
        sig = np.concatenate(index) if index else np.zeros(0, dtype=np.uint32)
        doc = np.concatenate(owners) if owners else np.zeros(0, dtype=np.int64)
        known, at = np.unique(sig, return_inverse=True)
        low = np.full(len(known), np.iinfo(np.int64).max)
        high = np.full(len(known), np.iinfo(np.int64).min)
        np.minimum.at(low, at, doc)
        np.maximum.at(high, at, doc)
        return known, low, high

    bucket = 0
    for batch in batches:
        if batch.num_rows:
            bucket = batch.column(0)[0].as_py()
        for kind, doc, sig, _, _ in X.unpacked(batch, np.uint32):
            if kind == 0:
                index.append(sig)
                owners.append(doc)
                continue
            if known is None:
                known, low, high = settle()
                index.clear()
                owners.clear()
            if not len(known):
                continue
            at = np.searchsorted(known, sig)
            at[at == len(known)] = 0
            found = known[at] == sig
            hits.append(at[found].astype(np.int32))
            hitters.append(doc[found])
    if hits:
        at, doc = np.concatenate(hits), np.concatenate(hitters)
        np.minimum.at(low, at, doc)
        np.maximum.at(high, at, doc)
        shared = low[at] != high[at]
        if shared.any():
            of = np.unique(doc[shared])
            yield X.per_document(np.r_[of, doc[shared]], np.r_[np.full(len(of), bucket, dtype=np.uint32),
                                                               known[at[shared]]], ["doc_id", "marks"])


def _emit_windows(width, block, n_buckets):
    def emit(batches):
        for part in slices(_unsqueezed(batches), "text", SLICE_BYTES // 2):
            ids = part.column(0).to_numpy(zero_copy_only=False)
            off, data = utf8(part.column(1))
            # bucket and low bits of each mark, and the document that has it
            marks = [[np.frombuffer(x, dtype=np.uint32).astype(np.uint64) for x in m] for m in part.column(2).to_pylist()]
            marks = [np.concatenate([x[1:] | x[:1] << np.uint64(32) for x in m]) for m in marks]
            starts, _, by, hashes, at, doc = _runs(off, data, width, block)
            if not len(at):
                continue
            code = hashes(at, at + block)
            every, place = np.unique(np.concatenate(marks), return_inverse=True)
            owner = np.repeat(np.arange(len(marks)), [len(m) for m in marks])
            whole = ((code >> np.uint64(32)) % np.uint64(n_buckets)) << np.uint64(32) | (code & np.uint64(0xFFFFFFFF))
            spot = np.minimum(np.searchsorted(every, whole), len(every) - 1)
            anchor = (every[spot] == whole) & np.isin(doc.astype(np.int64) << 32 | spot, owner.astype(np.int64) << 32 | place)
            # the first anchor at or after each word, by word number
            total = len(starts)
            after = np.full(total + 1, total + width, dtype=np.int64)
            after[at[anchor]] = at[anchor]
            after = np.minimum.accumulate(after[::-1])[::-1]
            first = after[at]
            ours = (first + block <= at + width) & (at + width <= by[doc + 1])
            at, doc, first = at[ours], doc[ours], first[ours]
            if not len(at):
                continue
            code = hashes(first, first + block)
            bucket = (code >> np.uint64(32)) % np.uint64(n_buckets)
            yield X.packed(0, bucket, doc, ids, code.astype(np.uint32), hashes(at, at + width), n_buckets, at - by[doc])
    return emit


def _unsqueezed(batches):
    for batch in batches:
        texts = [X.unsqueeze(z) for z in batch.column(1).to_pylist()]
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.binary()), batch.column(2)],
                                         names=["doc_id", "text", "marks"])


def _repeats(batches):
    """Of one bucket: windows that a smaller document has, as runs by document."""
    parts = [x[1:] for b in batches for x in X.unpacked(b, np.uint32, np.uint64)]
    if not parts:
        return
    doc, sig, code, at = (np.concatenate([p[k] for p in parts]) for k in range(4))
    del parts
    order = np.lexsort((doc, sig, code))
    h, s, d = code[order], sig[order], doc[order]
    head = np.r_[True, (h[1:] != h[:-1]) | (s[1:] != s[:-1])]
    earliest = d[np.flatnonzero(head)][np.cumsum(head) - 1]
    late = d > earliest
    if late.any():
        yield X.spans(d[late], at[order][late].astype(np.int64), ["doc_id", "spans"])


def _rewrite(width, normalise):
    def apply(batches):
        for batch in batches:
            ids, ztexts, spans = (batch.column(i).to_pylist() for i in range(3))
            out = []
            for z, runs in zip(ztexts, spans, strict=True):
                raw = X.unsqueeze(z)
                off, data = X.as_texts([raw])
                starts, ends, _ = words(off, data)
                pairs = np.frombuffer(b"".join(runs or []), dtype="<i4").reshape(-1, 2)
                gone = X.covered(pairs, len(starts), width)
                removed = int(gone.sum())
                if removed or normalise:
                    raw = b" ".join(raw[a:b] for a, b in zip(starts[~gone].tolist(), ends[~gone].tolist(), strict=True))
                out.append((len(starts), removed, raw))
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids, pa.int64()), pa.array([o[0] for o in out], pa.int64()),
                 pa.array([o[1] for o in out], pa.int64()), pa.array([o[2].decode() for o in out], pa.string())],
                names=["doc_id", "n_words", "n_removed", "kept"])
    return apply


def squeezed(batches):
    """doc_id, text (binary), marks -> the same with the text compressed; a null text counts as empty."""
    for batch in batches:
        texts = [X.squeeze(t or b"") for t in batch.column(1).to_pylist()]
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.binary()), batch.column(2)],
                                         names=["doc_id", "ztext", "marks"])


def remove_repeats(docs: DataFrame, width: int = WINDOW, normalise: bool = True) -> DataFrame:
    """``docs`` (doc_id, text) -> doc_id, n_words, n_removed, kept (the text that is left).

    Kept words are joined by one space; with ``normalise=False`` a text that
    loses nothing stays as it was (null becomes empty)."""
    block = width // 2
    n = X.bucket_count(docs.sparkSession)
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("binary").alias("text"))
    marks = X.routed(docs.filter(F.col("doc_id").isNotNull()), _emit_anchors(width, block, n), _anchors,
                     "doc_id long, marks binary", n)
    marks = marks.groupBy("doc_id").agg(F.collect_list("marks").alias("marks"))
    held = X.table(docs.join(marks, "doc_id", "left").select("doc_id", "text", "marks")
                   .mapInArrow(tidy(squeezed), "doc_id long, ztext binary, marks array<binary>"))
    touched = held.filter(F.col("marks").isNotNull())
    spans = X.routed(touched, _emit_windows(width, block, n), _repeats, "doc_id long, spans binary", n)
    spans = spans.groupBy("doc_id").agg(F.collect_list("spans").alias("spans"))
    schema = "doc_id long, n_words long, n_removed long, kept string"
    apply = tidy(_rewrite(width, normalise))
    judged = touched.select("doc_id", "ztext").join(spans, "doc_id", "left").mapInArrow(apply, schema)
    rest = (held.filter(F.col("marks").isNull())
            .select("doc_id", "ztext", F.lit(None).cast("array<binary>").alias("spans")).mapInArrow(apply, schema))
    return judged.unionByName(rest)
