"""Packing token sequences into bins of a fixed size (minimum bin slack).

Items of one length are alike, so a corpus is its histogram of lengths - at most
``capacity`` numbers, however many documents there are. On that histogram, per
bin: the longest item left is put in, and a bitset subset-sum over the lengths
left finds the fullest combination for the rest of the bin. The combination is
then removed as many times as the counts allow, so the number of combinations
follows the number of lengths and not that of bins.

Each item finds its bin by its number among the items of its length: tasks
number what they write, a running sum over (length, task) counts makes that
global, and the combinations (a small table) say which numbers go where.
"""

from __future__ import annotations

import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from casebook.llm import exchange as X
from casebook.llm import tokens
from casebook.llm.arrays import tidy

CAPACITY = 2048
END = 0


def _pieces(path, capacity, end):
    def cut(batches):
        encode = tokens.encoder(path)
        task = TaskContext.get().partitionId()
        seen = np.zeros(capacity + 1, dtype=np.int64)
        for batch in batches:
            for part in tokens.groups([batch], 1):
                ids, off = encode(part.column(1))
                size = np.diff(off) + 1
                n = -(-size // capacity)
                doc = np.repeat(np.arange(len(size)), n)
                piece = np.arange(len(doc)) - np.repeat(np.cumsum(n) - n, n)
                head = (size - 1) % capacity + 1  # the first piece takes what the whole pieces leave
                start = np.where(piece == 0, 0, head[doc] + (piece - 1) * capacity)
                length = np.where(piece == 0, head[doc], capacity)
                last = np.array([end], dtype="<u4").tobytes()
                crc = np.empty(len(doc), dtype=np.int64)
                flat = memoryview(np.ascontiguousarray(ids, dtype="<u4")).cast("B")
                lo = (off[doc] + start) * 4
                hi = np.minimum(lo + length * 4, off[doc + 1] * 4)
                closing = piece == n[doc] - 1
                for k, (a, b, c) in enumerate(zip(lo.tolist(), hi.tolist(), closing.tolist(), strict=True)):
                    crc[k] = zlib.crc32(last, zlib.crc32(flat[a:b])) if c else zlib.crc32(flat[a:b])
                order = np.argsort(length, kind="stable")
                sorted_length = length[order]
                run = np.flatnonzero(np.r_[True, sorted_length[1:] != sorted_length[:-1]]) if len(order) else order
                nth = np.empty(len(doc), dtype=np.int64)
                counts = np.diff(np.r_[run, len(order)])
                nth[order] = np.arange(len(order)) - np.repeat(run, counts) + seen[sorted_length]
                seen[sorted_length[run]] += counts
                yield pa.RecordBatch.from_arrays(
                    [part.column(0).take(pa.array(doc)), pa.array(piece.astype(np.int32)), pa.array(start), pa.array(length),
                     pa.array(crc), pa.array(np.full(len(doc), task, dtype=np.int32)), pa.array(nth)],
                    names=["doc_id", "piece", "start", "length", "ids_crc32", "task", "nth"])
        tokens.forget()
    return cut


def fullest(counts: dict[int, int], room: int) -> Counter:
    """The combination of available lengths with the largest sum not over ``room`` (bitset subset-sum)."""
    reach, mask, goal = 1, (1 << (room + 1)) - 1, 1 << room
    steps = []
    for length in sorted((x for x in counts if x <= room and counts[x] > 0), reverse=True):
        steps.append((length, reach))
        for _ in range(min(counts[length], room // length)):
            wider = reach | (reach << length) & mask
            if wider == reach:
                break
            reach = wider
            if reach & goal:
                break
        if reach & goal:
            break
    left, chosen = reach.bit_length() - 1, Counter()
    for length, before in reversed(steps):
        while not before >> left & 1:
            left -= length
            chosen[length] += 1
    return chosen


def combinations(histogram: dict[int, int], capacity: int) -> list[tuple[Counter, int]]:
    """Minimum bin slack on a histogram of lengths: (lengths of a bin, number of such bins), in order."""
    counts = {x: n for x, n in histogram.items() if n}
    out = []
    while counts:
        longest = max(counts)
        left = dict(counts)
        left[longest] -= 1
        chosen = fullest(left, capacity - longest)
        chosen[longest] += 1
        times = min(counts[x] // n for x, n in chosen.items())
        for x, n in chosen.items():
            counts[x] -= n * times
            if not counts[x]:
                del counts[x]
        out.append((chosen, times))
    return out


def placements(plan: list[tuple[Counter, int]]) -> list[tuple[int, int, int, int, int, int]]:
    """Rows (length, first, stop, each, bin, offset): items number first..stop-1 of this length go to bins from
    ``bin`` on, ``each`` to a bin, the first of them at ``offset``."""
    used: Counter = Counter()
    rows, bin_ = [], 0
    for chosen, times in plan:
        offset = 0
        for length in sorted(chosen, reverse=True):
            n = chosen[length]
            rows.append((length, used[length], used[length] + n * times, n, bin_, offset))
            used[length] += n * times
            offset += n * length
        bin_ += times
    return rows


def pack(docs: DataFrame, path: str, capacity: int = CAPACITY, end: int = END) -> DataFrame:
    """``docs`` (doc_id, text) -> doc_id, piece, start, length, ids_crc32, sequence_id, offset.

    A document is the ids of its text and then ``end``; a null or empty text is
    ``end`` alone. Only documents over ``capacity`` are cut, into pieces of
    ``capacity`` of which the first may be shorter. Rows without ``doc_id`` and
    repeated rows are packed like all others. Other columns are not read."""
    spark = docs.sparkSession
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    pieces = X.table(docs.mapInArrow(
        tidy(_pieces(path, capacity, end)),
        "doc_id long, piece int, start long, length long, ids_crc32 long, task int, nth long"))
    by_task = pieces.groupBy("length", "task").agg(F.count(F.lit(1)).alias("n"))
    before = Window.partitionBy("length").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    by_task = by_task.select("length", "task", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    # at most ``capacity`` rows
    histogram = {r["length"]: r["n"] for r in pieces.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()}
    rows = placements(combinations(histogram, capacity))
    places = spark.createDataFrame(rows, "at long, first long, stop long, each long, bin long, place long")
    numbered = (pieces.join(by_task, ["length", "task"])
                .withColumn("number", F.col("base") + F.col("nth")))
    here = (F.col("length") == F.col("at")) & (F.col("number") >= F.col("first")) & (F.col("number") < F.col("stop"))
    if len(rows) * 48 <= 16 << 20:  # bytes of the table; the row count is bounded by the lengths, not by the corpus
        places = F.broadcast(places)
    ahead = F.col("number") - F.col("first")
    return numbered.join(places, here).select(
        "doc_id", "piece", "start", "length", "ids_crc32",
        (F.col("bin") + F.floor(ahead / F.col("each"))).alias("sequence_id"),
        (F.col("place") + (ahead % F.col("each")) * F.col("length")).alias("offset"))
