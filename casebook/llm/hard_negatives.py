"""Hard negatives by an inverted multi-index.

Components become ``floor(scale * x)`` and scores integers. Every vector is cut
into two halves; a codebook for either half (k-means on a bounded sample) makes a
grid of cells, and each shard of vectors is laid out by cell. For a query, a
cell's score is at most the sum of two half scores: the query half times the
code, plus the length of the query half times the largest distance of the
shard's members to that code. A heap visits the grid by falling sums
(multi-sequence), so the visit may stop as soon as no later cell can matter:

* positives: an anchor has its ``k`` best rows of its label, and the next bound
  lies below the last of them;
* negatives: for each positive, the best ``k`` rows of other labels with scores
  in ``[low % of, positive score]`` are certified once the next bound lies
  below the window or below the last of ``k`` rows found in it.

Bounds are exact for every row (radii are taken over all members, whatever the
sample was), so the result is exact. Shards stay where they are; blocks of
queries, the smaller side, come to each shard in waves of bounded size. A task
carries what it has found from shard to shard, so it returns at most ``k`` rows
for a query and window.

Defined results: rows whose id, label or vector is null, or whose vector is empty or holds a
null, NaN or infinity, take no part; vectors of another length than the anchor's
are no candidates; a row with the anchor's own id is none either. Repeated rows
count once per row, but an anchor or positive id once: of repeated anchors the
smallest (label, vector) counts, of a repeated positive its highest score. Ties go to the smaller id. Other columns are ignored.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from casebook.llm import exchange as X
from casebook.llm import topk
from casebook.llm.arrays import tidy

SCALE = 256
K = 5
LOW = 80  # percent of the positive's score from which a negative is hard
SAMPLE = 4096  # vectors that the codebooks are fitted on, those with the smallest hashes of their ids
CODES = 8  # codes of a half: cells of some SHARD / 64 vectors, so that a visit is one matrix product worth its call
SHARD = 16384  # vectors in a shard
BLOCK = 256  # anchors in a block
WAVE_BYTES = 8 << 20  # query blocks that come to all shards at once

ROWS = "vec_id long, label int, v array<double>"
SHARDS = ("dim int, ids binary, labels binary, matrix binary, cells binary, starts binary, codes binary, radii binary, "
          "split int")
PAIRS = "anchor_id long, vec_id long, score long"
FOUND = "anchor_id long, positive_id long, positive_score long, negative_id long, negative_score long"


def prepared(vectors: DataFrame, scale: int = SCALE) -> DataFrame:
    """(vec_id, label, embedding) -> ROWS that take part, components as whole numbers."""
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("label").cast("int").alias("label"),
                          F.col("embedding").cast("array<double>").alias("e"))
    rows = rows.select("vec_id", "label", topk.scaled(F.col("e"), scale).alias("v"))
    return rows.filter("vec_id is not null and label is not null and v is not null")


def centres(x: np.ndarray, k: int, rounds: int = 8) -> np.ndarray:
    """k-means; starts at rows spread over the sample's order."""
    if not x.shape[1] or not len(x):
        return np.zeros((1, x.shape[1]))
    c = np.unique(x[np.linspace(0, len(x) - 1, k).astype(int)], axis=0)
    for _ in range(rounds):
        at = nearest(x, c)
        n = np.bincount(at, minlength=len(c))
        c = np.stack([np.bincount(at, x[:, d], len(c)) for d in range(x.shape[1])], axis=1)[n > 0] / n[n > 0, None]
    return c


def nearest(x: np.ndarray, c: np.ndarray) -> np.ndarray:
    return np.argmin((c ** 2).sum(axis=1)[None, :] - 2 * (x @ c.T), axis=1)


def codebooks(rows: DataFrame, sample: int = SAMPLE, codes: int = CODES) -> dict[int, tuple[np.ndarray, np.ndarray]]:
    """Per vector length two codebooks, from at most ``sample`` vectors."""
    got = rows.orderBy(F.xxhash64("vec_id"), "vec_id").limit(sample).select("vec_id", "v").toArrow()
    by: dict[int, list] = {}
    for k, v in sorted(zip(got.column(0).to_pylist(), got.column(1).to_pylist(), strict=True)):
        by.setdefault(len(v), []).append(v)
    out = {}
    for dim, vs in by.items():
        x = np.array(vs)
        out[dim] = centres(x[:, :dim // 2], codes), centres(x[:, dim // 2:], codes)
    return out


def _gathered(batches: Iterator[pa.RecordBatch], size: int, make):
    """Rows of one length to ``make`` in groups of ``size``."""
    held: dict[int, list] = {}
    for batch in batches:
        off = batch.column(2).offsets.to_numpy()
        flat = batch.column(2).values.to_numpy(zero_copy_only=False)
        for k, (i, label) in enumerate(zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True)):
            v = flat[off[k]:off[k + 1]]
            rows = held.setdefault(len(v), [])
            rows.append((i, label, v))
            if len(rows) == size:
                yield make(held.pop(len(v)))
    for dim in list(held):
        yield make(held.pop(dim))


def _columns(rows):
    ids, labels, vs = zip(*rows, strict=True)
    return np.array(ids, dtype=np.int64), np.array(labels, dtype=np.int32), np.stack(vs)


def _shards(books, size):
    def make(rows):
        ids, labels, m = _columns(rows)
        dim = m.shape[1]
        half = dim // 2
        pair = books.get(dim, (np.zeros((1, half)), np.zeros((1, dim - half))))
        at = [nearest(part, c) for part, c in zip((m[:, :half], m[:, half:]), pair, strict=True)]
        far = [np.zeros(len(c)) for c in pair]
        for r, a, part, c in zip(far, at, (m[:, :half], m[:, half:]), pair, strict=True):
            np.maximum.at(r, a, np.sqrt(((part - c[a]) ** 2).sum(axis=1)))
        cell = at[0] * len(pair[1]) + at[1]
        order = np.lexsort((ids, cell))
        cells, starts = np.unique(cell[order], return_index=True)
        raw = (ids[order], labels[order], m[order], cells.astype(np.int64), np.r_[starts, len(ids)].astype(np.int64),
               np.concatenate([c.ravel() for c in pair]), np.concatenate(far))
        return pa.RecordBatch.from_arrays([pa.array([dim], pa.int32()), *(pa.array([x.tobytes()], pa.binary()) for x in raw),
                                           pa.array([len(pair[0])], pa.int32())],
                                          names=[c.split()[0] for c in SHARDS.split(", ")])
    return lambda batches: _gathered(batches, size, make)


class Shard:
    def __init__(self, row: dict):
        self.dim, self.split = row["dim"], row["split"]
        self.ids, self.labels = np.frombuffer(row["ids"], np.int64), np.frombuffer(row["labels"], np.int32)
        self.m = np.frombuffer(row["matrix"]).reshape(len(self.ids), self.dim)
        self.top = float(np.abs(self.m).max())
        cells, starts = (np.frombuffer(row[c], np.int64) for c in ("cells", "starts"))
        half, flat, radii = self.dim // 2, np.frombuffer(row["codes"]), np.frombuffer(row["radii"])
        self.codes = (flat[:self.split * half].reshape(self.split, half), flat[self.split * half:].reshape(-1, self.dim - half))
        self.radii = radii[:self.split], radii[self.split:]
        width = len(self.codes[1])
        self.rows = {(int(c) // width, int(c) % width): (int(a), int(b))
                     for c, a, b in zip(cells, starts[:-1], starts[1:], strict=True)}
        used = [np.zeros(len(c), dtype=bool) for c in self.codes]
        for i, j in self.rows:
            used[0][i] = used[1][j] = True
        self.used = [np.flatnonzero(u) for u in used]

    def halves(self, q: np.ndarray) -> list[np.ndarray]:
        """Upper bounds of each query's (rows of ``q``) half scores with the members of every code."""
        h = self.dim // 2
        return [part @ c.T + np.sqrt((part ** 2).sum(axis=1))[:, None] * r[None, :]
                for part, c, r in zip((q[:, :h], q[:, h:]), self.codes, self.radii, strict=True)]

    def visit(self, first: np.ndarray, second: np.ndarray):
        """(bound, first and last row) of the cells by falling bounds: a heap over two sorted sequences."""
        a, b = (u[np.argsort(-s[u], kind="stable")] for u, s in zip(self.used, (first, second), strict=True))
        x, y = first[a].tolist(), second[b].tolist()
        a, b = a.tolist(), b.tolist()
        heap = [(-(x[0] + y[0]), 0, 0)]
        while heap:
            bound, i, j = heapq.heappop(heap)
            if j + 1 < len(y):
                heapq.heappush(heap, (-(x[i] + y[j + 1]), i, j + 1))
            if j == 0 and i + 1 < len(x):  # each cell has one way into the heap
                heapq.heappush(heap, (-(x[i + 1] + y[0]), i + 1, 0))
            at = self.rows.get((a[i], b[j]))
            if at:
                yield _over(-bound), at

    def scores(self, at: tuple[int, int], q: np.ndarray) -> np.ndarray:
        if self.top * float(np.abs(q).max()) * self.dim >= 2 ** 53:
            return self.m[at[0]:at[1]].astype(np.int64) @ q.astype(np.int64)
        return self.m[at[0]:at[1]] @ q  # whole numbers, exact in floating point


def _over(bound: float) -> int:
    """A whole number that no score under a bound computed in floating point passes."""
    return int(np.floor(bound + 1e-6 * abs(bound) + 1e-3))


def _better(best: list, ids: np.ndarray, scores: np.ndarray, k: int) -> list:
    """The ``k`` highest of (score, id) lists, ties to smaller ids; as (-score, id) in order."""
    if len(best) == k:
        good = scores >= -best[-1][0]
        ids, scores = ids[good], scores[good]
    if not len(ids):
        return best
    if len(ids) > k:
        keep = np.lexsort((ids, -scores))[:k]
        ids, scores = ids[keep], scores[keep]
    return sorted([*best, *zip((-scores.astype(np.int64)).tolist(), ids.tolist(), strict=True)])[:k]


def _positives(k):
    def run(batches):
        best: dict[int, list] = {}
        for shard, asked in _met(batches):
            bounds = shard.halves(asked["matrix"])
            for n, (anchor, label) in enumerate(zip(asked["ids"].tolist(), asked["labels"].tolist(), strict=True)):
                found, q = best.get(anchor, []), asked["matrix"][n]
                for bound, at in shard.visit(bounds[0][n], bounds[1][n]):
                    if len(found) == k and bound < -found[-1][0]:
                        break
                    s = shard.scores(at, q)
                    # only rows that could come among the k best are looked at further
                    on = np.flatnonzero(s >= -found[-1][0]) if len(found) == k else np.arange(len(s))
                    if len(on):
                        ids = shard.ids[at[0]:at[1]][on]
                        good = (shard.labels[at[0]:at[1]][on] == label) & (ids != anchor)
                        found = _better(found, ids[good], s[on][good], k)
                best[anchor] = found
        yield _rows([(a, i, -s) for a, found in best.items() for s, i in found], PAIRS)
    return run


def _negatives(k, low):
    def run(batches):
        best: dict[int, list] = {}  # anchor -> its positives (score, id, rows found), highest first
        for shard, asked in _met(batches):
            bounds = shard.halves(asked["matrix"])
            for n, (anchor, label) in enumerate(zip(asked["ids"].tolist(), asked["labels"].tolist(), strict=True)):
                if anchor not in best:
                    best[anchor] = [[s, i, -(-low * s // 100), []] for i, s in asked["positives"][n]]
                windows = [w for w in best[anchor] if w[2] <= w[0]]
                q, open_ = asked["matrix"][n], windows
                for bound, at in shard.visit(bounds[0][n], bounds[1][n]) if windows else ():
                    # certified: nothing later lies in the window, or above the last of k rows in it
                    open_ = [w for w in open_ if bound >= w[2] and (len(w[3]) < k or bound >= -w[3][-1][0])]
                    if not open_:
                        break
                    s = shard.scores(at, q)
                    least = min(w[2] if len(w[3]) < k else max(w[2], -w[3][-1][0]) for w in open_)
                    on = np.flatnonzero((s >= least) & (s <= max(w[0] for w in open_)))
                    if len(on):
                        ids = shard.ids[at[0]:at[1]][on]
                        good = (shard.labels[at[0]:at[1]][on] != label) & (ids != anchor)
                        ids, s = ids[good], s[on][good]
                        for w in open_ if len(s) else ():
                            inside = (s >= w[2]) & (s <= w[0])
                            if inside.any():
                                w[3] = _better(w[3], ids[inside], s[inside], k)
        yield _rows([(a, i, s, neg, -score) for a, ws in best.items() for s, i, _, found in ws for score, neg in found], FOUND)
    return run


def _rows(rows, schema):
    names = [c.split()[0] for c in schema.split(", ")]
    table = np.array(rows, dtype=np.int64).reshape(len(rows), len(names))
    return pa.RecordBatch.from_arrays([pa.array(np.ascontiguousarray(table[:, k])) for k in range(len(names))], names=names)


def _met(batches):
    """(shard, query block) pairs; a shard comes once with all blocks of the wave."""
    for batch in batches:
        for r in range(batch.num_rows):
            row = {c: batch.column(c)[r].as_py() for c in batch.schema.names if c != "asked"}
            shard = Shard(row)
            for block in batch.column("asked")[r].as_py():
                ids = np.frombuffer(block["ids"], np.int64)
                pos = block.get("positives")
                yield shard, {"ids": ids, "labels": np.frombuffer(block["labels"], np.int32),
                              "matrix": np.frombuffer(block["matrix"]).reshape(len(ids), shard.dim),
                              "positives": pos and [[(p["vec_id"], p["score"]) for p in x or []] for x in pos]}


BLOCKS = ("wave long, dim int, ids binary, labels binary, matrix binary, "
          "positives array<array<struct<vec_id:long,score:long>>>")


def _blocks(batches):
    """Rows (vec_id, label, v, positives) -> blocks; a task's blocks are cut into waves by their running size."""
    task, done = TaskContext.get().partitionId() << 32, 0
    positives: dict[int, list] = {}

    def noted():
        for batch in batches:
            positives.update(zip(batch.column(0).to_pylist(), batch.column(3).to_pylist(), strict=True))
            yield batch

    def make(rows):
        nonlocal done
        ids, labels, m = _columns(rows)
        wave = task | done // WAVE_BYTES
        done += m.nbytes
        return pa.RecordBatch.from_arrays(
            [pa.array([wave], pa.int64()), pa.array([m.shape[1]], pa.int32()),
             *(pa.array([x.tobytes()], pa.binary()) for x in (ids, labels, m)),
             pa.array([[positives.pop(r[0]) for r in rows]],
                      pa.list_(pa.list_(pa.struct([("vec_id", pa.int64()), ("score", pa.int64())]))))],
            names=[c.split()[0] for c in BLOCKS.split(", ")])
    return _gathered(noted(), BLOCK, make)


def _waves(shards: DataFrame, asked: DataFrame, step, schema: str) -> DataFrame:
    """``step`` over every shard with the queries (vec_id, label, v, positives) of its vector length, whose blocks come
    in waves of WAVE_BYTES and one block at most."""
    blocks = X.table(asked.select("vec_id", "label", "v", "positives").mapInArrow(tidy(_blocks), BLOCKS))
    out = None
    for (wave,) in blocks.select("wave").distinct().orderBy("wave").collect():  # one row a wave
        asked = (blocks.filter(F.col("wave") == wave).groupBy("dim")
                 .agg(F.collect_list(F.struct("ids", "labels", "matrix", "positives")).alias("asked")))
        got = X.table(shards.join(F.broadcast(asked), "dim").mapInArrow(tidy(step), schema))
        out = got if out is None else out.unionByName(got)
    return out if out is not None else shards.sparkSession.createDataFrame([], schema)


def mine(vectors: DataFrame, anchors: DataFrame, k: int = K, low: int = LOW, scale: int = SCALE) -> DataFrame:
    """``vectors`` and ``anchors`` (vec_id, label, embedding) -> anchor_id, positive_id, rank (from 1), negative_id,
    positive_score, negative_score."""
    rows = prepared(vectors, scale)
    shards = X.table(rows.mapInArrow(tidy(_shards(codebooks(rows), SHARD)), SHARDS))
    asked = prepared(anchors, scale).groupBy("vec_id").agg(F.min(F.struct("label", "v")).alias("r")).select("vec_id", "r.*")
    asked = X.table(asked.select("vec_id", "label", "v", F.lit(None).cast("array<struct<vec_id:long,score:long>>").alias("positives")))
    found = _waves(shards, asked, _positives(k), PAIRS)
    order = Window.partitionBy("anchor_id").orderBy(F.desc("score"), "vec_id")
    best = found.withColumn("r", F.row_number().over(order)).filter(F.col("r") <= k)
    best = best.groupBy("anchor_id", "vec_id").agg(F.min("r").alias("r"), F.max("score").alias("score"))
    lists = best.groupBy("anchor_id").agg(F.sort_array(F.collect_list(F.struct("r", "vec_id", "score"))).alias("p"))  # k at most
    lists = lists.select(F.col("anchor_id").alias("vec_id"), F.transform(
        "p", lambda x: F.struct(x["vec_id"].alias("vec_id"), x["score"].alias("score"))).alias("positives"))
    # anchors without a positive have nothing to return
    hard = _waves(shards, asked.drop("positives").join(lists, "vec_id"), _negatives(k, low), FOUND)
    order = Window.partitionBy("anchor_id", "positive_id").orderBy(F.desc("negative_score"), "negative_id")
    return (hard.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
            .select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"))
