"""Exact top-k search by inner product (distributed histogram selection).

Components become ``floor(scale * x)`` and scores integers. Query vectors and
candidate vectors are laid out in blocks; every pair of a query block and a
candidate block is scored by one matrix product. Rounds of it refine, for each
query, the interval that holds its k-th highest score: each task counts its
scores in BINS parts of the interval, sums over all tasks say in which part the
k-th lies, and the next round divides that part, down to a single score. A last
round keeps what lies above that score, and of the ties at it each task's
smallest ids; a rank over these few rows orders them.

Scores are exact: products run in float64 while no partial sum can pass 2 ** 53,
else in integers. Nothing grows with a tie or a group of equal vectors but counts.

Defined results: vectors that are null, empty, or hold a null, NaN or infinity
take no part, nor do rows without id; vectors of another length than a query's
are no candidates of it; a row is no candidate of a query with its own id, so
repeated rows of an id do not find each other; equal (id, score) rows count once
per row in the k-th value and come out once per row.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from casebook.llm import exchange as X

SCALE = 1024
K = 10
BINS = 1 << 14
QUERIES, ROWS = 256, 2048  # vectors in a block


def scaled(vector: Column, scale: int) -> Column:
    """Integer components as an array of double (whole numbers), null for vectors that take no part."""
    bad = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return F.when((F.size(vector) > 0) & ~bad, F.transform(vector, lambda x: F.floor(x * scale).cast("double")))


def _blocks(size):
    """Rows (id, v) -> blocks (dim, ids, matrix, largest squared length); rows of one length in a block."""
    def cut(batches):
        held: dict[int, list] = {}

        def block(dim):
            ids, rows = zip(*held.pop(dim), strict=True)
            m = np.stack(rows)
            return pa.RecordBatch.from_pydict({
                "dim": pa.array([dim], pa.int32()), "ids": pa.array([np.array(ids, dtype=np.int64).tobytes()], pa.binary()),
                "matrix": pa.array([m.tobytes()], pa.binary()), "top": pa.array([float(np.abs(m).max())], pa.float64())})

        for batch in batches:
            ids = batch.column(0).to_pylist()
            off = batch.column(1).offsets.to_numpy()
            flat = batch.column(1).values.to_numpy(zero_copy_only=False)
            for k, doc in enumerate(ids):
                v = flat[off[k]:off[k + 1]]
                held.setdefault(len(v), []).append((doc, v))
                if len(held[len(v)]) == size:
                    yield block(len(v))
        for dim in list(held):
            yield block(dim)
    return cut


BLOCK = "dim int, ids binary, matrix binary, top double"


def _scores(q: np.ndarray, c: np.ndarray) -> np.ndarray:
    """Integer scores (queries x candidates)."""
    if np.abs(q).max() * np.abs(c).max() * q.shape[1] < 2 ** 53:
        return (q @ c.T).astype(np.int64)
    return q.astype(np.int64) @ c.T.astype(np.int64)


def _pairs(batches):
    """Query ids, candidate ids, scores and the query block's state of each pair of blocks."""
    for batch in batches:
        for r in batch.to_pylist():
            q_ids, c_ids = (np.frombuffer(r[x], dtype=np.int64) for x in ("q_ids", "ids"))
            q, c = (np.frombuffer(r[x]).reshape(-1, r["dim"]) for x in ("q_matrix", "matrix"))
            yield q_ids, c_ids, _scores(q, c), r


def _counts(bins):
    """Scores of each query by part of its interval [low, low + bins * width); a row per query and part."""
    def count(batches):
        for q_ids, c_ids, s, r in _pairs(batches):
            low, width = (np.frombuffer(r[x], dtype=np.int64)[:, None] for x in ("low", "width"))
            part = (s - low) // width
            good = (part >= 0) & (part < bins) & (q_ids[:, None] != c_ids[None, :])
            flat = (np.arange(len(q_ids))[:, None] * bins + part)[good]
            found, n = np.unique(flat, return_counts=True)
            yield pa.RecordBatch.from_arrays(
                [pa.array(q_ids[found // bins]), pa.array((found % bins).astype(np.int32)), pa.array(n.astype(np.int64))],
                names=["query_id", "part", "n"])
    return count


def _above(k):
    """Scores over each query's k-th, and per task of those equal to it the ``k`` smallest ids."""
    def keep(batches):
        for q_ids, c_ids, s, r in _pairs(batches):
            low = np.frombuffer(r["low"], dtype=np.int64)[:, None]
            other = q_ids[:, None] != c_ids[None, :]
            order = np.argsort(c_ids, kind="stable")
            ties = ((s == low) & other)[:, order]
            ties &= np.cumsum(ties, axis=1) <= k
            chosen = (s > low) & other
            chosen[:, order] |= ties
            at, of = np.nonzero(chosen)
            yield pa.RecordBatch.from_arrays([pa.array(q_ids[at]), pa.array(c_ids[of]), pa.array(s[at, of])],
                                             names=["query_id", "vec_id", "score"])
    return keep


def top_k(vectors: DataFrame, queries: DataFrame, k: int = K, scale: int = SCALE, bins: int = BINS) -> DataFrame:
    """``vectors`` and ``queries`` (vec_id, embedding) -> query_id, rank (from 1), vec_id, score."""
    spark = vectors.sparkSession

    def prepared(df):
        rows = df.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("e"))
        return rows.select("vec_id", scaled(F.col("e"), scale).alias("v")).filter("vec_id is not null and v is not null")

    # queries of one id count once
    blocks = X.table(prepared(vectors).mapInArrow(_blocks(ROWS), BLOCK))
    asked = X.table(prepared(queries).dropDuplicates(["vec_id"]).mapInArrow(_blocks(QUERIES), BLOCK)
                    .withColumn("block", F.monotonically_increasing_id()))
    ends = blocks.agg(F.max("top").alias("c")).first()["c"], asked.agg(F.max("top"), F.max("dim")).first()
    empty = spark.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    if ends[0] is None or ends[1][0] is None:
        return empty
    # every candidate block meets every query block of its length: the stated query set against all rows
    ask = asked.select("block", "dim", F.col("ids").alias("q_ids"), F.col("matrix").alias("q_matrix"))
    meets = asked.groupBy("dim").agg(F.collect_list("block").alias("blocks"))
    spread = max(X.bucket_count(spark), 2 * spark.sparkContext.defaultParallelism)
    dealt = (blocks.join(meets, "dim").select("ids", "matrix", F.explode("blocks").alias("block"))
             .join(ask, "block").select("block", "dim", "ids", "matrix", "q_ids", "q_matrix"))
    dealt = dealt.repartition(spread, "block", F.xxhash64("ids"))

    bound = int(ends[0] * ends[1][0] * ends[1][1])  # no score is larger
    width = 1
    while width * bins < 2 * bound + 1:
        width *= bins
    members = asked.select("block", F.col("ids").alias("q_ids"))
    state = members.mapInArrow(_start(-bound, width, k), _STATE)
    schema = "query_id long, part int, n long"
    while True:
        state = X.table(state)
        seen = dealt.join(_states(state), "block").mapInArrow(_counts(bins), schema)
        seen = seen.groupBy("query_id", "part").agg(F.sum("n").alias("n"))
        parts = seen.groupBy("query_id").agg(F.array_sort(F.collect_list(F.struct((-F.col("part")).alias("part"), "n")))
                                             .alias("parts"))  # at most ``bins`` entries
        state = X.table(state.join(parts, "query_id", "left").select("block", "at", "query_id", *_refined(width, bins)))
        if width == 1:
            break
        width //= bins
        state = state.withColumn("width", F.lit(width).cast("long"))
    found = dealt.join(_states(state), "block").mapInArrow(_above(k), "query_id long, vec_id long, score long")
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (found.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))


_STATE = "block long, at int, query_id long, low long, width long, want long"


def _start(low, width, k):
    """The first interval of each query: all scores; ``want`` of them are still to be found in it."""
    def make(batches):
        for batch in batches:
            for block, ids in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                ids = np.frombuffer(ids.as_buffer(), dtype=np.int64)
                n = len(ids)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(n, block)), pa.array(np.arange(n, dtype=np.int32)), pa.array(ids),
                     pa.array(np.full(n, low)), pa.array(np.full(n, width)), pa.array(np.full(n, k))],
                    names=[c.split()[0] for c in _STATE.split(", ")])
    return make


def _states(state: DataFrame) -> DataFrame:
    """Per query block, low and width of its queries in the block's order (binary)."""
    listed = state.groupBy("block").agg(F.array_sort(F.collect_list(F.struct("at", "low", "width"))).alias("s"))

    def pack(batches):
        for batch in batches:
            rows = batch.column(1).to_pylist()
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *(pa.array([np.array([x[c] for x in r], dtype=np.int64).tobytes() for r in rows],
                                             pa.binary()) for c in ("low", "width"))], names=["block", "low", "width"])
    return listed.mapInArrow(pack, "block long, low binary, width binary")


def _refined(width, bins):
    """The part with the ``want``-th highest score becomes the interval; with fewer scores than wanted, the lowest part."""
    walked = F.aggregate(
        F.coalesce("parts", F.array().cast("array<struct<part:int,n:bigint>>")),
        F.struct(F.lit(0).cast("int").alias("part"), F.col("want").cast("long").alias("want"), F.lit(False).alias("done")),
        lambda a, x: F.when(a["done"], a).when(x["n"] >= a["want"], F.struct(
            (-x["part"]).alias("part"), a["want"].alias("want"), F.lit(True).alias("done"))).otherwise(F.struct(
                a["part"].alias("part"), (a["want"] - x["n"]).alias("want"), F.lit(False).alias("done"))))
    # without a k-th score the interval moves to the bottom, where everything is above it
    return [F.when(walked["done"], F.col("low") + walked["part"] * width)
            .otherwise(F.col("low") - (bins if width > 1 else 1)).cast("long").alias("low"),
            F.lit(width).cast("long").alias("width"),
            F.when(walked["done"], walked["want"]).otherwise(1 << 62).cast("long").alias("want")]
