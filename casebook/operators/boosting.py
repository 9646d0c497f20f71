"""Search over boosted trees, its fits spread over the cluster.

A grid of tree counts, depths and feature shares in k folds is many small fits.
As Spark ML jobs (one per tree level) they cost a fraction of a second a tree
whatever the rows, so a search runs here the other way round: a bounded set of
labelled rows (``FIT_ROWS``, those with the smallest hashes of the id) is binned
once, and each (depth, share, fold) is one row of a job table and one Spark
task. The ensembles of 50, 100 and 150 trees of such a task are prefixes of one
fit, scored as the trees are added: 27 settings in 4 folds are 36 fits.

Trees minimise the second-order logistic objective level by level over
histograms; a tree sees a share of the features drawn for that tree. Scores of
the fitted ensemble are computed for every row of a table, in Arrow batches.

Defined results: rows without label or id take no part; NaN features count as
larger than every cut; a fold without validation rows adds no accuracy; equal accuracies go to the
first setting; without any labelled row all scores are 0.5.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field
from itertools import product

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

FIT_ROWS = 10_000  # labelled rows used by a search and its final fit
BINS = 32
# Fixed values of the usual second-order booster: step, ridge on leaf values, least curvature of a child.
ETA, RIDGE, LEAST_CURVATURE = 0.3, 1.0, 1.0


@dataclass
class Binned:
    """Codes of the fitting rows (rows x features), and each feature's cuts (code = cuts below the value)."""
    codes: np.ndarray
    cuts: list[np.ndarray]

    def __post_init__(self):
        width = np.array([len(c) + 1 for c in self.cuts], dtype=np.int64)
        self.first = np.r_[0, np.cumsum(width)]  # where a feature's bins begin
        self.usual = np.array([np.searchsorted(c, 0.0) for c in self.cuts], dtype=np.uint8)
        self.row, self.feature = np.nonzero(self.codes != self.usual)
        self.bin = self.first[self.feature] + self.codes[self.row, self.feature]


def cut_points(column: np.ndarray, bins: int = BINS) -> np.ndarray:
    """Between all distinct values, or between quantiles where there are more than ``bins``."""
    values = np.unique(column[~np.isnan(column)])
    if len(values) > bins:
        values = np.unique(np.quantile(column[~np.isnan(column)], np.linspace(0, 1, bins), method="nearest"))
    return (values[1:] + values[:-1]) / 2


def binned(x: np.ndarray, bins: int = BINS) -> Binned:
    cuts = [cut_points(x[:, k], bins) for k in range(x.shape[1])]
    codes = np.stack([np.searchsorted(c, x[:, k]) for k, c in enumerate(cuts)], axis=1).astype(np.uint8) \
        if cuts else np.zeros((len(x), 0), dtype=np.uint8)
    return Binned(codes, cuts)


@dataclass
class Trees:
    """All trees' nodes end to end: feature (-1: leaf), bin and value of the cut, first child (the second follows), leaf value."""
    feature: list = field(default_factory=list)
    bin: list = field(default_factory=list)
    cut: list = field(default_factory=list)
    child: list = field(default_factory=list)
    value: list = field(default_factory=list)
    roots: list = field(default_factory=list)

    def arrays(self):
        return [np.array(a, dtype=t) for a, t in ((self.feature, np.int32), (self.cut, np.float64),
                                                  (self.child, np.int32), (self.value, np.float64), (self.roots, np.int32))]


def _level(data: Binned, node: np.ndarray, m: int, g: np.ndarray, h: np.ndarray, allowed: np.ndarray):
    """Best (gain, bin) of each of ``m`` nodes; ``node`` is a row's node or -1."""
    open_ = node >= 0
    total = [np.bincount(node[open_], w[open_], m) for w in (g, h)]
    inside = open_[data.row]
    key = node[data.row[inside]] * data.first[-1] + data.bin[inside]
    left = []
    for w, t in zip((g, h), total, strict=True):
        cells = np.bincount(key, w[data.row[inside]], m * data.first[-1]).reshape(m, -1)
        cells[:, data.first[:-1] + data.usual] += t[:, None] - np.add.reduceat(cells, data.first[:-1], axis=1)
        run = np.cumsum(cells, axis=1)
        before = np.concatenate([np.zeros((m, 1)), run[:, data.first[1:-1] - 1]], axis=1)
        left.append(run - np.repeat(before, np.diff(data.first), axis=1))
    (gl, hl), (gt, ht) = left, total
    gr, hr = gt[:, None] - gl, ht[:, None] - hl
    gain = gl ** 2 / (hl + RIDGE) + gr ** 2 / (hr + RIDGE) - (gt ** 2 / (ht + RIDGE))[:, None]
    gain[(hl < LEAST_CURVATURE) | (hr < LEAST_CURVATURE)] = -np.inf
    gain[:, ~np.repeat(allowed, np.diff(data.first))] = -np.inf
    gain[:, data.first[1:] - 1] = -np.inf  # nothing lies right of the last bin
    best = np.argmax(gain, axis=1)
    return gain[np.arange(m), best], best, gt, ht


def grow(data: Binned, label: np.ndarray, use: np.ndarray, depth: int, share: float, lengths: Sequence[int], seed: int):
    """Trees fitted on the rows ``use``, and the margins of all rows at each of ``lengths`` trees."""
    n, n_features = data.codes.shape
    margin, out, trees = np.zeros(n), {}, Trees()
    owner = np.repeat(np.arange(n_features), np.diff(data.first))
    for t in range(max(lengths)):
        p = 1 / (1 + np.exp(-margin))
        g, h = np.where(use, p - label, 0.0), np.where(use, p * (1 - p), 0.0)
        allowed = np.zeros(n_features, dtype=bool)
        k = max(1, int(round(share * n_features))) if n_features else 0
        allowed[np.random.default_rng([seed, t]).choice(n_features, k, replace=False)] = True
        place = np.full(n, len(trees.feature))  # a row's node among all nodes
        trees.roots.append(len(trees.feature))
        ids = [len(trees.feature)]
        _add(trees, 1)
        node = np.zeros(n, dtype=np.int64)
        for d in range(depth + 1):
            m = len(ids)
            if d < depth and n_features:
                gain, best, gt, ht = _level(data, node, m, g, h, allowed)
            else:
                open_ = node >= 0
                gt, ht = (np.bincount(node[open_], w[open_], m) for w in (g, h))
                gain, best = np.full(m, -np.inf), np.zeros(m, dtype=np.int64)
            split = gain > 1e-9
            nxt = np.full(m, -1, dtype=np.int64)
            nxt[split] = 2 * np.arange(int(split.sum()))
            base = len(trees.feature)
            for j, at in enumerate(ids):
                trees.value[at] = float(-ETA * gt[j] / (ht[j] + RIDGE))
                if split[j]:
                    f = int(owner[best[j]])
                    b = int(best[j] - data.first[f])
                    trees.feature[at], trees.bin[at], trees.cut[at] = f, b, float(data.cuts[f][b])
                    trees.child[at] = base + int(nxt[j])
            _add(trees, 2 * int(split.sum()))
            ids = list(range(base, len(trees.feature)))
            if not ids:
                break
            go = np.flatnonzero((node >= 0) & (np.r_[split, False][node]))
            at = node[go]
            right = data.codes[go, owner[best[at]]] > (best - data.first[owner[best]])[at]
            here = nxt[at] + right
            node[:] = -1
            node[go] = here
            place[go] = base + here
        margin += np.array(trees.value)[place]
        if t + 1 in lengths:
            out[t + 1] = margin.copy()
    return trees, out


def _add(trees: Trees, n: int) -> None:
    for a, v in ((trees.feature, -1), (trees.bin, 0), (trees.cut, 0.0), (trees.child, -1), (trees.value, 0.0)):
        a.extend([v] * n)


def margins(x: np.ndarray, arrays: list[np.ndarray]) -> np.ndarray:
    """Summed leaf values of each row of ``x``."""
    feature, cut, child, value, roots = arrays
    total, rows = np.zeros(len(x)), np.arange(len(x))
    for root in roots:
        node = np.full(len(x), root)
        while True:
            f = feature[node]
            inner = f >= 0
            if not inner.any():
                break
            right = ~(x[rows, np.maximum(f, 0)] <= cut[node])
            node = np.where(inner, child[node] + right, node)
        total += value[node]
    return total


@dataclass
class BoostedModel:
    """A fitted ensemble; ``transform`` adds probability (of 1) and prediction (1 from 0.5 up)."""
    arrays: list
    features: str

    def transform(self, df: DataFrame, probability: str = "probability", prediction: str = "prediction") -> DataFrame:
        from pyspark.ml.functions import vector_to_array
        arrays = self.arrays

        @F.arrow_udf("double")
        def score(column: pa.Array) -> pa.Array:
            flat = column.flatten().to_numpy(zero_copy_only=False)
            x = flat.reshape(len(column), -1) if len(column) else np.zeros((0, 1))
            return pa.array(1 / (1 + np.exp(-margins(x, arrays))))

        out = df.withColumn(probability, score(vector_to_array(F.col(self.features))))
        return out.withColumn(prediction, (F.col(probability) >= 0.5).cast("double"))


@dataclass
class Search:
    """Settings in grid order, their mean accuracies over the folds, and the best one fitted on all fitting rows."""
    settings: list[dict]
    avgMetrics: list[float]
    bestIndex: int
    bestModel: BoostedModel
    fits: int

    def results(self, spark) -> DataFrame:
        """One row per setting: parameters, mean accuracy, best (true once)."""
        rows = [({k: str(v) for k, v in s.items()}, float(a), j == self.bestIndex)
                for j, (s, a) in enumerate(zip(self.settings, self.avgMetrics, strict=True))]
        return spark.createDataFrame(rows, "setting map<string,string>, accuracy double, best boolean")


def share_of(strategy) -> float:
    return 1.0 if strategy == "all" else float(strategy)


def fitting_rows(train: DataFrame, id_col: str, features: str, label: str, fold: str, rows: int):
    """At most ``rows`` labelled rows, in the order of their ids' hashes: (matrix, labels, folds)."""
    from pyspark.ml.functions import vector_to_array
    entry = F.filter(F.transform(vector_to_array(F.col(features)), lambda x, k: F.struct(k.alias("k"), x.alias("x"))),
                     lambda e: e["x"] != 0)
    df = train.filter(F.col(id_col).isNotNull() & F.col(label).isNotNull())
    df = df.orderBy(F.xxhash64(id_col), id_col).limit(rows).select(
        F.size(vector_to_array(F.col(features))).alias("width"), entry.alias("entries"), F.col(label).cast("double").alias("y"),
        F.col(fold).cast("int").alias("fold"), F.xxhash64(id_col).alias("h"), F.col(id_col).alias("id"))
    got = df.orderBy("h", "id").toArrow()
    entries = got.column("entries").combine_chunks()
    n = got.num_rows
    x = np.zeros((n, got.column("width")[0].as_py() if n else 0))
    size = np.diff(entries.offsets.to_numpy())
    flat = entries.flatten()
    x[np.repeat(np.arange(n), size), flat.field("k").to_numpy()] = flat.field("x").to_numpy(zero_copy_only=False)
    return x, got.column("y").to_numpy(), got.column("fold").to_numpy()


def search(train: DataFrame, id_col: str, grid: dict, features: str = "features", label: str = "label",
           fold: str = "fold", folds: int = 4, seed: int = 1, rows: int = FIT_ROWS) -> Search:
    """Mean accuracy over ``folds`` folds of every setting of ``grid`` (maxIter, maxDepth, featureSubsetStrategy:
    shares or "all"), and the best one fitted on all fitting rows."""
    spark = train.sparkSession
    settings = [dict(zip(grid, v, strict=True)) for v in product(*grid.values())]
    x, y, part = fitting_rows(train, id_col, features, label, fold, rows)
    data = binned(x)
    lengths = sorted({int(s["maxIter"]) for s in settings})
    kinds = sorted({(int(s["maxDepth"]), share_of(s["featureSubsetStrategy"])) for s in settings})
    jobs = [(d, s, f) for d, s in reversed(kinds) for f in range(folds)]  # the deep ones, which take longest, first

    def run(batches):
        for batch in batches:
            for job in batch.to_pylist():
                use = part != job["fold"]
                _, at = grow(data, y, use, job["depth"], job["share"], lengths, seed)
                scored = {k: float(((m >= 0) == (y == 1))[~use].mean()) if (~use).any() else None for k, m in at.items()}
                yield pa.RecordBatch.from_pylist(
                    [{"depth": job["depth"], "share": job["share"], "fold": job["fold"], "trees": k, "accuracy": a}
                     for k, a in scored.items()],
                    schema=pa.schema([("depth", pa.int32()), ("share", pa.float64()), ("fold", pa.int32()),
                                      ("trees", pa.int32()), ("accuracy", pa.float64())]))

    table = spark.createDataFrame(jobs, "depth int, share double, fold int").repartitionById(len(jobs), _position(jobs))
    found = table.mapInArrow(run, "depth int, share double, fold int, trees int, accuracy double")
    mean = {(r["depth"], r["share"], r["trees"]): r["a"] for r in
            found.groupBy("depth", "share", "trees").agg(F.avg("accuracy").alias("a")).collect()}
    metrics = [mean[int(s["maxDepth"]), share_of(s["featureSubsetStrategy"]), int(s["maxIter"])] or 0.0 for s in settings]
    best = int(np.argmax(metrics))
    chosen = settings[best]

    def final(batches):
        for _ in batches:
            trees, _ = grow(data, y, np.ones(len(y), dtype=bool), int(chosen["maxDepth"]),
                            share_of(chosen["featureSubsetStrategy"]), [int(chosen["maxIter"])], seed)
            yield pa.RecordBatch.from_pydict({"a": pa.array([a.tobytes() for a in trees.arrays()], pa.binary())})

    parts = [r["a"] for r in spark.range(1).repartition(1).mapInArrow(final, "a binary").collect()]
    types = (np.int32, np.float64, np.int32, np.float64, np.int32)
    arrays = [np.frombuffer(raw, dtype=t) for raw, t in zip(parts, types, strict=True)]
    return Search(settings, metrics, best, BoostedModel(arrays, features), len(jobs))


def _position(jobs: list[tuple]):
    """The place of a job in the list, so that each gets a task of its own."""
    out = F.lit(None).cast("int")
    for k, (d, s, f) in enumerate(jobs):
        out = F.when((F.col("depth") == d) & (F.col("share") == s) & (F.col("fold") == f), k).otherwise(out)
    return out
