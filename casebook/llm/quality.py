"""Quality rules: an isolation forest on rule statistics.

Each text gets the counts of the usual rules (words, symbols, repeated lines,
repeated three-word windows, capitals, exclamation marks). An isolation forest
learns from all labelled rows how such counts split at random: the shorter a
text's mean path to a leaf, the more it stands apart. As the method has it, each
tree is grown on ``SUBSAMPLE`` rows, drawn anew from all of them. Statistics are
drawn for a split by how well each alone ranks all labelled bad rows against all
good ones. The threshold is the one that separates the labelled rows best while
keeping ``KEEP`` of the good ones. Texts under the hard rules (too few words,
mostly repeated windows) go without a verdict.

Ranks come from running counts over range partitions; the driver gets one number
a statistic, the trees' rows (``TREES`` x ``SUBSAMPLE``) and the threshold.

Defined results: a null or empty text has no words and fails the hard rules;
without labelled good rows nothing but the hard rules applies; without bad ones
all statistics count alike and the threshold is the highest score of a good row. Repeated rows are judged
alike; they count as often as they are there, but a tree draws a row and its copies once.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from casebook.llm import exchange as X
from casebook.llm.arrays import ROW_BYTES, Runs, byte_runs, mix, release, slices, tidy, utf8, window_starts, words

TREES, SUBSAMPLE = 128, 64
KEEP = 0.99  # of the labelled good rows
MIN_WORDS, MAX_REPEAT_PERCENT = 50, 50

# Fixed value: the characters that count as symbols.
SYMBOLS = b"#*$%&|<>"
COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_capitals", "n_marks")

_SYMBOL = np.zeros(256, dtype=bool)
_SYMBOL[list(SYMBOLS)] = True
_CAPITAL = np.zeros(256, dtype=bool)
_CAPITAL[65:91] = True


def _sums(mask: np.ndarray) -> np.ndarray:
    out = np.zeros(len(mask) + 1, dtype=np.int64)
    np.cumsum(mask, out=out[1:])
    return out


def _twice(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Which entries have a key that occurs twice or more, and which are not the first of their key."""
    order = np.argsort(keys, kind="stable")
    k = keys[order]
    same = k[1:] == k[:-1]
    many, later = np.zeros(len(keys), dtype=bool), np.zeros(len(keys), dtype=bool)
    many[order[1:][same]] = True
    many[order[:-1][same]] = True
    later[order[1:][same]] = True
    return many, later


def counts(off: np.ndarray, data: np.ndarray) -> np.ndarray:
    """COUNTS of each text (n x 8)."""
    n = len(off) - 1
    starts, ends, by = words(off, data)
    salt = mix(np.arange(1, n + 1, dtype=np.uint64))
    letters = _sums((data & 0xC0) != 0x80)
    inside = _sums(letters[ends] - letters[starts])
    hashes = Runs(byte_runs(data)(starts, ends))
    doc = np.repeat(np.arange(n), np.diff(by))
    at = window_starts(by, 3)
    many, _ = _twice(hashes(at, at + 3) ^ salt[doc[at]])
    change = np.zeros(len(starts) + 1, dtype=np.int64)
    np.add.at(change, at[many], 1)
    np.add.at(change, at[many] + 3, -1)
    repeated = _sums(np.cumsum(change[:-1]) > 0)
    # lines with a word
    breaks = np.flatnonzero(data == 10)
    edge = np.union1d(np.r_[breaks + 1], off)
    line_lo = edge[:-1]
    line_hi = edge[1:].copy()
    line_hi -= (data[line_hi - 1] == 10).astype(np.int64) if len(line_hi) else 0
    full = np.searchsorted(starts, line_hi) > np.searchsorted(starts, line_lo)
    line_lo, line_hi = line_lo[full], line_hi[full]
    line_doc = np.searchsorted(off, line_lo, side="right") - 1
    _, later = _twice(byte_runs(data)(line_lo, line_hi) ^ salt[line_doc])
    out = np.empty((n, len(COUNTS)), dtype=np.int64)
    out[:, 0] = np.diff(by)
    out[:, 1] = np.diff(inside[by])
    out[:, 2] = np.diff(_sums(_SYMBOL[data])[off])
    out[:, 3] = np.bincount(line_doc[later], minlength=n)
    out[:, 4] = np.diff(repeated[by])
    out[:, 5] = np.bincount(line_doc, minlength=n)
    out[:, 6] = np.diff(_sums(_CAPITAL[data])[off])
    out[:, 7] = np.diff(_sums(data == 33)[off])
    return out


def features(c: np.ndarray) -> np.ndarray:
    """Shares that do not depend on a text's length."""
    c = c.astype(np.float64)
    n_words, chars, lines = (np.maximum(c[:, k], 1) for k in (0, 1, 5))
    return np.stack([c[:, 1] / n_words, c[:, 2] / n_words, c[:, 3] / lines, c[:, 4] / n_words, c[:, 6] / chars,
                     c[:, 7] / n_words], axis=1)


def hard(c: np.ndarray) -> np.ndarray:
    return (c[:, 0] < MIN_WORDS) | (100 * c[:, 4] > MAX_REPEAT_PERCENT * c[:, 0])


def _usual_path(n: int) -> float:
    """Mean path length of an unsuccessful search in a binary tree of n entries."""
    return 0.0 if n < 2 else 2 * (np.log(n - 1) + 0.5772156649) - 2 * (n - 1) / n


@dataclass
class Forest:
    """Trees as arrays: per node its feature (-1: leaf), split value, children, and the path length up to a leaf."""
    feature: np.ndarray
    value: np.ndarray
    left: np.ndarray
    right: np.ndarray
    path: np.ndarray
    roots: np.ndarray
    usual: float
    threshold: float = np.inf

    def scores(self, x: np.ndarray) -> np.ndarray:
        """2 ** -(mean path / usual path): near 1 for texts that stand apart."""
        total = np.zeros(len(x))
        rows = np.arange(len(x))
        for root in self.roots:
            node = np.full(len(x), root)
            while True:
                f = self.feature[node]
                open_ = f >= 0
                if not open_.any():
                    break
                go_left = x[rows, np.maximum(f, 0)] < self.value[node]
                node = np.where(open_, np.where(go_left, self.left[node], self.right[node]), node)
            total += self.path[node]
        return np.exp2(-total / len(self.roots) / self.usual) if len(self.roots) else np.zeros(len(x))


def grow(samples: list[np.ndarray], weights: np.ndarray, seed: int = 7) -> Forest:
    """An isolation tree for each sample; a split's statistic is drawn by ``weights`` among those that still differ."""
    rng = np.random.default_rng(seed)
    weights = weights + 1e-6
    nodes: list[list] = []

    def node(rows, depth, limit):
        here = len(nodes)
        nodes.append([-1, 0.0, -1, -1, depth + _usual_path(len(rows))])
        low, high = rows.min(axis=0), rows.max(axis=0)
        live = np.flatnonzero(high > low)
        if depth < limit and len(live):
            f = int(rng.choice(live, p=weights[live] / weights[live].sum()))
            split = float(rng.uniform(low[f], high[f]))
            less = rows[:, f] < split
            if less.any() and not less.all():
                nodes[here][:2] = [f, split]
                nodes[here][2] = node(rows[less], depth + 1, limit)
                nodes[here][3] = node(rows[~less], depth + 1, limit)
        return here

    size = max((len(rows) for rows in samples), default=0)
    roots = [node(rows, 0, max(1, int(np.ceil(np.log2(max(size, 2))))) + 4) for rows in samples if len(rows)]
    cols = list(zip(*nodes, strict=True)) if nodes else [[]] * 5
    return Forest(np.array(cols[0], dtype=np.int64), np.array(cols[1], dtype=float), np.array(cols[2], dtype=np.int64),
                  np.array(cols[3], dtype=np.int64), np.array(cols[4], dtype=float), np.array(roots, dtype=np.int64),
                  max(_usual_path(size), 1e-9))


def _labelled(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """COUNTS of every labelled text over the hard rules; ``good`` and ``bad``: how many such rows have that label."""
    marked = labels.filter(F.col("doc_id").isNotNull() & F.col("quality").isNotNull()).groupBy(
        F.col("doc_id").cast("long").alias("doc_id")).agg(F.min("quality").cast("int").alias("quality"))
    # counts are made where the texts are, so that no text moves
    counted = (docs.select(F.col("doc_id").cast("long").alias("doc_id"), rule_counts(F.col("text").cast("string")).alias("c"))
               .filter(F.col("doc_id").isNotNull()).select("doc_id", "c.*").groupBy("doc_id", *COUNTS)
               .agg(F.count(F.lit(1)).alias("n")))
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))
    one = F.col("quality") == 1
    rows = X.table(counted.join(marked, "doc_id").select(
        "doc_id", *COUNTS, F.when(one, F.col("n")).otherwise(0).alias("good"), F.when(one, 0).otherwise(F.col("n")).alias("bad")))
    return rows.filter(~failed)  # before the table it would be pushed to the texts, and counts be made twice


def _statistics(batch: pa.RecordBatch) -> np.ndarray:
    return features(np.stack([batch.column(k).to_numpy() for k in COUNTS], axis=1))


def _ranked(rows: DataFrame) -> DataFrame:
    """Rows (k, value, good, bad) -> one row per k and value, with the numbers of good and bad rows before it."""
    values = rows.groupBy("k", "value").agg(F.sum("good").alias("good"), F.sum("bad").alias("bad"))
    values = X.table(values.repartitionByRange("k", "value").withColumn("part", F.spark_partition_id()))
    parts = values.groupBy("k", "part").agg(F.sum("good").alias("all_good"), F.sum("bad").alias("all_bad"))
    past = Window.partitionBy("k").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # a row per partition
    parts = parts.select("k", "part", *(F.coalesce(F.sum(f"all_{c}").over(past), F.lit(0)).alias(f"start_{c}")
                                        for c in ("good", "bad")))
    inside = Window.partitionBy("k", "part").orderBy("value").rowsBetween(Window.unboundedPreceding, -1)
    return values.join(F.broadcast(parts), ["k", "part"]).select(
        "k", "value", "good", "bad", *((F.col(f"start_{c}") + F.coalesce(F.sum(c).over(inside), F.lit(0))).alias(f"{c}_before")
                                       for c in ("good", "bad")))


def separation(rows: DataFrame) -> np.ndarray:
    """Per statistic, the square of twice its distance from a random ranking of bad against good rows (ties count half)."""
    def emit(batches):
        for batch in batches:
            x = _statistics(batch)
            n, width = x.shape
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.tile(np.arange(width, dtype=np.int32), n)), pa.array(x.ravel()),
                 *(pa.array(np.repeat(batch.column(c).to_numpy(), width)) for c in ("good", "bad"))],
                names=["k", "value", "good", "bad"])

    ranked = _ranked(rows.mapInArrow(tidy(emit), "k int, value double, good long, bad long"))
    # whole numbers: twice the pairs in which the bad row has the higher value; up to 4e18 of them
    sums = ranked.groupBy("k").agg(
        F.sum((F.col("bad") * (2 * F.col("good_before") + F.col("good"))).cast("decimal(38,0)")).alias("higher"),
        F.sum("good").alias("good"), F.sum("bad").alias("bad")).orderBy("k").collect()
    return np.array([(float(r["higher"]) / (r["good"] * r["bad"]) - 1) ** 2 if r["good"] and r["bad"] else 1.0 for r in sums])


_DRAWN = ["tree", "key", *(f"f{k}" for k in range(6))]


def _least(table: np.ndarray, key: np.ndarray, n: int) -> np.ndarray:
    """Which ``n`` rows have the least keys, equal ones by their statistics."""
    return np.lexsort((*table.T, key))[:n]


def draw(rows: DataFrame, trees: int = TREES, subsample: int = SUBSAMPLE) -> list[np.ndarray]:
    """For each tree the statistics of ``subsample`` of all rows (all, if fewer): those with the least hashes of
    document and tree, whatever the partitions."""
    salts = mix(np.arange(1, trees + 1, dtype=np.uint64))

    def pick(batches):
        held = [(np.zeros(0, dtype=np.uint64), np.zeros((0, 6)))] * trees
        for batch in batches:
            x = _statistics(batch)
            base = mix(batch.column("doc_id").to_numpy().astype(np.uint64))
            for t, salt in enumerate(salts):
                key = mix(base ^ salt)
                if len(held[t][0]) == subsample:
                    near = key <= held[t][0][-1]
                elif len(key) > subsample:
                    near = key <= np.partition(key, subsample - 1)[subsample - 1]
                else:
                    near = np.ones(len(key), dtype=bool)
                key, table = np.r_[held[t][0], key[near]], np.r_[held[t][1], x[near]]
                first = _least(table, key, subsample)
                held[t] = key[first], table[first]
        key, table = (np.concatenate([h[i] for h in held]) for i in (0, 1))
        tree = np.repeat(np.arange(trees, dtype=np.int32), [len(h[0]) for h in held])
        yield pa.RecordBatch.from_arrays([pa.array(tree), pa.array(key.view(np.int64)), *map(pa.array, np.ascontiguousarray(table.T))],
                                         names=_DRAWN)

    def meet(table: pa.Table) -> pa.Table:
        x = np.stack([table.column(c).to_numpy() for c in _DRAWN[2:]], axis=1)
        return table.take(pa.array(_least(x, table.column("key").to_numpy().view(np.uint64), subsample)))

    schema = "tree int, key long, " + ", ".join(f"{c} double" for c in _DRAWN[2:])
    # a tree's group has ``subsample`` rows a task at most
    got = rows.mapInArrow(tidy(pick), schema).groupBy("tree").applyInArrow(meet, schema).toArrow()
    table = np.stack([got.column(c).to_numpy() for c in _DRAWN[2:]], axis=1)
    tree, key = got.column("tree").to_numpy(), got.column("key").to_numpy().view(np.uint64)
    return [table[at][_least(table[at], key[at], subsample)] for at in (np.flatnonzero(tree == t) for t in range(trees))]


def calibrate(rows: DataFrame, forest: Forest, keep: float = KEEP) -> float:
    """The score over which rows are rejected: best difference of rejected bad and rejected good shares among
    thresholds that keep ``keep`` of the good rows."""
    def emit(batches):
        for batch in batches:
            score = forest.scores(_statistics(batch))
            yield pa.RecordBatch.from_arrays([pa.array(np.zeros(len(score), dtype=np.int32)), pa.array(score),
                                              batch.column("good"), batch.column("bad")], names=["k", "value", "good", "bad"])

    ranked = X.table(_ranked(rows.mapInArrow(tidy(emit), "k int, value double, good long, bad long")))
    has_good = F.col("good") > 0
    whole = ranked.agg(F.sum("good").alias("good"), F.sum("bad").alias("bad"),
                       F.max(F.when(has_good, F.col("value"))).alias("top")).first()
    if not whole["good"]:
        return np.inf
    if not whole["bad"]:
        return whole["top"]
    place = (whole["good"] - 1) * keep
    low = int(place)

    def at(k):
        return F.max(F.when((F.col("good_before") <= k) & (F.col("good_before") + F.col("good") > k), F.col("value")))

    a, b = ranked.agg(at(low).alias("a"), at(min(low + 1, whole["good"] - 1)).alias("b")).first()
    floor = a + (b - a) * (place - low)

    def gain(bad, good):
        return bad / whole["bad"] - good / whole["good"]

    over = ranked.filter(F.col("value") > floor).agg(F.sum("bad").alias("bad"), F.sum("good").alias("good")).first()
    best = ranked.filter((F.col("value") >= floor) & ((F.col("bad") > 0) | (F.col("value") == whole["top"]))).agg(F.max(F.struct(
        gain(whole["bad"] - F.col("bad_before") - F.col("bad"), whole["good"] - F.col("good_before") - F.col("good")).alias("gain"),
        (-F.col("value")).alias("lower")))).first()[0]
    return floor if gain(over["bad"] or 0, over["good"] or 0) >= best["gain"] else -best["lower"]


def fit(docs: DataFrame, labels: DataFrame) -> Forest:
    """Forest and threshold from all labelled documents (labels: doc_id, quality 0 or 1)."""
    rows = _labelled(docs, labels)
    if rows.isEmpty():
        return grow([], np.zeros(0))
    forest = grow(draw(rows), separation(rows))
    forest.threshold = calibrate(rows, forest)
    return forest


def rule_counts(text: Column) -> Column:
    """COUNTS of a text as a struct."""
    @F.arrow_udf(", ".join(f"{c} long" for c in COUNTS))
    def run(column: pa.Array) -> pa.Array:
        parts = [counts(*utf8(part.column(0))) for part in _parts(column)]
        release()
        return _struct(parts, COUNTS)
    return run(text)


def _parts(column: pa.Array):
    return slices([pa.RecordBatch.from_arrays([column], names=["text"])], size=ROW_BYTES)


def _struct(parts: list[np.ndarray], names, more: dict | None = None) -> pa.Array:
    table = np.concatenate(parts) if parts else np.zeros((0, len(names)), dtype=np.int64)
    arrays = [pa.array(np.ascontiguousarray(table[:, k])) for k in range(len(names))]
    return pa.StructArray.from_arrays(arrays + list((more or {}).values()), names=[*names, *(more or {})])


def verdicts(text: Column, forest: Forest) -> Column:
    """Struct: COUNTS, base_failed, score (how far apart the text stands), kept."""
    @F.arrow_udf(", ".join(f"{c} long" for c in COUNTS) + ", base_failed boolean, score double, kept boolean")
    def run(column: pa.Array) -> pa.Array:
        parts = [counts(*utf8(part.column(0))) for part in _parts(column)]
        c = np.concatenate(parts) if parts else np.zeros((0, len(COUNTS)), dtype=np.int64)
        failed, score = hard(c), forest.scores(features(c))
        release()
        return _struct([c], COUNTS, {"base_failed": pa.array(failed), "score": pa.array(score),
                                     "kept": pa.array(~failed & ~(score > forest.threshold))})
    return run(text)


def judge(docs: DataFrame, forest: Forest, name: str = "quality") -> DataFrame:
    """``docs`` with the struct ``name`` of verdicts on its column ``text``."""
    return docs.withColumn(name, verdicts(docs["text"].cast("string"), forest))
