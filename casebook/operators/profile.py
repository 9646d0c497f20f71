"""Column profiling: distinct values, cardinality, modes, nulls, correlation,
pairwise value bins. Each profile is a single scan with partial aggregation;
long-form results come from ``unpivot`` so the column count never becomes a
loop of jobs.
"""

from __future__ import annotations

from collections.abc import Sequence
from itertools import combinations, combinations_with_replacement

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType, StringType

from casebook.session import ship_package


def string_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, StringType)]


def numeric_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, NumericType)]


def _long_values(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """(column, value) rows for the given columns, values as strings."""
    return df.select(*[F.col(c).cast("string").alias(c) for c in cols]).unpivot(
        [], list(cols), "column", "value")


def distinct_values(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Every distinct value of every column with its frequency (one shuffle)."""
    return _long_values(df, cols).groupBy("column", "value").agg(F.count(F.lit(1)).alias("n"))


def cardinality(df: DataFrame, cols: Sequence[str], exact: bool = True,
                rsd: float = 0.01) -> DataFrame:
    """Distinct count per column, long form (column, n_distinct).

    Exact: one shuffle on (column, value) with partial aggregation, then a
    count per column. Approximate: one HyperLogLog++ pass, no shuffle of
    values at all (what to use at very large scale).
    """
    if exact:
        return (_long_values(df, cols).filter(F.col("value").isNotNull()).distinct()
                .groupBy("column").agg(F.count(F.lit(1)).alias("n_distinct")))
    one = df.agg(*[F.approx_count_distinct(c, rsd).alias(c) for c in cols])
    return one.unpivot([], list(cols), "column", "n_distinct")


def null_counts(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """(column, null_count, kept) in one aggregate pass; kept = no nulls."""
    cols = list(cols or df.columns)
    one = df.agg(*[F.sum(F.col(c).isNull().cast("long")).alias(c) for c in cols])
    return (one.unpivot([], cols, "column", "null_count")
            .withColumn("kept", F.col("null_count") == 0))


def drop_null_columns(df: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """Drop every column holding at least one null (``keep`` always stays).
    The survivor list is decided from one aggregated row."""
    row = df.agg(*[F.max(F.col(c).isNull().cast("int")).alias(c) for c in df.columns]).first()
    return df.select(*[c for c in df.columns if c in keep or not row[c]])


def drop_constant_columns(df: DataFrame, cols: Sequence[str] | None = None,
                          keep: Sequence[str] = ()) -> DataFrame:
    """Drop numeric columns whose values are all equal (variance 0), judged
    by max == min in one aggregate pass so rounding cannot keep them."""
    cols = [c for c in (cols or numeric_columns(df)) if c not in keep]
    row = df.agg(*[(F.max(c) == F.min(c)).alias(c) for c in cols]).first()
    return df.drop(*[c for c in cols if row[c]])


def modes(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Most frequent non-null value per column, ties to the smallest value.
    Counting is a shuffle on (column, value) with map-side combine; the pick
    is a second aggregate over at most the distinct pairs."""
    counts = (_long_values(df, cols).filter(F.col("value").isNotNull())
              .groupBy("column", "value").agg(F.count(F.lit(1)).alias("n")))
    return counts.groupBy("column").agg(
        F.min_by("value", F.struct((-F.col("n")).alias("neg_n"), F.col("value"))).alias("mode"),
        F.max("n").alias("n"))


def fill_with_mode(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Fill nulls of ``cols`` with their mode (string columns).
    The modes are one row per column, brought back as literals."""
    found = {r["column"]: r["mode"] for r in modes(df, cols).collect()}
    out = df
    for c in cols:
        if c in found:
            out = out.withColumn(c, F.coalesce(F.col(c), F.lit(found[c]).cast(df.schema[c].dataType)))
    return out


WIDE_CORRELATION = 32


def correlation(df: DataFrame, cols: Sequence[str], digits: int | None = 6) -> DataFrame:
    """Pearson matrix in long form (a, b, corr); pairs use rows where both
    are non-null (pairwise complete), all pairs in one aggregate pass. Null
    where fewer than two rows or no spread are left. Tables of more than
    ``WIDE_CORRELATION`` columns, whose pairs are too many to be expressions of
    one plan, are summed up in blocks (``_wide_correlation``)."""
    cols = list(cols)
    if len(cols) > WIDE_CORRELATION:
        out = _wide_correlation(df, cols)
    else:
        num = {c: df[f"`{c}`"].cast("double") for c in cols}

        def corr(a, b):  # F.corr is an error in ANSI mode without spread, and noise where rounding leaves some
            y, x = num[a], num[b]
            level = F.lit(1e-24) * F.regr_count(y, x)
            spread = ((F.regr_sxx(y, x) > level * F.regr_avgx(y, x) ** 2)
                      & (F.regr_syy(y, x) > level * F.regr_avgy(y, x) ** 2))
            joint = F.regr_sxy(y, x)
            return (F.when(F.isnan(joint), joint)
                    .when(spread, F.try_divide(joint, F.sqrt(F.regr_sxx(y, x) * F.regr_syy(y, x)))))

        pairs = []
        for a, b in combinations_with_replacement(cols, 2):
            r = corr(a, b)
            pairs += [F.struct(F.lit(x).alias("a"), F.lit(y).alias("b"), r.alias("corr"))
                      for x, y in sorted({(a, b), (b, a)})]
        out = df.agg(F.array(*pairs).alias("pairs")).select(F.inline("pairs"))
    if digits is not None:
        out = out.withColumn("corr", F.round("corr", digits))
    return out


_SUMS = ("n", "sx", "sxx", "sxy", "odd")


def _wide_correlation(df: DataFrame, cols: list[str], block: int = 64) -> DataFrame:
    """Correlation of many columns: five sums per pair of columns, from matrix products.

    A task turns its rows into a matrix of values, less their column's mean so
    that the sums stay small, and one of validity. Products of their column
    blocks give for every ordered pair the rows that have both, the sums of x,
    x*x and x*y over these, and how many hold a NaN or infinity (the
    correlation is NaN then, as in Spark's ``corr``). A task holds five k x k
    matrices and gives one row per column and block of columns, added up in
    Spark by pair. A pair whose spread is below 1e-12 of its squares has none."""
    ship_package(df.sparkSession)
    values = df.select(F.array(*[F.col(f"`{c}`").cast("double") for c in cols]).alias("x"))
    finite = [F.when(F.abs(F.col(f"`{c}`").cast("double")) < F.lit(float("inf")), F.col(f"`{c}`").cast("double"))
              for c in cols]
    means = df.agg(F.array(*[F.coalesce(F.avg(v), F.lit(0.0)) for v in finite]).alias("m")).first()["m"]
    fields = ", ".join(f"{s} array<double>" for s in _SUMS)
    sums = values.mapInArrow(_pair_sums(np.array(means), block), f"i int, lo int, {fields}")
    cell = sums.select("i", "lo", F.inline(F.arrays_zip(F.sequence(F.lit(0), F.size("n") - 1).alias("at"),
                                                        *[F.col(s) for s in _SUMS])))
    cell = (cell.withColumn("j", F.col("lo") + F.col("at")).groupBy("i", "j")
            .agg(*[F.sum(s).alias(s) for s in _SUMS]))
    # the other order of a pair has the sums of y
    other = cell.select(F.col("j").alias("i"), F.col("i").alias("j"), F.col("sx").alias("sy"), F.col("sxx").alias("syy"))
    both = cell.join(other, ["i", "j"])
    n = F.greatest(F.col("n"), F.lit(1.0))
    vx, vy = F.col("sxx") - F.col("sx") ** 2 / n, F.col("syy") - F.col("sy") ** 2 / n
    spread = (vx > F.lit(1e-12) * F.col("sxx")) & (vy > F.lit(1e-12) * F.col("syy"))
    corr = (F.when(F.col("n") == 0, F.lit(None)).when(F.col("odd") > 0, F.lit(float("nan")))
            .when(spread, (F.col("sxy") - F.col("sx") * F.col("sy") / n) / F.sqrt(vx * vy)))
    names = F.array(*[F.lit(c) for c in cols])
    return both.select(F.element_at(names, F.col("i") + 1).alias("a"), F.element_at(names, F.col("j") + 1).alias("b"),
                       F.when(F.col("i") == F.col("j"), F.signum(corr)).otherwise(corr).alias("corr"))


def _pair_sums(means: np.ndarray, block: int):
    k = len(means)

    def run(batches):
        total = None
        for batch in batches:
            x = batch.column(0).flatten()
            there = ~x.is_null().to_numpy(zero_copy_only=False).reshape(-1, k)
            x = x.fill_null(0.0).to_numpy(zero_copy_only=False).reshape(-1, k)
            good = np.isfinite(x)
            odd = (there & ~good).astype(np.float64)
            x = np.where(there & good, x, means) - means
            v = there.astype(np.float64)
            part = (v.T @ v, x.T @ v, (x * x).T @ v, x.T @ x, odd.T @ v + v.T @ odd)
            total = part if total is None else tuple(t + p for t, p in zip(total, part))
        if total is None:
            return
        for lo in range(0, k, block):
            hi = min(lo + block, k)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.arange(k, dtype=np.int32)), pa.array(np.full(k, lo, dtype=np.int32)),
                 *[pa.array(list(t[:, lo:hi]), pa.list_(pa.float64())) for t in total]], names=["i", "lo", *_SUMS])
    return run


def bin_index(x, lo, hi, bins: int):
    """1..bins equal-width bin; the maximum falls in the last bin."""
    span = F.lit(hi) - F.lit(lo)
    raw = F.floor((x - F.lit(lo)) / span * F.lit(bins)).cast("int") + F.lit(1)
    return F.when(span == 0, F.lit(1)).otherwise(F.least(raw, F.lit(bins)))


def pair_bins(df: DataFrame, cols: Sequence[str], bins: int = 10) -> DataFrame:
    """Counts over (bin_x, bin_y) for every column pair, like the cells of a
    scatter matrix. One pass for the ranges, one shuffle for all pairs."""
    cols = list(cols)
    rng = df.agg(*[F.min(c).alias(f"lo_{c}") for c in cols],
                 *[F.max(c).alias(f"hi_{c}") for c in cols]).first()
    binned = df.select(*[bin_index(F.col(c), rng[f"lo_{c}"], rng[f"hi_{c}"], bins).alias(c)
                         for c in cols])
    pairs = [F.struct(F.lit(a).alias("x"), F.lit(b).alias("y"),
                      F.col(a).alias("bin_x"), F.col(b).alias("bin_y"))
             for a, b in combinations(cols, 2)]
    return (binned.select(F.inline(F.array(*pairs)))
            .filter(F.col("bin_x").isNotNull() & F.col("bin_y").isNotNull())
            .groupBy("x", "y", "bin_x", "bin_y").agg(F.count(F.lit(1)).alias("n")))


def histogram(df: DataFrame, col: str, bins: int = 10) -> DataFrame:
    """Diagonal of the scatter matrix: 1-D equal-width histogram."""
    rng = df.agg(F.min(col).alias("lo"), F.max(col).alias("hi")).first()
    return (df.select(bin_index(F.col(col), rng["lo"], rng["hi"], bins).alias("bin"))
            .filter(F.col("bin").isNotNull())
            .groupBy("bin").agg(F.count(F.lit(1)).alias("n")))
