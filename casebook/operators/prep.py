"""Table preparation: split filters, union + first-wins dedup, hash splits,
scaling with fitted statistics, automatic column cleaning and one-hot.

Fitted statistics (min, max, max-abs, category lists) are one aggregated
row; they are inlined as literals so the apply step is a single Project that
Catalyst fuses with the scan.
"""

from __future__ import annotations

import functools
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from casebook.functions import exprs as X
from casebook.operators import profile


def take_split(df: DataFrame, col: str, value) -> DataFrame:
    """Rows whose ``col`` equals ``value`` exactly (no trimming), column dropped."""
    return df.filter(F.col(col) == F.lit(value)).drop(col)


def union_first_wins(parts: Sequence[tuple[str, DataFrame]], key: str,
                     tie: Sequence[str] = ()) -> DataFrame:
    """Union named parts by column name (missing columns null) and keep one
    row per ``key``: the one from the earliest part, then the smallest
    ``tie`` columns, then the smallest of the other columns, so that rows of
    one key and part always give the same one. An aggregate with map-side
    combine: a key holding a large share of rows never lands whole in one task."""
    tagged = None
    for rank, (name, part) in enumerate(parts):
        t = part.withColumn("split", F.lit(name)).withColumn("_rank", F.lit(rank))
        tagged = t if tagged is None else tagged.unionByName(t, allowMissingColumns=True)
    cols = [c for c in tagged.columns if c not in (key, "_rank")]
    rest = [c for c in cols if c not in tie and c != "split"]
    order = F.struct(F.col("_rank"), *[F.col(f"`{c}`") for c in [*tie, *rest]])
    best = tagged.groupBy(key).agg(F.min_by(F.struct(*[F.col(f"`{c}`") for c in cols]), order).alias("_row"))
    return best.select(key, "_row.*")


def hash_split(df: DataFrame, key: str, share: float = 0.2, seed: int = 1,
               name: str = "is_valid") -> DataFrame:
    """Deterministic share of rows flagged by a hash of the key: the same row
    lands on the same side under any partitioning or re-execution."""
    bucket = F.pmod(F.xxhash64(F.col(key), F.lit(seed)), F.lit(10000))
    return df.withColumn(name, bucket < F.lit(int(round(share * 10000))))


def sample_with_replacement(df: DataFrame, fraction: float, seed: int) -> DataFrame:
    """Mini-batch style sample with replacement (Poisson per row)."""
    return df.sample(withReplacement=True, fraction=fraction, seed=seed)


def draw_number(k, seed: int):
    """A whole number below 2 ** 48 from a draw's number and the seed, the same in any engine that has MD5."""
    return F.conv(F.substring(F.md5(F.concat(F.lit(f"{seed}:"), k.cast("string")).cast("binary")), 1, 12), 16, 10).cast("long")


def draw_rows(df: DataFrame, order: Sequence[str], n: int, seed: int, name: str = "times") -> DataFrame:
    """Exactly ``n`` draws with replacement: the drawn rows, each with the number of times it was drawn (``times``).

    Rows are numbered by ``order`` (a total order) without gaps, and draw k takes the row whose number is a hash of
    (seed, k) modulo the number of rows, so the same rows come under any partitioning. Draws are counted per number
    before they meet the rows; a table without rows gives none. Repeat a row by exploding ``sequence(1, times)``."""
    from casebook.operators.common import ordered_index

    numbered = ordered_index(df, order, name="_at", start=0)
    total = numbered.agg(F.count(F.lit(1)).alias("n")).first()["n"]  # one row
    if not total:
        return df.withColumn(name, F.lit(0).cast("long"))
    draws = (df.sparkSession.range(n).select((draw_number(F.col("id"), seed) % total).alias("_at"))
             .groupBy("_at").agg(F.count(F.lit(1)).alias(name)))
    return numbered.join(draws, "_at").drop("_at")


# ------------------------------------------------------------------ scaling
def fit_minmax(df: DataFrame, cols: Sequence[str]) -> dict[str, tuple]:
    row = df.agg(*[F.min(c).alias(f"lo_{c}") for c in cols],
                 *[F.max(c).alias(f"hi_{c}") for c in cols]).first()
    return {c: (row[f"lo_{c}"], row[f"hi_{c}"]) for c in cols}


def apply_minmax(df: DataFrame, stats: dict[str, tuple]) -> DataFrame:
    """(x-min)/(max-min) with fitted literals; constant -> 0; no clipping;
    null where the fitted column had no value."""
    return df.withColumns({c: F.lit(None).cast("double") if lo is None else
                           X.minmax(F.col(c).cast("double"), float(lo), float(hi))
                           for c, (lo, hi) in stats.items()})


def minmax_scale(df: DataFrame, cols: Sequence[str], fit_on: DataFrame | None = None) -> DataFrame:
    return apply_minmax(df, fit_minmax(fit_on if fit_on is not None else df, cols))


def fit_maxabs(df: DataFrame, cols: Sequence[str]) -> dict[str, float | None]:
    row = df.agg(*[F.max(F.abs(F.col(c))).alias(c) for c in cols]).first()
    return {c: None if row[c] is None else float(row[c]) for c in cols}


def maxabs_scale(df: DataFrame, cols: Sequence[str], fit_on: DataFrame | None = None) -> DataFrame:
    stats = fit_maxabs(fit_on if fit_on is not None else df, cols)
    return df.withColumns({c: F.lit(None).cast("double") if m is None else X.maxabs(F.col(c).cast("double"), m)
                           for c, m in stats.items()})


# ------------------------------------------------------------------ one-hot
def categories(df: DataFrame, cols: Sequence[str]) -> dict[str, list]:
    """Sorted distinct non-null values per column (one shuffle for all).

    The values become column names of ``one_hot``, so they are listed on the
    driver; ``auto_prepare_long`` gives the same features as rows and lists
    nothing, for columns of many values."""
    vals = (profile.distinct_values(df, cols).filter(F.col("value").isNotNull())
            .select("column", "value"))
    found = {r["column"]: list(r["values"]) for r in
             vals.groupBy("column").agg(F.array_sort(F.collect_list("value")).alias("values")).collect()}
    return {c: found.get(c, []) for c in cols}


def one_hot(df: DataFrame, cols: Sequence[str], cats: dict[str, list] | None = None,
            drop_input: bool = True) -> DataFrame:
    """Named 0/1 columns ``<col>_<value>`` for every category (none dropped).
    Unseen values and nulls give all zeros."""
    cats = cats or categories(df, cols)
    new = {}
    for c in cols:
        src = F.col(c).cast("string")
        for v in cats[c]:
            new[f"{c}_{v}"] = F.when(src == F.lit(v), F.lit(1)).otherwise(F.lit(0))
    out = df.withColumns(new)
    return out.drop(*cols) if drop_input else out


def binarise(df: DataFrame, cols: Sequence[str], cats: dict[str, list] | None = None,
             drop_input: bool = True) -> DataFrame:
    """Label binariser: a column of two classes becomes one 0/1 column ``<col>_<second class>`` (classes in order of
    their names), of any other number one 0/1 column per class, of one class a column of zeros. Unseen values and
    nulls give zeros."""
    cats = cats or categories(df, cols)
    new = {}
    for c in cols:
        src, classes = F.col(f"`{c}`").cast("string"), [str(v) for v in cats[c]]
        for v in classes[1:] if len(classes) == 2 else classes:
            hit = F.lit(0) if len(classes) == 1 else F.when(src == F.lit(v), F.lit(1)).otherwise(F.lit(0))
            new[f"{c}_{v}"] = hit
    out = df.withColumns(new)
    return out.drop(*cols) if drop_input else out


# ------------------------------------------------------- automatic cleaning
def _surviving(df: DataFrame, keep: Sequence[str], fit: DataFrame) -> tuple[dict, list[str]]:
    """Fitted (min, max) of numeric columns and the string columns that stay, in one pass over ``fit``."""
    feats = [c for c in df.columns if c not in keep]
    nums = [c for c in profile.numeric_columns(df) if c in feats]
    aggs = [F.max(F.col(f"`{c}`").isNull().cast("int")).alias(f"null_{c}") for c in feats]
    aggs += [F.min(f"`{c}`").alias(f"lo_{c}") for c in nums] + [F.max(f"`{c}`").alias(f"hi_{c}") for c in nums]
    row = fit.agg(*aggs).first()
    survivors = [c for c in feats if not row[f"null_{c}"]]
    strings = [c for c in survivors if isinstance(df.schema[c].dataType, StringType)]
    # a numeric column is constant when max == min (variance 0)
    return {c: (row[f"lo_{c}"], row[f"hi_{c}"]) for c in survivors
            if c in nums and row[f"hi_{c}"] != row[f"lo_{c}"]}, strings


def auto_prepare(df: DataFrame, id_col: str = "id", split_col: str | None = None,
                 fit_on: str = "all") -> DataFrame:
    """Drop columns with any null, drop constant numeric columns, min-max the
    remaining numeric columns and one-hot every string column.

    ``fit_on="train"`` fits the null/constant tests and the scaling on rows
    whose ``split_col`` is ``'train'``; ``"all"`` uses every row (the original
    behaviour, which looks at test rows too)."""
    keep = [c for c in (id_col, split_col) if c]
    fit = df if fit_on == "all" else df.filter(F.col(split_col) == F.lit("train"))
    stats, strings = _surviving(df, keep, fit)
    out = apply_minmax(df.select(*keep, *stats, *strings), stats)
    return one_hot(out, strings, categories(fit, strings)) if strings else out


def auto_prepare_long(df: DataFrame, id_col: str = "id", split_col: str | None = None,
                      fit_on: str = "all") -> DataFrame:
    """The non-zero features of ``auto_prepare`` as rows (id, split, feature,
    value): one per numeric column and one per string column, however many
    values it has. Values that ``fit_on="train"`` has not seen give no row."""
    keep = [c for c in (id_col, split_col) if c]
    fit = df if fit_on == "all" else df.filter(F.col(split_col) == F.lit("train"))
    stats, strings = _surviving(df, keep, fit)

    def entries(frame, cols, scaled):
        items = [F.struct(F.lit(c).alias("feature") if scaled else
                          F.concat(F.lit(f"{c}_"), F.col(f"`{c}`")).alias("feature"),
                          (F.col(f"`{c}`") if scaled else F.lit(1.0)).cast("double").alias("value")) for c in cols]
        return frame.select(*keep, F.inline(F.array(*items))).filter(
            F.col("feature").isNotNull() & (F.col("value") != 0))
    parts = [entries(apply_minmax(df, stats), stats, True)] if stats else []
    if strings:
        coded = entries(df, strings, False)
        if fit_on != "all":
            coded = coded.join(entries(fit, strings, False).select("feature").distinct(), "feature", "left_semi")
        parts.append(coded)
    empty = df.select(*keep, F.lit("").alias("feature"), F.lit(0.0).alias("value")).filter(F.lit(False))
    return functools.reduce(DataFrame.unionByName, parts) if parts else empty


def to_sparse_long(df: DataFrame, id_col: str, feature_cols: Sequence[str]) -> DataFrame:
    """Wide features -> (id, feature, value) keeping non-zero entries only."""
    cols = list(feature_cols)
    entries = F.array(*[F.struct(F.lit(c).alias("feature"), F.col(f"`{c}`").cast("double").alias("value")) for c in cols])
    return (df.select(id_col, F.inline(F.filter(entries, lambda e: e["value"] != 0)))
            .filter(F.col("value") != 0))
