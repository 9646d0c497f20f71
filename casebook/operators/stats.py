"""Share of flagged requests per group, normal intervals, two-share z-test.

All work is one partial+final hash aggregate; the per-group statistics are
plain column arithmetic afterwards.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from casebook.functions import exprs as X
from casebook.session import cut_lineage

# Fixed value: the critical |z| the original test compares against.
Z_CRITICAL = 1.6449


def group_shares(df: DataFrame, key: str, flag: str) -> DataFrame:
    """Per group: mean, sum and size of a 0/1 flag (size counts null flags)."""
    return df.groupBy(key).agg(
        F.avg(F.col(flag)).alias("p"),
        F.sum(F.col(flag).cast("long")).alias("m"),
        F.count(F.lit(1)).alias("n"),
    )


def share_interval(df: DataFrame, key: str, flag: str, level: float = 0.95,
                   digits: int | None = 6) -> DataFrame:
    """Share of ``flag`` per ``key`` with a two-sided normal interval."""
    z = X.normal_quantile(level, two_sided=True)
    g = group_shares(df, key, flag)
    lo, hi = X.share_interval("p", "n", z)
    out = g.select(key, "n", "m", "p", X.share_stderr("p", "n").alias("se"),
                   lo.alias("lo"), hi.alias("hi"))
    if digits is not None:
        out = out.select(key, "n", "m", *[F.round(c, digits).alias(c)
                                           for c in ("p", "se", "lo", "hi")])
    return out


def pick_groups(df: DataFrame, key: str, values: Sequence) -> DataFrame:
    """Keep the named groups of a grouped result (e.g. three request types)."""
    return df.filter(F.col(key).isin(list(values)))


def side_by_side(df: DataFrame, key: str, flag: str, values: Sequence) -> DataFrame:
    """One row holding p/m/n of each named group (pivot with fixed values)."""
    return (df.groupBy().pivot(key, list(values))
            .agg(F.avg(F.col(flag)).alias("p"), F.sum(F.col(flag).cast("long")).alias("m"),
                 F.count(F.lit(1)).alias("n")))


def two_share_ztest(df: DataFrame, key: str, flag: str, control,
                    critical: float = Z_CRITICAL, digits: int | None = 6) -> DataFrame:
    """Pooled two-proportion |z| of every group against the ``control`` group.

    The control statistics are a single aggregated row; they are brought to
    the driver (one row, a proven bound) and inlined as literals, so the
    comparison is a plain projection over the grouped table, no join.
    """
    g = cut_lineage(group_shares(df, key, flag))  # one row a group, read twice
    ctrl = g.filter(F.col(key) == F.lit(control)).select("m", "n").first()
    if ctrl is None:
        raise ValueError(f"control group {control!r} not present")
    m0, n0 = int(ctrl["m"]), int(ctrl["n"])
    z = X.two_share_z("m", "n", F.lit(m0), F.lit(n0))
    out = (g.filter(F.col(key) != F.lit(control))
           .select(F.lit(control).alias("control"), F.col(key).alias("treatment"),
                   F.col("n").alias("n_treatment"), F.col("m").alias("m_treatment"),
                   F.lit(n0).cast("long").alias("n_control"),
                   F.lit(m0).cast("long").alias("m_control"),
                   z.alias("z")))
    out = out.withColumn("equal_shares", F.col("z") < F.lit(critical))
    if digits is not None:
        out = out.withColumn("z", F.round("z", digits))
    return out
