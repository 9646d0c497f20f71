"""Share statistics over a stream of request records.

The original jobs are batch only; this applies the same per-group share and
interval (and the two-share test through ``foreachBatch``) to a Structured
Streaming source. State is one row per group key.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from casebook.functions import exprs as X
from casebook.operators import stats


def running_shares(stream: DataFrame, key: str, flag: str, level: float = 0.95) -> DataFrame:
    """Streaming aggregate: n, m, share and normal interval per key (use
    output mode ``complete`` or ``update``)."""
    z = X.normal_quantile(level, two_sided=True)
    g = stream.groupBy(key).agg(F.count(F.lit(1)).alias("n"),
                                F.sum(F.col(flag).cast("long")).alias("m"))
    p = F.col("m") / F.col("n")
    lo, hi = X.share_interval(p, F.col("n"), z)
    return g.select(key, "n", "m", p.alias("p"), lo.alias("lo"), hi.alias("hi"))


def ztest_totals(key: str, control, sink: Callable[[DataFrame, int], None],
                 critical: float = stats.Z_CRITICAL):
    """``foreachBatch`` function for ``running_shares`` in output mode
    ``complete``: two-share z-test of every group against the control group on
    the totals so far; ``sink(result_df, batch_id)``. Until the control group
    has rows, its counts, z and the verdict are null."""
    def run(totals: DataFrame, batch_id: int) -> None:
        row = totals.filter(F.col(key) == F.lit(control)).select("m", "n").first()
        m0, n0 = (F.lit(None if row is None else row[c]).cast("long") for c in ("m", "n"))
        z = X.two_share_z("m", "n", m0, n0)
        sink(totals.filter(F.col(key) != F.lit(control)).select(
            F.lit(control).alias("control"), F.col(key).alias("treatment"), F.col("n").alias("n_treatment"),
            F.col("m").alias("m_treatment"), n0.alias("n_control"), m0.alias("m_control"), z.alias("z"),
            (z < F.lit(critical)).alias("equal_shares")), batch_id)
    return run
