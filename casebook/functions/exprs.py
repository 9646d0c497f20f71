"""Column-expression builders. Everything here is a Catalyst expression:
no Python runs per row, so every function stays inside whole-stage codegen.
"""

from __future__ import annotations

from collections.abc import Sequence
from statistics import NormalDist

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values that decide results (they must equal the original jobs):
# chi-squared histogram distance denominator guard, log-loss guard,
# the reference year used to repair "year instead of experience" and the
# value above which such a repair applies.
CHI2_EPS = 1e-10
LOG_LOSS_EPS = 1e-8
REF_YEAR = 2016
YEAR_THRESHOLD = 100

# Age bands (name, lower, upper, upper inclusive); None = open.
# Note the overlap at 40, which the original recipe has on purpose or not.
AGE_BANDS = (
    ("AGE_18-25", None, 25, False),
    ("AGE_25-40", 25, 40, True),
    ("AGE_40-65", 40, 65, False),
    ("AGE_65+", 65, None, False),
)
# Driving-experience bands, same layout.
EXPERIENCE_BANDS = (
    ("DRV_EXP_0-3", None, 3, False),
    ("DRV_EXP_3-10", 3, 10, False),
    ("DRV_EXP_10-20", 10, 20, False),
    ("DRV_EXP_20+", 20, None, False),
)


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


# ---------------------------------------------------------------- distances
def chi2_distance(a, b) -> Column:
    """sum((a-b)^2 / (a+b+1e-10)) over two equal-length numeric arrays."""
    terms = F.zip_with(_c(a), _c(b),
                       lambda x, y: (x - y) * (x - y) / (x + y + F.lit(CHI2_EPS)))
    return F.aggregate(terms, F.lit(0.0).cast("double"), lambda acc, t: acc + t)


def sq_euclidean(a, b) -> Column:
    terms = F.zip_with(_c(a), _c(b), lambda x, y: (x - y) * (x - y))
    return F.aggregate(terms, F.lit(0.0).cast("double"), lambda acc, t: acc + t)


def euclidean(a, b) -> Column:
    return F.sqrt(sq_euclidean(a, b))


def manhattan(a, b) -> Column:
    terms = F.zip_with(_c(a), _c(b), lambda x, y: F.abs(x - y))
    return F.aggregate(terms, F.lit(0.0).cast("double"), lambda acc, t: acc + t)


def to_double_array(a) -> Column:
    return F.transform(_c(a), lambda x: x.cast("double"))


# ------------------------------------------------------------------ scaling
def minmax(col, lo, hi) -> Column:
    """(x-min)/(max-min); a constant column maps to 0 (not Spark ML's 0.5).
    ``lo``/``hi`` are literals (fitted statistics) or columns. No clipping, so
    rows outside the fitted range leave [0, 1] as in the original recipe."""
    lo, hi = F.lit(lo) if not isinstance(lo, Column) else lo, \
        F.lit(hi) if not isinstance(hi, Column) else hi
    span = hi - lo
    return F.when(span == 0, F.lit(0.0)).otherwise((_c(col) - lo) / span)


def maxabs(col, m) -> Column:
    """x / max(|x|); an all-zero column stays 0."""
    m = F.lit(m) if not isinstance(m, Column) else m
    return F.when(m == 0, _c(col).cast("double")).otherwise(_c(col) / m)


# ------------------------------------------------------------------- models
def sigmoid(z) -> Column:
    return F.lit(1.0) / (F.lit(1.0) + F.exp(-_c(z)))


def log_loss(y, p, eps: float = LOG_LOSS_EPS) -> Column:
    """Element log-loss -y*log(p+eps) - (1-y)*log(1-p+eps)."""
    y, p = _c(y), _c(p)
    return -y * F.log(p + F.lit(eps)) - (F.lit(1.0) - y) * F.log(F.lit(1.0) - p + F.lit(eps))


# -------------------------------------------------------------- statistics
def normal_quantile(level: float, two_sided: bool = True) -> float:
    """z for a confidence level (driver-side literal, folded by Catalyst)."""
    q = (1 + level) / 2 if two_sided else level
    return NormalDist().inv_cdf(q)


def share_stderr(p, n) -> Column:
    p, n = _c(p), _c(n)
    return F.sqrt(p * (F.lit(1.0) - p) / n)


def share_interval(p, n, z: float) -> tuple[Column, Column]:
    """Normal interval p +- z*sqrt(p(1-p)/n)."""
    se = share_stderr(p, n)
    return _c(p) - F.lit(z) * se, _c(p) + F.lit(z) * se


def two_share_z(m1, n1, m2, n2) -> Column:
    """|z| of the pooled two-proportion test; null where both shares are 0 or
    both are 1 (no variance), or a group is empty."""
    m1, n1, m2, n2 = (_c(x).cast("double") for x in (m1, n1, m2, n2))
    pooled = F.try_divide(m1 + m2, n1 + n2)
    diff = F.try_divide(m1, n1) - F.try_divide(m2, n2)
    var = F.try_divide(pooled * (F.lit(1.0) - pooled) * (n1 + n2), n1 * n2)
    return F.abs(F.try_divide(diff, F.sqrt(var)))


# ------------------------------------------------------- recoding helpers
def binary_map(col, value) -> Column:
    """0 when the value equals ``value``, else 1 (null also 1)."""
    return F.when(_c(col) == F.lit(value), F.lit(0)).otherwise(F.lit(1))


def band_flags(col, bands: Sequence[tuple]) -> list[Column]:
    """One 0/1 column per band (name, lo, hi, hi_inclusive); null -> 0."""
    x = _c(col)
    out = []
    for name, lo, hi, hi_inc in bands:
        cond = F.lit(True)
        if lo is not None:
            cond = cond & (x >= F.lit(lo))
        if hi is not None:
            cond = cond & ((x <= F.lit(hi)) if hi_inc else (x < F.lit(hi)))
        out.append(F.when(cond, F.lit(1)).otherwise(F.lit(0)).alias(name))
    return out


def fix_year(col, ref_year: int = REF_YEAR, threshold: int = YEAR_THRESHOLD) -> Column:
    """A value above ``threshold`` is a year: replace by ref_year - value."""
    x = _c(col)
    return F.when(x > F.lit(threshold), F.lit(ref_year) - x).otherwise(x)


def replace_code(col, old: str, new: str) -> Column:
    x = _c(col)
    return F.when(x == F.lit(old), F.lit(new)).otherwise(x)


def int_with_code(col, code: str = "N", value: int = 1) -> Column:
    """Cast to int; the domain code ``code`` becomes ``value``."""
    x = _c(col)
    return F.when(x == F.lit(code), F.lit(value)).otherwise(x.cast("int"))


def file_name(path) -> Column:
    return F.element_at(F.split(_c(path), "/"), -1)


def array_join_sorted(arr, sep: str = ", ") -> Column:
    return F.array_join(F.array_sort(_c(arr)), sep)


def dense_histogram(entries, k: int) -> Column:
    """Array<struct<word,count>> -> dense length-k array, zeros kept."""
    m = F.map_from_entries(_c(entries))
    return F.transform(F.sequence(F.lit(0), F.lit(k - 1)),
                       lambda i: F.coalesce(F.element_at(m, i), F.lit(0)).cast("double"))
