"""Engine-stable rounding.

Averages of money rounded to cents land on exact half-cents; a float AVG summed in a
different order (another engine, another partitioning) can then round the other way.
The rule used everywhere:

* sums are taken in DECIMAL, which is exact and order independent, then cast to DOUBLE;
* an average rounded to ``n`` digits is ``sign(S) * floor(|S| / count * 10^n + 0.5) / 10^n``
  with ``S`` the exact sum: round half away from zero, written as plain IEEE operations
  that any SQL engine evaluates identically.

Contract of money: at most 4 decimals and below 10^14 in absolute value, DECIMAL(18,4). Finer
values are rounded to 4 decimals by the cast; larger ones raise (ANSI mode), they are never cut silently.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

MONEY_SCALE = 4      # money and delays carry at most 2 decimals
SCORE_SCALE = 12     # averaged review scores may be thirds


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


def exact_sum(col, scale: int = MONEY_SCALE) -> Column:
    """SUM in DECIMAL(18, scale) returned as DOUBLE (null when no non-null input)."""
    precision = 18 if scale <= 6 else 28
    return F.sum(_c(col).cast(f"decimal({precision},{scale})")).cast("double")


def rounded_sum(col, digits: int = 2, scale: int = MONEY_SCALE) -> Column:
    """ROUND(SUM(x), digits) computed exactly in DECIMAL, returned as DOUBLE."""
    precision = 18 if scale <= 6 else 28
    return F.round(F.sum(_c(col).cast(f"decimal({precision},{scale})")), digits).cast("double")


def rounded_avg(col, digits: int, scale: int = MONEY_SCALE) -> Column:
    """AVG(x) rounded half away from zero to ``digits`` decimals, stable across engines."""
    return average_of(exact_sum(col, scale), F.count(_c(col)), digits)


def average_of(total: Column, count: Column, digits: int) -> Column:
    """``total / count`` rounded half away from zero; null when there is nothing to average."""
    p = float(10 ** digits)
    return F.when(count > 0, F.signum(total) * F.floor(F.abs(total) / count * F.lit(p) + F.lit(0.5)) / F.lit(p))


def round_half_even(col, digits: int = 1) -> Column:
    """numpy/pandas ``round``: half to even on the double value."""
    p = float(10 ** digits)
    return F.rint(_c(col) * F.lit(p)) / F.lit(p)
