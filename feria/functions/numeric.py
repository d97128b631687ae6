"""Exact rounding helpers.

Warehouse semantics: ratios and means are exact decimals rounded half away
from zero. Spark ``round`` on DECIMAL is HALF_UP (= half away from zero), so
the dividend and divisor are cast to DECIMAL(20,0) first; their quotient then
carries 18 fractional digits, far beyond the rounding position. Outputs are
DOUBLE.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_DEC = "decimal(20,0)"


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def flag(cond: Column) -> Column:
    """Boolean -> 0/1 with NULL counted as 0."""
    return F.coalesce(cond, F.lit(False)).cast("int")


def ratio_round(num, den, n: int) -> Column:
    """round(num / den, n) in exact decimal arithmetic; den = 0 -> NULL."""
    q = _c(num).cast(_DEC) / F.nullif(_c(den).cast(_DEC), F.lit(0).cast(_DEC))
    return F.round(q, n).cast("double")


def pct(part, whole, n: int) -> Column:
    """round(part * 100 / whole, n), exact; whole = 0 -> NULL."""
    return ratio_round(_c(part).cast(_DEC) * 100, whole, n)


def mean_round(x, n: int) -> Column:
    """Exact mean of an integer column rounded to n places (aggregate)."""
    return ratio_round(F.sum(_c(x)), F.count(_c(x)), n)


def money(x) -> Column:
    """Double amount -> DECIMAL(10,2) by rounding cents half up."""
    cents = F.floor(_c(x) * 100 + 0.5).cast("decimal(12,0)")
    return (cents / 100).cast("decimal(10,2)")


def money_round(total, n: int) -> Column:
    """Round a DECIMAL money value to n places (half up) and return DOUBLE."""
    return F.round(_c(total), n).cast("double")


def money_mean_round(x, n: int) -> Column:
    """Exact mean of a DECIMAL(p,2) column rounded to n places (aggregate)."""
    cents = F.sum((_c(x) * 100).cast("bigint"))
    return ratio_round(cents, F.count(_c(x)) * 100, n)


def null_if_zero(x) -> Column:
    return F.nullif(_c(x), F.lit(0))


def nan_to_null(x) -> Column:
    """NaN -> NULL (a float source may carry NaN where the data is missing;
    NULL is Spark's missing value and is skipped by aggregates)."""
    c = _c(x)
    return F.when(~F.isnan(c), c)
