"""Timestamp helpers (all on TIMESTAMP_NTZ, no session-zone dependence)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

_US_PER_DAY = 86_400_000_000


def to_ts(df: DataFrame, name: str) -> Column:
    """Tolerant parse: text -> TIMESTAMP_NTZ, unparseable -> NULL (no error
    under ANSI mode); timestamp columns are only re-typed."""
    dtype = df.schema[name].dataType
    c = F.col(name)
    if isinstance(dtype, T.StringType):
        return F.expr(f"try_cast(`{name}` as timestamp_ntz)")
    if isinstance(dtype, T.TimestampNTZType):
        return c
    return c.cast("timestamp_ntz")


def floor_days(later, earlier) -> Column:
    """Elapsed whole days, floored (a 12-hour negative gap is -1, a
    5-hour positive gap is 0)."""
    later = F.col(later) if isinstance(later, str) else later
    earlier = F.col(earlier) if isinstance(earlier, str) else earlier
    us = F.timestamp_diff("MICROSECOND", earlier, later)
    return F.floor(us / F.lit(_US_PER_DAY)).cast("int")


def year_month(c) -> Column:
    """'yyyy-MM' month bucket; NULL timestamp gives NULL (not a 'NaT' text)."""
    c = F.col(c) if isinstance(c, str) else c
    return F.date_format(c, "yyyy-MM")
