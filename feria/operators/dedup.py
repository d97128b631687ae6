"""Keyed de-duplication without windows.

``first_per_key`` keeps one row per key under an explicit total order. It is
an aggregate of ``min(struct(order..., row))``: Spark combines it map-side
before the shuffle, so a key holding a third of all rows is reduced on every
mapper instead of being sorted inside one task (which a ``row_number``
window would do).
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


@dataclass(frozen=True)
class By:
    """One sort key: column, direction and where NULLs go."""
    col: str
    desc: bool = False
    nulls_last: bool = True


def _sort_terms(df: DataFrame, keys: list[By]) -> list[Column]:
    terms = []
    for i, k in enumerate(keys):
        c = F.col(k.col)
        # NULL placement first: False < True, so isNull() puts NULLs last.
        terms.append((c.isNull() if k.nulls_last else c.isNotNull()).alias(f"_n{i}"))
        if k.desc:
            dt = df.schema[k.col].dataType
            if isinstance(dt, (T.TimestampNTZType, T.TimestampType, T.DateType)):
                v = -F.timestamp_diff("MICROSECOND", F.lit("1970-01-01").cast("timestamp_ntz"),
                                     c.cast("timestamp_ntz"))
            elif isinstance(dt, T.NumericType):
                v = -c
            else:
                raise TypeError(f"descending key {k.col} must be numeric or temporal")
        else:
            v = c
        terms.append(v.alias(f"_v{i}"))
    return terms


def first_per_key(df: DataFrame, keys: list[str], order: list[By], counted: str | None = None) -> DataFrame:
    """Keep the first row of each key under ``order`` (ties: whole row);
    ``counted`` names a further column with the number of the key's rows.

    Equivalent to ``row_number() over (partition by keys order by order) = 1``
    but computed as a combinable aggregate. A column that is an ascending sort
    key is moved once, as the key, and read back from there.
    """
    payload = [c for c in df.columns if c not in keys]
    place = {k.col: f"_v{i}" for i, k in reversed(list(enumerate(order))) if not k.desc}
    rest = [c for c in payload if c not in place]
    terms = _sort_terms(df, order) + ([F.struct(*rest).alias("_row")] if rest or not order else [])
    found = [F.min(F.struct(*terms)).alias("_m")] + ([F.count(F.lit(1)).alias(counted)] if counted else [])
    return (df.groupBy(*keys).agg(*found)
            .select(*keys, *[F.col(f"_m.{place[c]}" if c in place else f"_m._row.{c}").alias(c) for c in payload],
                    *([counted] if counted else []))
            .select(*df.columns, *([counted] if counted else [])))


def latest_per_key(df: DataFrame, key: str, ts: str, tie: str) -> DataFrame:
    """Latest ``ts`` per ``key`` (NULL times last), ties by smallest ``tie``."""
    return first_per_key(df, [key], [By(ts, desc=True, nulls_last=True), By(tie)])


def insert_ignore(target: DataFrame | None, incoming: DataFrame, keys: list[str],
                  arrival: list[By]) -> DataFrame:
    """Rows to append with the semantics of ``INSERT ... ON CONFLICT DO NOTHING``.

    Within the batch the first arrival per key wins; against the target an
    existing key is never replaced. What is skipped is counted as incoming
    less appended.
    """
    first = first_per_key(incoming, keys, arrival)
    return first if target is None else first.join(target.select(*keys), keys, "left_anti")
