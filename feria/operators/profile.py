"""Column profiling: null and distinct counts, value frequencies, numeric
summaries, equal-width histograms and quantile filters.

Every profile is one or two aggregation passes; wide tables are unpivoted
into (column, value) pairs so all distinct counts share one shuffle instead
of one ``Expand`` copy per column.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from feria.functions import pct, ratio_round
from feria.functions.numeric import nan_to_null
from feria.operators.aggregates import exact_percentile, exact_percentiles


def fixed_text(c) -> Column:
    """A fractional number as plain fixed-point text with 9 decimals
    ('-1.136160000'), the same under every ANSI / formatting setting: the
    value is taken to DECIMAL(38,9), scaled to an integer (scale-0 decimals
    always print plainly) and the point is put back by string position."""
    c = F.col(c) if isinstance(c, str) else c
    n = (c.cast("decimal(38,9)") * F.lit(1_000_000_000)).cast("decimal(38,0)")
    a = F.abs(n).cast("string")
    padded = F.lpad(a, F.greatest(F.length(a), F.lit(10)), "0")
    int_part = F.substring(padded, F.lit(1), F.length(padded) - 9)
    frac = F.substring(padded, F.length(padded) - 8, F.lit(9))
    return F.when(c.isNull(), F.lit(None).cast("string")).otherwise(
        F.concat(F.when(n < 0, F.lit("-")).otherwise(F.lit("")), int_part, F.lit("."), frac))


def null_counts(df: DataFrame, table: str | None = None) -> DataFrame:
    """(table, column, nulls, null_pct): one pass over the data."""
    n = F.count(F.lit(1)).alias("_rows")
    one = df.agg(n, *[F.count_if(F.col(f"`{c}`").isNull()).alias(f"n{i}")
                      for i, c in enumerate(df.columns)])
    stacked = one.select(
        "_rows",
        F.explode(F.array(*[F.struct(F.lit(i).alias("pos"), F.lit(c).alias("column"),
                                     F.col(f"n{i}").alias("nulls"))
                            for i, c in enumerate(df.columns)])).alias("s"))
    return stacked.select(F.lit(table).alias("table"), F.col("s.pos").alias("pos"),
                          F.col("s.column").alias("column"), F.col("s.nulls").alias("nulls"),
                          pct(F.col("s.nulls"), F.col("_rows"), 2).alias("null_pct"))


def distinct_counts(df: DataFrame) -> DataFrame:
    """(column, unique): exact non-NULL distinct count per column, computed
    on the unpivoted (column, value) pairs with one shuffle."""
    pairs = df.select(F.explode(F.array(*[
        F.struct(F.lit(c).alias("column"), F.col(f"`{c}`").cast("string").alias("value"))
        for c in df.columns])).alias("p")).select("p.column", "p.value")
    per_value = pairs.where(F.col("value").isNotNull()).distinct()
    counted = per_value.groupBy("column").agg(F.count(F.lit(1)).alias("unique"))
    names = df.sparkSession.createDataFrame([(c,) for c in df.columns], "column string")
    return names.join(F.broadcast(counted), "column", "left") \
        .select("column", F.coalesce("unique", F.lit(0)).alias("unique"))


def profile_columns(df: DataFrame, table: str) -> DataFrame:
    """Per column: type, nulls and %, distinct values and %, and a sample
    value (the smallest one as text, so the profile is repeatable). All are read
    from the numbers of rows per (column, value), so the rows are made once."""
    pairs = df.select(F.explode(F.array(*[
        F.struct(F.lit(i).alias("pos"), F.col(f"`{c}`").cast("string").alias("value"))
        for i, c in enumerate(df.columns)])).alias("p")).select("p.pos", "p.value")
    per_value = pairs.groupBy("pos", "value").agg(F.count(F.lit(1)).alias("n"))
    # fractional numbers as fixed-point text, so the sample does not
    # depend on float formatting
    sample = F.col("value")
    for i, f in enumerate(df.schema.fields):
        if isinstance(f.dataType, (T.DoubleType, T.FloatType)):
            sample = F.when(F.col("pos") == i, fixed_text(F.col("value").cast(f.dataType))).otherwise(sample)
    seen = per_value.groupBy("pos").agg(
        F.sum("n").alias("_rows"), F.sum(F.when(F.col("value").isNull(), F.col("n")).otherwise(0)).alias("nulls"),
        F.count("value").alias("unique"), F.min(sample).alias("sample_value"))
    types = df.sparkSession.createDataFrame([(i, c, t) for i, (c, t) in enumerate(df.dtypes)], "pos int, column string, dtype string")
    told = types.join(F.broadcast(seen), "pos", "left")  # a row a column; none in an empty table
    zero = F.lit(0).cast("long")
    rows, nulls, unique = (F.coalesce(c, zero) for c in ("_rows", "nulls", "unique"))
    return told.select(F.lit(table).alias("table"), "pos", "column", "dtype", nulls.alias("nulls"), pct(nulls, rows, 2).alias("null_pct"),
                       unique.alias("unique"), pct(unique, rows, 2).alias("unique_pct"), "sample_value").orderBy("pos")


def table_summary(tables: dict[str, DataFrame]) -> DataFrame:
    """(table, rows, columns, total_nulls) per table: one pass each."""
    parts = []
    for name, df in tables.items():
        total_nulls = reduce(lambda a, b: a + b,
                             [F.count_if(F.col(f"`{c}`").isNull()) for c in df.columns])
        parts.append(df.agg(F.lit(name).alias("table"), F.count(F.lit(1)).alias("rows"),
                            F.lit(len(df.columns)).alias("columns"),
                            total_nulls.alias("total_nulls")))
    return reduce(DataFrame.unionByName, parts)


def value_counts(df: DataFrame, col: str, top: int | None = None,
                 by_value: bool = False) -> DataFrame:
    """Frequencies of non-NULL values: most frequent first (ties by value),
    or sorted by value; optionally the first ``top`` rows."""
    g = (df.where(F.col(col).isNotNull()).groupBy(col)
         .agg(F.count(F.lit(1)).alias("count")))
    g = g.orderBy(col) if by_value else g.orderBy(F.col("count").desc(), F.col(col).asc())
    return g.limit(top) if top else g


def describe(df: DataFrame, col: str, scale: int = 2) -> DataFrame:
    """count, mean, std, min, quartiles, max of one numeric column, rounded
    to ``scale`` places (half up; the mean is exact for values with at most
    ``scale`` decimals). Quartiles are exact (linear interpolation, the
    skew-safe :func:`exact_percentile`) over values scaled to integers, so
    the rounding sees exact halves."""
    k = 10 ** scale
    x = F.col(col)
    vals = df.where(x.isNotNull())
    scaled = vals.select((x * k).cast("double").alias("_xs"))
    base = vals.agg(
        F.count(x).alias("count"),
        ratio_round(F.sum(F.round(x * k, 0).cast("bigint")), F.count(x) * k, scale)
        .alias("mean"),
        F.round(F.stddev_samp(x.cast("double")), scale).alias("std"),
        F.min(x).cast("double").alias("min"),
        F.max(x).cast("double").alias("max"))
    names = ["p25", "p50", "p75"]
    quartiles = exact_percentiles(scaled, [], "_xs", [0.25, 0.5, 0.75], names).select(
        *[(F.floor(F.col(p) + 0.5) / k).alias(p) for p in names])
    base = base.crossJoin(F.broadcast(quartiles))  # one row each
    return base.select("count", "mean", "std", "min", "p25", "p50", "p75", "max")


def quantile_value(df: DataFrame, col: str, q: float) -> DataFrame:
    """One-row frame holding the exact q-quantile of ``col`` (skew-safe)."""
    return exact_percentile(df, [], col, q, alias="_q")


def quantile_filter(df: DataFrame, col: str, q: float) -> DataFrame:
    """Rows with ``col`` at or below its exact q-quantile (a one-row
    threshold broadcast to every task)."""
    t = quantile_value(df, col, q)
    return df.crossJoin(F.broadcast(t)).where(F.col(col).cast("double") <= F.col("_q")) \
        .drop("_q")


def histogram(df: DataFrame, col: str, bins: int) -> DataFrame:
    """Equal-width histogram over [min, max]: every bin reported (empty
    ones with 0), the last bin closed on the right; a constant column gets
    the range [v - 0.5, v + 0.5]. NULL and NaN are left out."""
    vals = df.select(nan_to_null(F.col(col).cast("double")).alias("x")).where(F.col("x").isNotNull())
    rng = vals.agg(F.min("x").alias("lo0"), F.max("x").alias("hi0")).select(
        F.when(F.col("lo0") == F.col("hi0"), F.col("lo0") - 0.5).otherwise(F.col("lo0"))
        .alias("lo"),
        F.when(F.col("lo0") == F.col("hi0"), F.col("hi0") + 0.5).otherwise(F.col("hi0"))
        .alias("hi"))
    b = F.least(F.floor((F.col("x") - F.col("lo")) * bins / (F.col("hi") - F.col("lo"))),
                F.lit(bins - 1))
    counts = (vals.crossJoin(F.broadcast(rng)).select(b.alias("bin"))
              .groupBy("bin").agg(F.count(F.lit(1)).alias("count")))
    all_bins = df.sparkSession.range(bins).withColumnRenamed("id", "bin").crossJoin(rng)
    w = (F.col("hi") - F.col("lo")) / bins
    return (all_bins.join(counts, "bin", "left")
            .select("bin", (F.col("lo") + F.col("bin") * w).alias("bin_lo"),
                    (F.col("lo") + (F.col("bin") + 1) * w).alias("bin_hi"),
                    F.coalesce("count", F.lit(0)).alias("count"))
            .orderBy("bin"))


def hash_sample(df: DataFrame, n: int, keys: list[str], seed: int = 42) -> DataFrame:
    """A repeatable sample of at most ``n`` rows: the ``n`` rows with the
    smallest MD5 of (key, seed). One pass: every task keeps its own n smallest
    (top-k), and only those are merged."""
    def text(k):
        # Fractional numbers are rendered as fixed-point decimals so the key
        # text (and so the sample) does not depend on float formatting.
        if isinstance(df.schema[k].dataType, (T.DoubleType, T.FloatType)):
            return fixed_text(k)
        return F.col(k).cast("string")
    h = F.md5(F.concat_ws("|", *[text(k) for k in keys], F.lit(str(seed))))
    return df.withColumn("_h", h).orderBy("_h").limit(n).drop("_h")
