"""Aggregates Spark lacks in the exact form needed."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def mode_by(df: DataFrame, keys: list[str], value: str, alias: str | None = None) -> DataFrame:
    """Two-stage mode for high-cardinality values: count per (key, value)
    (a hot key spreads over its values), then pick per key with a
    combinable ``min(struct)``. Keys whose values are all NULL get NULL."""
    alias = alias or value
    counts = df.groupBy(*keys, value).agg(F.count(F.lit(1)).alias("_n"))
    pick = F.min(F.struct(F.col(value).isNull().alias("_z"), (-F.col("_n")).alias("_c"),
                          F.col(value).alias("_v")))
    return counts.groupBy(*keys).agg(pick.alias("_m")).select(*keys, F.col("_m._v").alias(alias))


def first_max_by(value: str, metric: str, seq: str) -> Column:
    """``value`` at the largest ``metric``; ties go to the smallest ``seq``
    (first arrival), then the smallest value."""
    m = F.min(F.struct((-F.col(metric)).alias("_m"), F.col(seq).alias("_s"),
                       F.col(value).alias("_v")))
    return m["_v"]


def median_small_domain(df: DataFrame, keys: list[str], col: str,
                        alias: str | None = None) -> DataFrame:
    """Exact median per group for a column with few distinct values (day
    counts, scores): count per (group, value) first - combined map-side and
    spread by value - then the weighted exact ``percentile`` per group, whose
    final merge touches each distinct value of a group once."""
    alias = alias or col
    counts = (df.where(F.col(col).isNotNull()).groupBy(*keys, col)
              .agg(F.count(F.lit(1)).alias("_n")))
    return counts.groupBy(*keys).agg(
        F.percentile(F.col(col), F.lit(0.5), F.col("_n")).alias(alias))


def weighted_median(col: str, n: str) -> Column:
    """Exact median of a column of few distinct values whose rows are counted
    already (aggregate)."""
    return F.percentile(F.col(col), F.lit(0.5), F.col(n))


def _unpivot(df: DataFrame, keys: list[str], cols: list[str]) -> DataFrame:
    """(keys..., _c, _v): one row per input row and column (same-typed cols)."""
    return df.select(*keys, F.explode(F.array(*[
        F.struct(F.lit(c).alias("_c"), F.col(c).alias("_v")) for c in cols])).alias("_p")) \
        .select(*keys, "_p._c", "_p._v")


def _pivot_back(long: DataFrame, keys: list[str], cols: list[str], value: str) -> DataFrame:
    aggs = [F.max(F.when(F.col("_c") == c, F.col(value))).alias(c) for c in cols]
    if keys:
        return long.groupBy(*keys).agg(*aggs)
    return long.agg(*aggs)


def grouped_medians(df: DataFrame, keys: list[str], cols: list[str]) -> DataFrame:
    """Exact medians of several same-typed columns per group, skew-safe.

    The columns are unpivoted to (keys, column, value) rows and
    :func:`exact_percentiles` runs once over (keys, column) groups, so no
    task ever holds all values (or all distinct values) of a hot group.
    NULL and NaN values are ignored; a group with only those gets NULL.
    """
    long = _unpivot(df, keys, cols)
    med = exact_percentiles(long, keys + ["_c"], "_v", [0.5], ["_m"])
    return _pivot_back(med, keys, cols, "_m")


def grouped_and_global_medians(df: DataFrame, key: str, cols: list[str]) -> DataFrame:
    """:func:`grouped_medians` by one text key, with one more row, of key NULL,
    for the whole table. Values are counted once for both."""
    long = _unpivot(df, [key], cols).groupBy(key, "_c", "_v").agg(F.count(F.lit(1)).alias("_n"))
    both = long.select(F.lit(False).alias("_all"), key, "_c", "_v", "_n").unionByName(
        long.select(F.lit(True).alias("_all"), F.lit("").alias(key), "_c", "_v", "_n"))
    med = exact_percentiles(both, ["_all", key, "_c"], "_v", [0.5], ["_m"], weight="_n")
    out = _pivot_back(med, ["_all", key], cols, "_m")
    return out.select(F.when(~F.col("_all"), F.col(key)).alias(key), *cols)


def grouped_modes(df: DataFrame, keys: list[str], cols: list[str]) -> DataFrame:
    """Most frequent non-NULL value (smallest on ties) of several same-typed
    columns per group, skew-safe: count per (group, column, value), then a
    combinable ``min(struct(-count, value))`` per (group, column)."""
    long = _unpivot(df, keys, cols).where(F.col("_v").isNotNull())
    counts = long.groupBy(*keys, "_c", "_v").agg(F.count(F.lit(1)).alias("_n"))
    pick = counts.groupBy(*keys, "_c").agg(
        F.min(F.struct((-F.col("_n")).alias("n"), F.col("_v").alias("v"))).alias("_m"))
    out = _pivot_back(pick.select(*keys, "_c", F.col("_m.v").alias("_best")), keys, cols,
                      "_best")
    return df.select(*keys).distinct().join(out, keys, "left")


def _beside(left: DataFrame, right: DataFrame, groups: list[str], how: str = "inner") -> DataFrame:
    """``left`` with the row of ``right`` of its group; without groups ``right``
    is one row, or one per rank or bucket, and goes to every task."""
    return left.join(right, groups, how) if groups else left.crossJoin(F.broadcast(right))


def exact_percentiles(df: DataFrame, keys: list[str], col: str, qs: list[float],
                      names: list[str], weight: str | None = None,
                      buckets: int | None = None) -> DataFrame:
    """keys, then one column per ``names``: the exact percentiles ``qs`` of each
    group (linear interpolation, the formula of Spark's ``percentile``), without
    holding a group's values in one task. One lazy plan, the same at every size:

    1. count per (group, value), combined map-side; ``weight`` holds counts of
       rows that are counted already;
    2. per group the number of values and ``buckets`` - 1 cuts, approximate
       quantiles of its distinct values: they only balance the buckets, and
       their error changes no result;
    3. running counts over the buckets of a group place every wanted rank in
       one bucket;
    4. only those buckets are sorted, each a window of its own, and running
       counts in them give the value at the rank.

    ``buckets`` is 128 a group, and 1024 without groups, where one row has the
    cuts of the whole table: a task then sorts one in 1024 of the distinct values.
    NULL and NaN are ignored; a group without other values gets NULL, any other
    whose rank is not found raises. Group keys are not NULL. ``keys=[]`` gives
    one row.
    """
    buckets = buckets or (128 if keys else 1024)
    n = F.col(weight) if weight else F.lit(1)
    v = F.col(col).cast("double")
    fit = v.isNotNull() & ~F.isnan(v)
    counts = (df.select(*keys, F.when(fit, v + F.lit(0.0)).alias("_v"), n.alias("_n"))
              .groupBy(*keys, "_v").agg(F.sum("_n").alias("_n")))
    at = [i / buckets for i in range(1, buckets)]
    per = counts.groupBy(*keys).agg(
        F.coalesce(F.sum(F.when(F.col("_v").isNotNull(), F.col("_n"))), F.lit(0)).alias("_all_n"),
        F.percentile_approx("_v", at, 10 * buckets).alias("_cuts"))
    step = math.isqrt(buckets)
    coarse = F.transform(F.sequence(F.lit(step), F.lit(buckets - 1), F.lit(step)), lambda i: F.get("_cuts", i - 1))
    cuts = per.select(*keys, "_cuts", coarse.alias("_coarse"))
    placed = (_beside(counts.where(F.col("_v").isNotNull()), cuts, keys)
              .withColumn("_b", _cuts_below(step)).drop("_cuts", "_coarse"))
    run = Window.partitionBy(*keys).orderBy("_b").rowsBetween(Window.unboundedPreceding, 0)
    totals = (placed.groupBy(*keys, "_b").agg(F.sum("_n").alias("_t"))
              .withColumn("_upto", F.sum("_t").over(run)))
    ranks = []
    for i, q in enumerate(qs):
        pos = (F.col("_all_n") - 1).cast("double") * F.lit(q)
        for side, rank in enumerate((F.floor(pos), F.ceil(pos))):
            ranks.append(F.struct(F.lit(2 * i + side).alias("_w"), rank.alias("_rank")))
    asked = (per.where(F.col("_all_n") > 0).select(*keys, F.explode(F.array(*ranks)).alias("_r"))
             .select(*keys, "_r.*"))
    wanted = (_beside(totals, asked, keys)
              .where(F.col("_rank").between(F.col("_upto") - F.col("_t"), F.col("_upto") - 1))
              .select(*keys, "_w", "_b", (F.col("_rank") - F.col("_upto") + F.col("_t")).alias("_rank")))
    inside = (Window.partitionBy(*keys, "_w").orderBy("_v")
              .rowsBetween(Window.unboundedPreceding, 0))
    # Without groups ``wanted`` has two rows a percentile.
    found = (placed.join(wanted if keys else F.broadcast(wanted), [*keys, "_b"]).withColumn("_upto", F.sum("_n").over(inside))
             .where(F.col("_rank").between(F.col("_upto") - F.col("_n"), F.col("_upto") - 1))
             .groupBy(*keys).agg(*[F.max(F.when(F.col("_w") == w, F.col("_v"))).alias(f"_v{w}")
                                   for w in range(2 * len(qs))]))
    out = _beside(per, found, keys, "left")
    values = []
    for i, (q, name) in enumerate(zip(qs, names, strict=True)):
        pos = (F.col("_all_n") - 1).cast("double") * F.lit(q)
        lo, hi = F.col(f"_v{2 * i}"), F.col(f"_v{2 * i + 1}")
        lost = F.raise_error(F.lit(f"no value at percentile {q} of {col}")).cast("double")
        value = (F.when(lo.isNull() | hi.isNull(), lost)
                 .when(F.floor(pos) == F.ceil(pos), lo).when(lo == hi, lo)
                 .otherwise((F.ceil(pos) - pos) * lo + (pos - F.floor(pos)) * hi))
        values.append(F.when(F.col("_all_n") > 0, value).alias(name))
    return out.select(*keys, *values)


def _cuts_below(step: int) -> Column:
    """How many of the sorted ``_cuts`` are below ``_v``: first of every
    ``step``-th, then of the ``step`` that follow."""
    def below(cuts: Column | str) -> Column:
        return F.size(F.filter(cuts, lambda c: c < F.col("_v")))

    skipped = below("_coarse") * step
    return skipped + below(F.slice("_cuts", skipped + 1, F.lit(step)))


def exact_percentile(df: DataFrame, keys: list[str], col: str, q: float,
                     alias: str | None = None) -> DataFrame:
    """:func:`exact_percentiles` of one rank."""
    return exact_percentiles(df, keys, col, [q], [alias or col])
