"""Data-quality checks returned as DataFrames (nothing is collected unless
the caller asks with :func:`assert_no_rows`)."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from feria.functions import pct


def duplicate_keys(df: DataFrame, keys: list[str]) -> DataFrame:
    """Key values occurring more than once, with their multiplicity."""
    return (df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
            .where(F.col("n") > 1))


def duplicate_count(df: DataFrame, keys: list[str] | None = None) -> DataFrame:
    """Rows repeating an earlier key (NULLs equal each other), as one row
    (rows, duplicates). With no keys the whole row is the key, see
    :func:`repeated_rows`."""
    if not keys:
        return repeated_rows(df)
    return _repeats(df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")))


def _repeats(groups: DataFrame) -> DataFrame:
    return groups.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("rows"),
                      F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("duplicates"))


def repeated_rows(df: DataFrame) -> DataFrame:
    """(rows, duplicates) of whole rows, by fingerprint: rows are counted by 128
    bits of hashes, and only those whose fingerprint occurs again are compared
    column by column. So what is shuffled is the fingerprints, and of wide rows
    those that repeat (or collide, which the comparison settles)."""
    wide = df.toDF(*[f"c{i}" for i in range(len(df.columns))])
    cols = wide.columns
    marked = wide.withColumns({"_h1": F.xxhash64(*cols), "_h2": F.xxhash64(F.lit("row"), *reversed(cols))})
    counts = marked.groupBy("_h1", "_h2").agg(F.count(F.lit(1)).alias("n"))
    again = counts.where("n > 1").select("_h1", "_h2")
    same = marked.join(again, ["_h1", "_h2"], "left_semi").groupBy(*cols).agg(F.count(F.lit(1)).alias("n"))
    rows = counts.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("rows"))
    return rows.crossJoin(F.broadcast(_repeats(same).select("duplicates")))  # one row each


def fk_orphans(child: DataFrame, fk: str, parent: DataFrame, pk: str) -> DataFrame:
    """Child rows whose key has no parent; a NULL key counts as an orphan."""
    keys = parent.select(F.col(pk).alias("_pk")).distinct()
    return child.join(keys, child[fk] == keys["_pk"], "left_anti")


def fk_report(edges: list[tuple[DataFrame, str, str, DataFrame, str, str]],
              null_is_orphan: bool = True) -> DataFrame:
    """One row per edge (child, its name, key, parent, its name, key): the
    orphans, the child's rows, and the orphans' percentage.

    All edges are checked in one aggregate over (edge, key, side) rows: keys are
    counted map-side, so a popular or NULL key is one row per task, and there is
    one exchange however many edges there are. A NULL key is an orphan in the
    check of raw files; a declared foreign key accepts it
    (``null_is_orphan=False``)."""
    spark = edges[0][0].sparkSession
    sides = []
    for i, (child, _, fk, parent, _, pk) in enumerate(edges):
        pair = child.select(F.col(fk).alias("k")).limit(0).union(parent.select(F.col(pk).alias("k")).limit(0)).schema[0].dataType
        for df, key, n in ((child, fk, 1), (parent, pk, 0)):
            # In the type that both sides widen to, then as text: one column for all edges.
            sides.append(df.select(F.lit(i).alias("_e"), F.col(key).cast(pair).cast("string").alias("_k"), F.lit(n).alias("_n")))
    names = spark.createDataFrame([(i, f"{cn}.{fk}", f"{pn}.{pk}") for i, (_, cn, fk, _, pn, pk) in enumerate(edges)],
                                  "_e int, child string, parent string")
    keys = reduce(DataFrame.union, sides).groupBy("_e", "_k").agg(F.sum("_n").alias("_n"), F.count_if(F.col("_n") == 0).alias("_hits"))
    lost = F.col("_k").isNull() if null_is_orphan else F.lit(False)
    lost = lost | (F.col("_k").isNotNull() & (F.col("_hits") == 0))
    per_edge = keys.groupBy("_e").agg(F.sum(F.when(lost, F.col("_n")).otherwise(0)).alias("orphans"), F.sum("_n").alias("rows"))
    zero = F.lit(0).cast("long")
    told = names.join(F.broadcast(per_edge), "_e", "left").withColumns(  # a row per edge
        {"orphans": F.coalesce("orphans", zero), "rows": F.coalesce("rows", zero)})
    return told.select("child", "parent", "orphans", "rows", pct("orphans", "rows", 2).alias("orphan_pct"))


def fk_check(child: DataFrame, child_name: str, fk: str, parent: DataFrame,
             parent_name: str, pk: str, null_is_orphan: bool = True) -> DataFrame:
    """:func:`fk_report` of one edge."""
    return fk_report([(child, child_name, fk, parent, parent_name, pk)], null_is_orphan)


def keys_without(parent: DataFrame, child: DataFrame, key: str) -> DataFrame:
    """Distinct parent keys that never occur in the child (set difference)."""
    return parent.select(key).subtract(child.select(key))


def row_accounting(table: str, before: DataFrame, after: DataFrame) -> DataFrame:
    """(table, before, after, removed, removed_pct) for one cleaning step."""
    b = before.agg(F.count(F.lit(1)).alias("before"))
    a = after.agg(F.count(F.lit(1)).alias("after"))
    return (b.crossJoin(a)
            .select(F.lit(table).alias("table"), "before", "after",
                    (F.col("before") - F.col("after")).alias("removed"),
                    pct(F.col("before") - F.col("after"), F.col("before"), 2)
                    .alias("removed_pct")))


def count_where(df: DataFrame, conds: dict[str, Column]) -> DataFrame:
    """One row of predicate counts, e.g. {'zero_price': col('price') == 0}."""
    return df.agg(*[F.count_if(c).alias(name) for name, c in conds.items()])


def assert_no_rows(df: DataFrame, message: str) -> None:
    """Raise if ``df`` has any row (reads at most one row)."""
    if df.limit(1).count() > 0:
        raise AssertionError(message)


def issue_register(spark: SparkSession, measured: DataFrame) -> DataFrame:
    """Turn measured counts (table, column, problem, count) into the issue
    table with the proposed action per problem kind."""
    # Proposed action per problem kind.
    actions = spark.createDataFrame([
        ("nulls", "keep NULL where valid, impute where a rule exists"),
        ("temporal anomaly", "report, do not remove"),
        ("outside bounding box", "filter by the bounding box"),
        ("duplicate key", "aggregate or keep one row per key"),
        ("zero value", "treat as missing or remove"),
        ("encoding", "normalise text"),
        ("orphan key", "flag and exclude from joins"),
    ], "problem string, action string")
    return measured.join(F.broadcast(actions), "problem", "left") \
        .select("table", "column", "problem", "count", "action")
