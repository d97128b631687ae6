"""Star schema: rename, project, type, check, key-deduplicate, write.

Each warehouse table is built from its cleaned table by

1. renaming columns (every kept column is mapped; a required column that
   is still missing raises instead of loading as NULL),
2. projecting to the declared column list and casting to the declared type,
   filling a declared default only when the column is absent,
3. splitting rejects (NOT NULL, CHECK, length limits) from good rows,
4. keeping the first arrival per primary key (insert-ignore semantics).
"""

from __future__ import annotations

import os
import time
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from feria.lazy import LazyTables
from feria.operators.dedup import By, first_per_key
from feria.schemas import (CHECKS, DEFAULTS, LOAD_ORDER, MAX_LENGTH, NOT_NULL, PRIMARY_KEY,
                           RENAME, STAR_TYPES)

# clean table feeding each warehouse table
SOURCE = {
    "dim_geolocation": "geolocation", "dim_customers": "customers", "dim_sellers": "sellers",
    "dim_products": "products", "fact_orders": "orders", "fact_order_items": "order_items",
    "fact_payments": "payments", "fact_reviews": "reviews",
}

# Arrival order used when two rows share a primary key: reviews arrive
# sorted by answer time, newest first (NULL last); other tables keep the
# smallest row.
ARRIVAL = {
    "fact_reviews": [By("review_answer_timestamp", desc=True, nulls_last=True), By("order_id")],
}


WIDE = "_wide_"


class MissingColumnError(ValueError):
    pass


def _typed(table: str, clean_df: DataFrame, wide_keys: bool = False) -> DataFrame:
    """Rename + keep list + cast for one warehouse table, and ``_cast``: the
    columns whose value does not fit the declared type (NULL in the row), as
    text, NULL where all fit. ``wide_keys`` adds whole numbers of the primary
    key as they came, where the declared type is another whole number."""
    df = clean_df.withColumnsRenamed(
        {k: v for k, v in RENAME[table].items() if k in clean_df.columns})
    if table == "fact_payments" and "payment_id" not in df.columns:
        df = df.withColumn("payment_id", payment_key(df))
    defaults = DEFAULTS.get(table, {})
    required = set(NOT_NULL[table]) | set(PRIMARY_KEY[table])
    types = {f.name: f.dataType for f in df.schema.fields}
    cols, unfit = [], []
    for name, dtype in STAR_TYPES[table]:
        if name in df.columns:
            c = F.col(name)
        elif name in defaults:
            c = F.lit(defaults[name])
        elif name in required:
            raise MissingColumnError(f"{table}: required column {name!r} missing")
        else:
            raise MissingColumnError(f"{table}: column {name!r} missing after rename")
        if dtype is not None:
            typed, text = c.try_cast(dtype), dtype if isinstance(dtype, str) else dtype.simpleString()
            # A value of the declared type fits.
            if name not in types or types[name].simpleString() != text:
                unfit.append((c.isNotNull() & typed.isNull(), f"{name} does not fit {text}"))
                if wide_keys and name in PRIMARY_KEY[table] and isinstance(types.get(name), T.IntegralType) and isinstance(dtype, T.IntegralType):
                    cols.append(c.alias(WIDE + name))
            c = typed
        cols.append(c.alias(name))
    return df.select(*cols, _reasons(unfit).alias("_cast"))


def _reasons(broken: list[tuple[Column, Column | str]]) -> Column:
    """The texts of the rules that a row breaks, NULL without any: only a row that
    breaks one has its text made."""
    if not broken:
        return F.lit(None).cast("string")
    text = F.concat_ws("; ", *[F.when(at, F.lit(reason) if isinstance(reason, str) else reason) for at, reason in broken])
    return F.when(reduce(lambda a, b: a | b, [at for at, _ in broken]), text)


def payment_key(payments: DataFrame):
    """A key that depends on the row alone: 60 bits of the MD5 of order and
    sequence, a repeated (order, sequence) counted on by the other columns."""
    rest = [c for c in payments.columns if c not in ("order_id", "payment_sequential")]
    w = Window.partitionBy("order_id", "payment_sequential").orderBy(*rest)
    text = F.concat_ws("|", F.col("order_id").cast("string"),
                       F.col("payment_sequential").cast("string"),
                       F.row_number().over(w).cast("string"))
    return F.conv(F.substring(F.md5(text), 1, 15), 16, 10).cast("bigint")


def project_to_star(table: str, clean_df: DataFrame) -> DataFrame:
    """Rename + keep list + cast for one warehouse table; a value that does
    not fit its declared type is NULL (the load rejects such rows)."""
    return _typed(table, clean_df).drop("_cast")


def violations(table: str, df: DataFrame):
    """A string column naming every rule a row breaks (NULL = clean row)."""
    types = {f.name: f.dataType for f in df.schema.fields}
    broken = [(F.col("_cast").isNotNull(), F.col("_cast"))] if "_cast" in types else []
    for c in NOT_NULL[table]:
        broken.append((F.col(c).isNull(), f"{c} is null"))
    for c, (lo, hi) in CHECKS.get(table, {}).items():
        broken.append((~F.col(c).between(lo, hi), f"{c} not in [{lo},{hi}]"))
    for c, n in MAX_LENGTH.get(table, {}).items():
        # A whole number has 20 characters at most.
        if c in types and not (isinstance(types[c], T.IntegralType) and n >= 20):
            broken.append((F.char_length(F.col(c).cast("string")) > n, f"{c} longer than {n}"))
    r = _reasons(broken)
    # The partition id (never negative) keeps filters on the reason where they
    # are: pushed below the typed columns, the optimizer's constraint inference
    # would double its constraints with each of them.
    return F.when(F.spark_partition_id() >= 0, r)


def split_rejects(table: str, df: DataFrame) -> tuple[DataFrame, DataFrame]:
    checked = df.withColumn("_reject", violations(table, df))
    checked = checked.drop("_cast")
    good = checked.where(F.col("_reject").isNull()).drop("_reject")
    bad = checked.where(F.col("_reject").isNotNull()).withColumnRenamed("_reject", "reason")
    return good, bad


@dataclass
class StarTable:
    name: str
    rows: DataFrame      # loaded rows
    rejects: DataFrame   # rows failing a constraint, with a reason


def build_table(table: str, clean_df: DataFrame) -> StarTable:
    """One warehouse table as lazy frames (rows, rejects). The first arrival
    per primary key is always part of the plan: whether a key repeats is not
    known before the data are read."""
    _, bad = split_rejects(table, _typed(table, clean_df))
    good, _ = split_rejects(table, _typed(table, clean_df, wide_keys=True))
    # A good row's key is the same number in both types: grouped by the type it
    # came in, rows that lie by their key already do not move.
    wide = {c[len(WIDE):]: good.schema[c[len(WIDE):]].dataType for c in good.columns if c.startswith(WIDE)}
    keyed = good.select(*[F.col(WIDE + c).alias(c) if c in wide else c for c in good.columns if not c.startswith(WIDE)])
    rows = first_per_key(keyed, PRIMARY_KEY[table], ARRIVAL.get(table, []))
    return StarTable(table, rows.withColumns({c: F.col(c).cast(t) for c, t in wide.items()}), bad)


def build_star(clean: dict[str, DataFrame]) -> LazyTables:
    """The eight warehouse tables (lazy), without the reject outputs; each
    table is planned only when a query asks for it."""
    return LazyTables({t: (lambda t=t: build_table(t, clean[SOURCE[t]]).rows)
                       for t in LOAD_ORDER})


def load_table(spark: SparkSession, table: str, clean_df: DataFrame, out_dir: str,
               partition_by: list[str] | None = None,
               stage: bool = True) -> tuple[int, int, int]:
    """Load one warehouse table as a full refresh; returns (rows written,
    rows rejected by a constraint, rows skipped as a repeated key).

    ``stage=True`` (for lazy cleaning plans): the projected, checked rows are
    computed once and staged as Parquet - a lineage cut, so the cleaning
    plan never runs twice and a lost executor re-reads the stage. When the
    input is already a Parquet table, ``stage=False`` re-scans it instead,
    which is cheaper than writing a copy.

    The primary key is enforced in two steps: a key-only duplicate check
    (a shuffle of the key columns, combined map-side), and the full-row
    first-arrival de-duplication only if a duplicate exists.
    """
    typed = _typed(table, clean_df)
    checked = typed.withColumn("_reject", violations(table, typed)).drop("_cast")
    if stage:
        path = os.path.join(out_dir, "_staging", table)
        checked.write.mode("overwrite").parquet(path)
        checked = spark.read.parquet(path)
    pk = PRIMARY_KEY[table]
    # One key-only aggregation answers everything the load needs: rejected
    # rows, whether a good key repeats, and how many rows will be written.
    stats = (checked.groupBy(*pk)
             .agg(F.count_if(F.col("_reject").isNull()).alias("g"),
                  F.count_if(F.col("_reject").isNotNull()).alias("b"))
             .agg(F.coalesce(F.sum("b"), F.lit(0)).alias("n_bad"),
                  F.coalesce(F.max("g"), F.lit(0)).alias("max_good"),
                  F.count_if(F.col("g") > 0).alias("n_rows"),
                  F.coalesce(F.sum("g"), F.lit(0)).alias("n_good"))
             .first())
    n_bad, n_rows = int(stats["n_bad"]), int(stats["n_rows"])
    n_dup = int(stats["n_good"]) - n_rows
    # Always written, as rejects of an earlier load must not outlive a clean one;
    # without any, the rows are not read for it.
    bad = checked.where(F.col("_reject").isNotNull()).withColumnRenamed("_reject", "reason")
    (bad if n_bad else spark.createDataFrame([], bad.schema)).write.mode("overwrite").parquet(
        os.path.join(out_dir, "_rejects", table))
    good = checked.where(F.col("_reject").isNull()).drop("_reject")
    rows = first_per_key(good, pk, ARRIVAL.get(table, [])) if stats["max_good"] > 1 else good
    w = rows.write.mode("overwrite")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(os.path.join(out_dir, table))
    return n_rows, n_bad, n_dup


def load_star(spark: SparkSession, clean: dict[str, DataFrame], out_dir: str,
              partition_orders_by_year: bool = False, stage: bool = True,
              parallel: int = 4) -> DataFrame:
    """Write the star schema as Parquet (full refresh) and return a status
    DataFrame (table, rows, rejected, error) in load order.

    Tables load independently (no triggers to order around), so up to
    ``parallel`` table jobs are submitted at once: small dimension loads
    then share the cluster with the big facts instead of idling it. A failing
    table is recorded and the others still load; ``rows`` is what was
    written, not what was attempted.
    """
    def one(t: str):
        t0 = time.perf_counter()
        try:
            part = ["order_year"] if (t == "fact_orders" and partition_orders_by_year) else None
            n, nr, nd = load_table(spark, t, clean[SOURCE[t]], out_dir, part, stage)
            return (t, n, nr, nd, round(time.perf_counter() - t0, 3), None)
        except Exception as e:  # noqa: BLE001 - recorded per table, the load goes on
            return (t, None, None, None, round(time.perf_counter() - t0, 3),
                    f"{type(e).__name__}: {e}"[:500])

    with ThreadPoolExecutor(max_workers=max(1, parallel)) as pool:
        status = list(pool.map(one, LOAD_ORDER))
    return spark.createDataFrame(
        status, "table string, rows long, rejected long, skipped_duplicates long, "
                "seconds double, error string")


def write_clean(spark: SparkSession, clean: dict[str, DataFrame], out_dir: str,
                extra: dict[str, DataFrame] | None = None,
                parallel: int = 4) -> dict[str, DataFrame]:
    """Write every cleaned table (and optional extras such as the payment
    summary or the master mart) once as Parquet, up to ``parallel`` jobs at a
    time, and return the read-back frames, so later stages never recompute
    the cleaning plans."""
    tables = {**clean, **(extra or {})}

    def one(item):
        name, df = item
        df.write.mode("overwrite").parquet(os.path.join(out_dir, name))
        return name

    with ThreadPoolExecutor(max_workers=max(1, parallel)) as pool:
        list(pool.map(one, tables.items()))
    return {name: spark.read.parquet(os.path.join(out_dir, name)) for name in tables}


def read_star(spark: SparkSession, out_dir: str) -> dict[str, DataFrame]:
    return {t: spark.read.parquet(os.path.join(out_dir, t)) for t in LOAD_ORDER}


def register_views(star: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """Expose the warehouse tables as temp views under their own names, so
    SQL text written for the warehouse runs unchanged through ``spark.sql``."""
    for name, df in star.items():
        df.createOrReplaceTempView(name)
    return star
