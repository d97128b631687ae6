"""Dashboard answers from a cube of year, state and status: the facts are unread.

A cell holds the sums of its orders, so any choice of years, states and statuses
is a sum of cells. An order lies in one cell, so numbers of orders add up, also
by month, category or score. A buyer may lie in many: each cell has the buyers'
bits, and cells are put together by OR, which keeps distinct counts exact.

Buyers are numbered inside hash buckets, so that no task numbers all of them;
``buckets`` grows with the buyers (some millions of them a bucket).
"""

from __future__ import annotations

import os
from collections.abc import Mapping
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from feria.functions import money_round, pct, ratio_round
from feria.plans.dashboard import Filters, filtered_orders

Cube = Mapping[str, DataFrame]
CELL = ["order_year", "state", "order_status"]
#: The bits that a row of Spark's bitmap functions holds.
ROW_BITS = 32768


def order_cells(orders: DataFrame) -> DataFrame:
    """The cells' sums by month, for every way that the dashboard joins the orders
    to their payments and reviews: each order as often as that join repeats it."""
    def rows(c: str) -> Column:
        return F.greatest(F.coalesce(c, F.lit(0)), F.lit(1))

    paid, seen, one = rows("_payments"), rows("_reviews"), F.lit(1).cast("long")
    days, scores, negative = F.col("delivery_time_days"), F.coalesce("_scores", F.lit(0)), F.coalesce("_negative", F.lit(0))
    canceled, late = F.coalesce(F.col("order_status") == "canceled", F.lit(False)), F.coalesce(F.col("delay_days") > 0, F.lit(False))

    def sums(kind: str, n: Column, whole: Column, told: Column | None) -> list[Column]:
        score = [F.sum(F.col("_score") * told).alias(f"{kind}_score"), F.sum(scores * told).alias(f"{kind}_n_score")] if told is not None else []
        return [F.sum(n).alias(f"{kind}_n"), F.sum(F.col("payment_value") * whole.cast("int")).alias(f"{kind}_revenue"), F.sum(days * n).alias(f"{kind}_days"),
                F.sum(F.when(days.isNotNull(), n).otherwise(0)).alias(f"{kind}_n_days"), F.sum(F.when(F.col("is_delivered") == 1, n).otherwise(0)).alias(f"{kind}_delivered"),
                F.sum(F.when(canceled, n).otherwise(0)).alias(f"{kind}_canceled"), *score]

    return orders.groupBy(*CELL, "order_yearmonth").agg(
        F.count(F.lit(1)).alias("_orders"),
        *sums("written", paid * seen, seen, paid), *sums("by_order", seen, seen, one), *sums("months", paid, one, None), *sums("months_by_order", one, one, None),
        F.sum(F.when(canceled, seen).otherwise(0)).alias("canceled"), F.sum(F.when(late, seen).otherwise(0)).alias("late"), F.sum(negative).alias("negative_reviews"),
        F.sum(F.when(canceled | late, seen).otherwise(negative)).alias("_any"), F.sum(seen).alias("total"))


def _sums(cells: DataFrame, kind: str, *more: str) -> DataFrame:
    """One way's sums of :func:`order_cells` by cell and ``more``."""
    def total(c: str) -> Column:
        return F.sum(f"{kind}{c}").alias(c) if f"{kind}{c}" in cells.columns else F.lit(None if c == "_score" else 0).cast("long").alias(c)

    return cells.groupBy(*CELL, *more).agg(*[total(c) for c in ("_n", "_revenue", "_days", "_n_days", "_canceled", "_score", "_n_score", "_delivered")])


def _buyer_bits(orders: DataFrame, buckets: int) -> DataFrame:
    """The buyers' bits. A bucket's rows meet once, each buyer once a cell, so that
    a bitmap is made in one task and none is shuffled."""
    bucket = F.pmod(F.xxhash64("customer_unique_id"), F.lit(buckets)).cast("int").alias("bucket")
    buyers = orders.where(F.col("customer_unique_id").isNotNull()).select(*CELL, "customer_unique_id", bucket).distinct()
    placed = buyers.withColumn("number", F.dense_rank().over(Window.partitionBy("bucket").orderBy("customer_unique_id")) - 1)
    return placed.groupBy(*CELL, "bucket", F.floor(F.col("number") / ROW_BITS).cast("int").alias("block")).agg(
        F.bitmap_construct_agg((F.col("number") % ROW_BITS).cast("long")).alias("held"))


def order_sums(star: Mapping[str, DataFrame]) -> DataFrame:
    """The orders that the dashboard shows, each with its cell, its buyer and the
    sums of its payments and reviews. All but the customer joins on the order."""
    whole = star["fact_payments"].groupBy("order_id").agg(F.count(F.lit(1)).alias("_payments"), F.sum("payment_value").alias("payment_value"))
    told = star["fact_reviews"].groupBy("order_id").agg(
        F.count(F.lit(1)).alias("_reviews"), F.sum("review_score").alias("_score"), F.count("review_score").alias("_scores"),
        F.sum(F.col("is_negative").cast("int")).alias("_negative"))
    sums = [c for c in whole.columns + told.columns if c != "order_id"]
    wide = star["fact_orders"].join(whole, "order_id", "left").join(told, "order_id", "left")
    kept = ["delivery_time_days", "delay_days", "order_yearmonth", "is_delivered"]
    return filtered_orders({"fact_orders": wide, "dim_customers": star["dim_customers"]}, Filters(), kept + sums).drop("customer_id")


def write_rows(spark: SparkSession, star: Mapping[str, DataFrame], path: str) -> dict[str, DataFrame]:
    """What the cube is made from, written once: the tables of a lazy star would
    be cleaned and joined anew for each table of the cube."""
    def stored(name: str, df: DataFrame) -> DataFrame:
        df.write.mode("overwrite").parquet(os.path.join(path, name))
        return spark.read.parquet(os.path.join(path, name))

    reviews = stored("fact_reviews", star["fact_reviews"].select("order_id", "review_score", "is_negative"))
    sums = stored("order_sums", order_sums({**{t: star[t] for t in ("fact_orders", "fact_payments", "dim_customers")}, "fact_reviews": reviews}))
    cells = stored("order_cells", order_cells(sums))
    return {"order_sums": sums, "order_cells": cells, "fact_reviews": reviews, **{t: star[t] for t in ("fact_order_items", "dim_products")}}


def build_cube(star: Mapping[str, DataFrame], buckets: int = 64) -> dict[str, DataFrame]:
    """The cube's tables, lazily; ``star`` may be that of :func:`write_rows`. Orders
    without a year or a customer are in no cell, as the dashboard never shows them."""
    o = star["order_sums"] if "order_sums" in star else order_sums(star)
    cells = star["order_cells"] if "order_cells" in star else order_cells(o)
    r = star["fact_reviews"].select("order_id", "review_score")
    place = o.select("order_id", *CELL)
    items = star["fact_order_items"].select("order_id", "product_id", "price")
    named = star["dim_products"].select("product_id", F.col("category_name_en").alias("category")).where("category IS NOT NULL")
    # Dealt to all shuffle partitions: those put together by their compressed size
    # hold millions of orders, whose groups by category do not fit in memory.
    dealt = int(o.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    sold = items.join(named, "product_id").repartition(dealt, "order_id")
    return {
        "orders": cells.groupBy(*CELL).agg(F.sum("_orders").alias("_orders")),
        "written": _sums(cells, "written"),
        "by_order": _sums(cells, "by_order"),
        "months": _sums(cells, "months", "order_yearmonth"),
        "months_by_order": _sums(cells, "months_by_order", "order_yearmonth"),
        "scores": place.join(r, "order_id").groupBy(*CELL, "review_score").agg(F.count(F.lit(1)).alias("total")),
        "incidents": cells.groupBy(*CELL).agg(*[F.sum(c).alias(c) for c in ("canceled", "late", "negative_reviews", "_any", "total")]),
        "categories": sold.join(place, "order_id").groupBy(*CELL, "category").agg(
            F.count_distinct("order_id").alias("orders"), F.sum("price").alias("_revenue"),
            F.sum((F.col("price") * 100).cast("bigint")).alias("_cents"), F.count("price").alias("_prices"), F.count(F.lit(1)).alias("items_sold")),
        "buyers": _buyer_bits(o, buckets),
    }


def write_cube(spark: SparkSession, cube: Cube, path: str, parallel: int = 4) -> dict[str, DataFrame]:
    """Write the cube's tables, up to ``parallel`` at a time, the largest first: the
    small ones fill the cores that it leaves."""
    def one(name: str) -> None:
        cube[name].write.mode("overwrite").parquet(os.path.join(path, name))

    with ThreadPoolExecutor(max_workers=max(1, parallel)) as pool:
        list(pool.map(one, sorted(cube, key=lambda name: name != "categories")))
    return read_cube(spark, path)


def read_cube(spark: SparkSession, path: str) -> dict[str, DataFrame]:
    names = ["orders", "written", "by_order", "months", "months_by_order", "scores", "incidents", "categories", "buyers"]
    return {name: spark.read.parquet(os.path.join(path, name)) for name in names}


def _kpi(cube: Cube, cells: str, flt: Filters) -> DataFrame:
    at = flt.predicate()
    sums = cube[cells].where(at).agg(
        money_round(F.sum("_revenue"), 0).alias("total_revenue"), ratio_round(F.sum("_days"), F.sum("_n_days"), 1).alias("avg_delivery_days"),
        pct(F.coalesce(F.sum("_canceled"), F.lit(0)), F.coalesce(F.sum("_n"), F.lit(0)), 2).alias("cancel_rate"),
        ratio_round(F.sum("_score"), F.sum("_n_score"), 2).alias("avg_review"))
    orders = cube["orders"].where(at).agg(F.coalesce(F.sum("_orders"), F.lit(0)).alias("total_orders"))
    together = cube["buyers"].where(at).groupBy("bucket", "block").agg(F.bitmap_or_agg("held").alias("held"))
    buyers = together.agg(F.coalesce(F.sum(F.bitmap_count("held")), F.lit(0)).alias("unique_buyers"))
    # One row each.
    return orders.crossJoin(F.broadcast(sums)).crossJoin(F.broadcast(buyers)).select(
        "total_orders", "total_revenue", "unique_buyers", "avg_delivery_days", "cancel_rate", "avg_review")


def kpi_row(cube: Cube, flt: Filters = Filters()) -> DataFrame:
    """``dashboard.kpi_row`` from the cube."""
    return _kpi(cube, "written", flt)


def kpi_row_by_order(cube: Cube, flt: Filters = Filters()) -> DataFrame:
    return _kpi(cube, "by_order", flt)


def _monthly(cube: Cube, cells: str, flt: Filters) -> DataFrame:
    return (cube[cells].where(flt.predicate()).where(F.col("order_yearmonth").isNotNull()).groupBy("order_yearmonth")
            .agg(F.sum("_n").alias("total_orders"), F.sum("_delivered").alias("delivered"), money_round(F.sum("_revenue"), 0).alias("revenue"))
            .orderBy("order_yearmonth"))


def monthly(cube: Cube, flt: Filters = Filters()) -> DataFrame:
    return _monthly(cube, "months", flt)


def monthly_by_order(cube: Cube, flt: Filters = Filters()) -> DataFrame:
    return _monthly(cube, "months_by_order", flt)


def score_distribution(cube: Cube, flt: Filters = Filters()) -> DataFrame:
    g = cube["scores"].where(flt.predicate()).groupBy("review_score").agg(F.sum("total").alias("total"))
    return g.withColumn("pct", pct(F.col("total"), F.sum("total").over(Window.partitionBy()), 1)).orderBy("review_score")


def incident_split(cube: Cube, flt: Filters = Filters()) -> DataFrame:
    total = F.coalesce(F.sum("total"), F.lit(0))
    return cube["incidents"].where(flt.predicate()).agg(
        F.sum("canceled").alias("canceled"), F.sum("late").alias("late"), F.sum("negative_reviews").alias("negative_reviews"),
        (total - F.sum("_any")).alias("no_incident"), total.alias("total"))


def top_categories(cube: Cube, flt: Filters = Filters(), k: int = 10) -> DataFrame:
    return (cube["categories"].where(flt.predicate()).groupBy("category")
            .agg(F.sum("orders").alias("orders"), money_round(F.sum("_revenue"), 0).alias("revenue"),
                 ratio_round(F.sum("_cents"), F.sum("_prices") * 100, 2).alias("avg_price"), F.sum("items_sold").alias("items_sold"))
            .orderBy(F.col("revenue").desc_nulls_first(), F.col("category").asc()).limit(k))
