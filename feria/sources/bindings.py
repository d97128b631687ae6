"""Driver tables presented as the raw marketplace tables.

The test data is a TPC-H-like schema; these bindings re-read it as the raw
marketplace files (customers, sellers, products, orders, order items,
payments, reviews, geolocation, category translation). Every binding is a
lazy DataFrame over the given tables, so its work grows with them.

The same definitions exist as DuckDB SQL in :mod:`feria.duck_oracle`; keep
the two in step.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from feria.functions.numeric import money
from feria.lazy import LazyTables

DRIVER_TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem",
                 "events", "documents", "embeddings", "pages", "benchmark", "labels",
                 "conversations"]


def read_driver(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))


def _nation(spark, sf_dir):
    # TPC-H fixes nation at 25 rows and region at 5, so broadcasting them is
    # bounded by the specification, not by the data volume.
    return F.broadcast(read_driver(spark, sf_dir, "nation"))


def _region(spark, sf_dir):
    return F.broadcast(read_driver(spark, sf_dir, "region"))


def _state_code():
    """Two-letter state code from the nation: first letter of the name and
    a letter chosen by the key (the warehouse declares state as CHAR(2))."""
    return F.concat(F.substring("n_name", 1, 1), F.expr("chr(65 + n_nationkey)"))


def _k(props: str = "props"):
    return F.get_json_object(F.col(props), "$.k").cast("int")


def raw_customers(spark, sf_dir) -> DataFrame:
    c = read_driver(spark, sf_dir, "customer")
    n = _nation(spark, sf_dir)
    return (c.join(n, c.c_nationkey == n.n_nationkey, "left")
            .select(F.col("c_custkey").alias("customer_id"),
                    F.expr("c_custkey div 2").alias("customer_unique_id"),
                    F.col("c_nationkey").alias("customer_zip_code_prefix"),
                    F.col("c_mktsegment").alias("customer_city"),
                    _state_code().alias("customer_state")))


def raw_sellers(spark, sf_dir) -> DataFrame:
    s = read_driver(spark, sf_dir, "supplier")
    n = _nation(spark, sf_dir)
    r = _region(spark, sf_dir)
    return (s.join(n, s.s_nationkey == n.n_nationkey, "left")
            .join(r, F.col("n_regionkey") == r.r_regionkey, "left")
            .select(F.col("s_suppkey").alias("seller_id"),
                    F.col("s_nationkey").alias("seller_zip_code_prefix"),
                    F.col("r_name").alias("seller_city"),
                    _state_code().alias("seller_state")))


def raw_geolocation(spark, sf_dir) -> DataFrame:
    c = read_driver(spark, sf_dir, "customer")
    n = _nation(spark, sf_dir)
    return (c.join(n, c.c_nationkey == n.n_nationkey, "left")
            .select(F.col("c_nationkey").alias("geolocation_zip_code_prefix"),
                    (F.col("c_acctbal") / 1000 - 3).alias("geolocation_lat"),
                    (F.lit(-30.0) - (F.col("c_custkey") % 50)).cast("double")
                    .alias("geolocation_lng"),
                    F.col("c_mktsegment").alias("geolocation_city"),
                    _state_code().alias("geolocation_state")))


def raw_products(spark, sf_dir) -> DataFrame:
    p = read_driver(spark, sf_dir, "part")
    return p.select(
        F.col("p_partkey").alias("product_id"),
        F.when(F.col("p_partkey") % 17 == 0, F.lit(None)).otherwise(F.col("p_brand"))
        .alias("product_category_name"),
        F.char_length("p_name").alias("product_name_lenght"),
        (F.col("p_size") * 10).alias("product_description_lenght"),
        (F.col("p_size") % 5).alias("product_photos_qty"),
        ((F.col("p_size") % 10) * 100).cast("double").alias("product_weight_g"),
        (F.col("p_size") % 7).cast("double").alias("product_length_cm"),
        (F.col("p_size") % 11).cast("double").alias("product_height_cm"),
        (F.col("p_size") % 13).cast("double").alias("product_width_cm"))


def raw_category_translation(spark, sf_dir) -> DataFrame:
    """PT -> EN lookup derived from the part brands (one row per brand). The
    'unknown' category of parts without a brand has no entry, which
    exercises the fall-back to the key."""
    p = read_driver(spark, sf_dir, "part")
    num = F.split_part(F.col("p_brand"), F.lit("#"), F.lit(2))
    return (p.select("p_brand").distinct()
            .select(F.col("p_brand").alias("product_category_name"),
                    F.concat(F.lit("brand_"), num).alias("product_category_name_english")))


def raw_orders(spark, sf_dir) -> DataFrame:
    o = read_driver(spark, sf_dir, "orders")
    li = (read_driver(spark, sf_dir, "lineitem")
          .groupBy("l_orderkey")
          .agg(F.min("l_shipdate").alias("first_ship"), F.max("l_shipdate").alias("last_ship")))
    st = F.col("o_orderstatus")
    return (o.join(li, o.o_orderkey == li.l_orderkey, "left")
            .select(
                F.col("o_orderkey").alias("order_id"),
                F.col("o_custkey").alias("customer_id"),
                F.when(st == "F", "delivered").when(st == "P", "canceled")
                .otherwise("shipped").alias("order_status"),
                F.col("o_orderdate").alias("order_purchase_timestamp"),
                F.when((st == "P") & (F.col("o_orderkey") % 4 == 0), F.lit(None))
                .otherwise(F.timestamp_add("HOUR", (F.col("o_orderkey") % 7) - 1,
                                          F.col("o_orderdate")))
                .alias("order_approved_at"),
                F.when(st != "P", F.col("first_ship")).alias("order_delivered_carrier_date"),
                F.when(st == "F", F.col("last_ship")).alias("order_delivered_customer_date"),
                F.timestamp_add("DAY",
                               F.lit(40) + 20 * F.substring("o_orderpriority", 1, 1).cast("int"),
                               F.col("o_orderdate")).alias("order_estimated_delivery_date")))


def raw_order_items(spark, sf_dir) -> DataFrame:
    """One row per (order, line): duplicates of the key keep the smallest
    (part, supplier, price, ship date, tax). The rows are dealt by key first:
    few keys repeat, and a minimum of structs before the shuffle would sort
    each whole input split, spilling it, to take few rows away."""
    li = read_driver(spark, sf_dir, "lineitem")
    m = F.min(F.struct("l_partkey", "l_suppkey", "l_extendedprice", "l_shipdate", "l_tax"))
    return (li.repartition("l_orderkey", "l_linenumber").groupBy("l_orderkey", "l_linenumber").agg(m.alias("m"))
            .select(F.col("l_orderkey").alias("order_id"),
                    F.col("l_linenumber").alias("order_item_id"),
                    F.col("m.l_partkey").alias("product_id"),
                    F.col("m.l_suppkey").alias("seller_id"),
                    F.col("m.l_shipdate").alias("shipping_limit_date"),
                    money(F.col("m.l_extendedprice")).alias("price"),
                    money(F.col("m.l_extendedprice") * F.col("m.l_tax")).alias("freight_value")))


def raw_payments(spark, sf_dir) -> DataFrame:
    e = read_driver(spark, sf_dir, "events").withColumn("_k", _k())
    k = F.col("_k")
    return (e.where(~F.col("event_type").isin("click", "view"))
            .select(F.expr("event_id div 2").alias("order_id"),
                    ((F.col("event_id") % 2) + 1).cast("int").alias("payment_sequential"),
                    F.when(F.col("event_id") % 5 == 0,
                           F.concat(F.upper("event_type"), F.lit(" ")))
                    .otherwise(F.col("event_type")).alias("payment_type"),
                    (k % 12).alias("payment_installments"),
                    money(F.when(k % 50 == 0, F.lit(0.0)).otherwise(F.col("value")))
                    .alias("payment_value")))


def raw_reviews(spark, sf_dir) -> DataFrame:
    e = read_driver(spark, sf_dir, "events").withColumn("_k", _k())
    k = F.col("_k")
    return (e.where(F.col("event_type").isin("click", "view"))
            .select(F.col("event_id").alias("review_id"),
                    F.expr("event_id div 2").alias("order_id"),
                    (k % 5 + 1).alias("review_score"),
                    F.when(k % 3 == 0, F.concat(F.lit("titulo "), k.cast("string")))
                    .alias("review_comment_title"),
                    F.when(k % 4 == 1, F.lit("")).when(k % 4 == 2, F.lit(" "))
                    .when(k % 4 == 3, F.concat(F.lit("comentario "), k.cast("string")))
                    .alias("review_comment_message"),
                    F.timestamp_add("DAY", -(k % 3), F.col("ts")).alias("review_creation_date"),
                    F.when(k % 23 == 0, F.lit(None)).otherwise(F.col("ts"))
                    .alias("review_answer_timestamp")))


BINDINGS = {
    "customers": raw_customers,
    "sellers": raw_sellers,
    "geolocation": raw_geolocation,
    "products": raw_products,
    "category_translation": raw_category_translation,
    "orders": raw_orders,
    "order_items": raw_order_items,
    "payments": raw_payments,
    "reviews": raw_reviews,
}


def raw_tables(spark: SparkSession, sf_dir: str) -> LazyTables:
    """The nine raw tables over the driver Parquet; a table's files are opened
    when it is first asked for."""
    return LazyTables({name: (lambda fn=fn: fn(spark, sf_dir)) for name, fn in BINDINGS.items()})
