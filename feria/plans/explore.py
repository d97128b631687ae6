"""Exploration report over the raw tables: the frames behind every chart
and printed finding of the profiling stage."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feria.functions import floor_days, ratio_round, to_ts, year_month
from feria.operators import profile as P
from feria.operators.aggregates import median_small_domain
from feria.operators import quality as Q
from feria.plans.clean import LAT_RANGE, LNG_RANGE, ORDER_TS

Raw = dict[str, DataFrame]


def orders_parsed(raw: Raw) -> DataFrame:
    o = raw["orders"]
    return o.withColumns({c: to_ts(o, c) for c in ORDER_TS})


def date_parse_nulls(raw: Raw) -> DataFrame:
    """NULL (or unparseable) count and share per order date column."""
    o = orders_parsed(raw).select(*ORDER_TS)
    return P.null_counts(o, "orders")


def status_counts(raw: Raw) -> DataFrame:
    return P.value_counts(raw["orders"], "order_status")


def monthly_orders(raw: Raw) -> DataFrame:
    """Orders per purchase month (NULL months dropped), by month."""
    o = orders_parsed(raw).withColumn("month", year_month("order_purchase_timestamp"))
    return P.value_counts(o, "month", by_value=True)


def temporal_anomalies(raw: Raw) -> DataFrame:
    """Approved before purchase; delivered to the customer before the
    carrier got it. Reported, not removed."""
    o = orders_parsed(raw)
    return Q.count_where(o, {
        "approved_before_purchase":
            F.col("order_approved_at") < F.col("order_purchase_timestamp"),
        "delivered_before_carrier":
            F.col("order_delivered_customer_date") < F.col("order_delivered_carrier_date"),
    })


def purchase_range(raw: Raw) -> DataFrame:
    o = orders_parsed(raw)
    return o.agg(F.min("order_purchase_timestamp").alias("first_purchase"),
                 F.max("order_purchase_timestamp").alias("last_purchase"))


def price_checks(raw: Raw) -> DataFrame:
    i = raw["order_items"]
    return Q.count_where(i, {
        "price_zero": F.col("price") == 0, "price_negative": F.col("price") < 0,
        "freight_zero": F.col("freight_value") == 0,
        "freight_negative": F.col("freight_value") < 0})


def items_per_order_stats(raw: Raw) -> DataFrame:
    """Mean (2 places) and max of items per order."""
    per = raw["order_items"].groupBy("order_id").agg(F.count("order_item_id").alias("n"))
    return per.agg(ratio_round(F.sum("n"), F.count(F.lit(1)), 2).alias("mean_items"),
                   F.max("n").alias("max_items"))


def multi_payment_stats(raw: Raw) -> DataFrame:
    """Orders with more than one payment row, and the largest row count."""
    per = raw["payments"].groupBy("order_id").agg(F.count(F.lit(1)).alias("n"))
    return per.agg(F.count_if(F.col("n") > 1).alias("orders_multi_payment"),
                   F.max("n").alias("max_payments"))


def zero_payments(raw: Raw) -> DataFrame:
    return Q.count_where(raw["payments"], {"zero_payments": F.col("payment_value") == 0})


def product_checks(raw: Raw) -> DataFrame:
    """Products without category (count, %) and zero sizes per column."""
    p = raw["products"]
    n = F.count(F.lit(1))
    miss = F.count_if(F.col("product_category_name").isNull())
    return p.agg(miss.alias("no_category"),
                 ratio_round(miss * 100, n, 2).alias("no_category_pct"),
                 *[F.count_if(F.col(c) == 0).alias(f"zero_{c}") for c in
                   ["product_weight_g", "product_length_cm", "product_height_cm",
                    "product_width_cm"]])


def review_checks(raw: Raw) -> DataFrame:
    """Reviews repeating an order, negative reviews (score <= 2) and %."""
    r = raw["reviews"]
    dup = Q.duplicate_count(r.select("order_id"), ["order_id"]) \
        .select(F.col("duplicates").alias("repeated_orders"))
    n = F.count(F.lit(1))
    neg = F.count_if(F.col("review_score") <= 2)
    return dup.crossJoin(r.agg(neg.alias("negative_reviews"),
                               ratio_round(neg * 100, n, 2).alias("negative_pct")))


def comment_length_histogram(raw: Raw, bins: int = 50) -> DataFrame:
    r = raw["reviews"].select(
        F.char_length(F.coalesce(F.col("review_comment_message"), F.lit(""))).alias("len"))
    return P.histogram(r, "len", bins)


def geolocation_checks(raw: Raw) -> DataFrame:
    """Distinct zips, rows repeating a zip (and %), coordinates outside the
    box (latitude and longitude separately)."""
    g = raw["geolocation"]
    z = "geolocation_zip_code_prefix"
    dup = Q.duplicate_count(g.select(z), [z])
    lat, lng = F.col("geolocation_lat"), F.col("geolocation_lng")
    out = g.agg(F.count_distinct(z).alias("zips"),
                F.count_if((lat < LAT_RANGE[0]) | (lat > LAT_RANGE[1])).alias("lat_outside"),
                F.count_if((lng < LNG_RANGE[0]) | (lng > LNG_RANGE[1])).alias("lng_outside"))
    return dup.crossJoin(out).select(
        "zips", F.col("duplicates").alias("rows_repeating_zip"),
        ratio_round(F.col("duplicates") * 100, F.col("rows"), 2).alias("repeat_pct"),
        "lat_outside", "lng_outside")


def customer_checks(raw: Raw) -> DataFrame:
    """Duplicate customer ids, distinct ids and distinct buyers."""
    c = raw["customers"]
    dup = Q.duplicate_count(c.select("customer_id"), ["customer_id"])
    return dup.crossJoin(c.agg(F.count_distinct("customer_id").alias("customer_ids"),
                               F.count_distinct("customer_unique_id").alias("buyers"))) \
        .select(F.col("duplicates").alias("duplicate_ids"), "customer_ids", "buyers")


def coordinate_sample(raw: Raw, n: int = 10000) -> DataFrame:
    g = raw["geolocation"]
    return P.hash_sample(g.select("geolocation_zip_code_prefix", "geolocation_lat",
                                  "geolocation_lng"),
                         n, ["geolocation_zip_code_prefix", "geolocation_lat",
                             "geolocation_lng"])


def integrity_report(raw: Raw) -> DataFrame:
    """Orphan report for the six foreign-key edges of the raw tables."""
    o, c, i, p, s = (raw["orders"], raw["customers"], raw["order_items"], raw["products"],
                     raw["sellers"])
    return Q.fk_report([
        (o, "orders", "customer_id", c, "customers", "customer_id"),
        (i, "order_items", "order_id", o, "orders", "order_id"),
        (i, "order_items", "product_id", p, "products", "product_id"),
        (i, "order_items", "seller_id", s, "sellers", "seller_id"),
        (raw["payments"], "payments", "order_id", o, "orders", "order_id"),
        (raw["reviews"], "reviews", "order_id", o, "orders", "order_id"),
    ])


def keys_without_items(raw: Raw) -> DataFrame:
    return Q.keys_without(raw["orders"], raw["order_items"], "order_id")


def keys_without_payment(raw: Raw) -> DataFrame:
    return Q.keys_without(raw["orders"], raw["payments"], "order_id")


def delivery_stats(clean_orders: DataFrame) -> DataFrame:
    """Mean (1 place) and exact median of delivery days, late orders,
    negative delivery times nulled."""
    dt = floor_days("order_delivered_customer_date", "order_purchase_timestamp")
    base = clean_orders.agg(
        F.count_if(dt < 0).alias("negative_delivery_times"),
        ratio_round(F.sum("delivery_time_days"), F.count("delivery_time_days"), 1)
        .alias("mean_days"),
        F.count_if(F.col("delay_days") > 0).alias("late_orders"))
    med = median_small_domain(clean_orders, [], "delivery_time_days", "_med")
    return base.crossJoin(F.broadcast(med)).select(
        "negative_delivery_times", "mean_days", F.round("_med", 1).alias("median_days"),
        "late_orders")
