"""Q1-Q5: the five business questions, over the star schema.

Sort rules follow the warehouse: NULL last on ascending, NULL first on
descending keys; every top-k adds the group key as a final tie-break so a
LIMIT always returns the same rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from feria.functions import money_mean_round, money_round, pct, ratio_round
from feria.operators.aggregates import weighted_median

Star = dict[str, DataFrame]


def q1_monthly_volume(star: Star) -> DataFrame:
    """Orders per month, delivered orders and delivery rate."""
    o = star["fact_orders"]
    delivered = F.count_if(F.col("is_delivered") == 1)
    return (o.where(F.col("order_yearmonth").isNotNull())
            .groupBy("order_yearmonth")
            .agg(F.count(F.lit(1)).alias("total_orders"), delivered.alias("delivered_orders"),
                 pct(delivered, F.count(F.lit(1)), 2).alias("delivery_rate_pct"))
            .orderBy(F.col("order_yearmonth").asc_nulls_last()))


def q2_top_categories(star: Star, k: int = 10) -> DataFrame:
    """Top-k English categories by item revenue."""
    oi, p = star["fact_order_items"], star["dim_products"]
    j = (oi.select("order_id", "product_id", "price")
         .join(p.select("product_id", "category_name_en")
               .where(F.col("category_name_en").isNotNull()), "product_id"))
    return (j.groupBy("category_name_en")
            .agg(F.count_distinct("order_id").alias("total_orders"),
                 F.sum("price").cast("double").alias("total_revenue"),
                 money_mean_round("price", 2).alias("avg_price"),
                 F.count(F.lit(1)).alias("items_sold"))
            .orderBy(F.col("total_revenue").desc_nulls_first(),
                     F.col("category_name_en").asc())
            .limit(k))


def _delivered_with_state(star: Star) -> DataFrame:
    o, c = star["fact_orders"], star["dim_customers"]
    return (o.where((F.col("is_delivered") == 1) & F.col("delivery_time_days").isNotNull())
            .select("customer_id", "delivery_time_days", "delay_days")
            .join(c.select("customer_id", "state"), "customer_id"))


def q3_delivery_by_state(star: Star) -> DataFrame:
    """Delivery time (mean, exact median), delay and late share per
    customer state, for delivered orders."""
    return (days_by_state(_delivered_with_state(star)).groupBy("state")
            .agg(F.sum("_n").alias("delivered_orders"),
                 ratio_round(F.sum("_days"), F.sum("_n_days"), 1).alias("avg_delivery_days"),
                 F.round(weighted_median("delivery_time_days", "_n_days"), 1)
                 .alias("median_delivery_days"),
                 ratio_round(F.sum("_delay"), F.sum("_n_delay"), 1).alias("avg_delay_days"),
                 F.sum("_late").alias("late_deliveries"),
                 pct(F.sum("_late"), F.sum("_n"), 2).alias("late_pct"))
            .withColumnRenamed("state", "customer_state")
            .orderBy(F.col("avg_delivery_days").desc_nulls_first(),
                     F.col("customer_state").asc_nulls_last()))


def days_by_state(rows: DataFrame) -> DataFrame:
    """One row per (state, delivery days) with the sums that means, late shares
    and the weighted median need: the joined orders are read once, and few rows
    per state are left."""
    days, delay = F.col("delivery_time_days"), F.col("delay_days")
    n = F.count(F.lit(1))
    return rows.groupBy("state", "delivery_time_days").agg(
        n.alias("_n"), F.sum(days).alias("_days"), F.count(days).alias("_n_days"),
        F.sum(delay).alias("_delay"), F.count(delay).alias("_n_delay"),
        F.count_if(delay > 0).alias("_late"))


def order_flags(star: Star, orders: DataFrame | None = None) -> DataFrame:
    """Per-order incident flags: canceled, late (>= 1 whole day), negative
    review (0 without review), any of them."""
    o = orders if orders is not None else star["fact_orders"]
    r = star["fact_reviews"].select("order_id", F.col("is_negative").alias("_neg"))
    j = o.select("order_id", "order_status", "delay_days").join(r, "order_id", "left")
    canceled = F.col("order_status") == "canceled"
    late = F.col("delay_days") > 0
    neg = F.col("_neg") == 1
    return j.select(
        "order_id",
        F.when(canceled, 1).otherwise(0).alias("is_canceled"),
        F.when(late, 1).otherwise(0).alias("is_late"),
        F.coalesce(F.col("_neg").cast("int"), F.lit(0)).alias("is_negative_review"),
        F.when(canceled | late | neg, 1).otherwise(0).alias("has_any_incident"))


def q4_incident_rates(star: Star) -> DataFrame:
    f = order_flags(star)
    n = F.count(F.lit(1))
    sums = {c: F.sum(c) for c in ["is_canceled", "is_late", "is_negative_review",
                                  "has_any_incident"]}
    return f.agg(
        n.alias("total_orders"),
        sums["is_canceled"].alias("canceled"),
        sums["is_late"].alias("late_deliveries"),
        sums["is_negative_review"].alias("negative_reviews"),
        sums["has_any_incident"].alias("with_any_incident"),
        pct(sums["is_canceled"], n, 2).alias("canceled_pct"),
        pct(sums["is_late"], n, 2).alias("late_pct"),
        pct(sums["is_negative_review"], n, 2).alias("negative_review_pct"),
        pct(sums["has_any_incident"], n, 2).alias("incident_pct"))


def seller_orders(star: Star, orders: DataFrame) -> DataFrame:
    """One row per (seller, order) of the given orders, with the number of the
    seller's items in it, their price, and the order's facts and review.

    Items are summed per (seller, order) before anything else, combined
    map-side, and orders and reviews join on the order: rows never move to a
    seller before they are per-order sums, so a large seller is no hot key."""
    oi, r = star["fact_order_items"], star["fact_reviews"]
    items = oi.groupBy("seller_id", "order_id").agg(
        F.count(F.lit(1)).alias("_items"), F.sum("price").alias("_price"))
    return (items.join(orders, "order_id")
            .join(r.select("order_id", "review_score", "is_negative"), "order_id", "left"))


def seller_sums(rows: DataFrame, weight: Column) -> DataFrame:
    """Per seller the sums over its orders, each counted ``weight`` times."""
    def total(c: str) -> Column:
        return F.sum(F.col(c) * weight)

    def known(c: str) -> Column:
        return F.sum(F.when(F.col(c).isNotNull(), weight))

    return rows.groupBy("seller_id").agg(
        F.count(F.lit(1)).alias("_orders"), F.sum("_price").alias("_revenue"),
        total("review_score").alias("_score"), known("review_score").alias("_scores"),
        total("delivery_time_days").alias("_days"), known("delivery_time_days").alias("_n_days"),
        F.sum(F.when(F.col("is_negative") == 1, weight).otherwise(0)).alias("_negative"),
        F.sum(F.when(F.col("delay_days") > 0, weight).otherwise(0)).alias("_late"))


def q5_seller_quality(star: Star, min_orders: int = 50, k: int = 20) -> DataFrame:
    """Sellers with at least ``min_orders`` delivered orders, ranked by mean
    review score then revenue. Counts are per item row, percentages per
    distinct order, as in the warehouse query. The seller dimension joins the
    per-seller sums."""
    s = star["dim_sellers"].select("seller_id", F.col("city").alias("seller_city"),
                                   F.col("state").alias("seller_state"))
    o = (star["fact_orders"].where(F.col("is_delivered") == 1)
         .select("order_id", "delivery_time_days", "delay_days"))
    sums = seller_sums(seller_orders(star, o), F.col("_items")).where(F.col("_orders") >= min_orders)
    return (sums.join(s, "seller_id")
            .select("seller_id", "seller_city", "seller_state",
                    F.col("_orders").alias("total_orders"),
                    money_round("_revenue", 2).alias("total_revenue"),
                    ratio_round("_score", "_scores", 2).alias("avg_review_score"),
                    F.col("_negative").alias("negative_reviews"),
                    pct("_negative", "_orders", 2).alias("negative_pct"),
                    ratio_round("_days", "_n_days", 1).alias("avg_delivery_days"),
                    F.col("_late").alias("late_orders"),
                    pct("_late", "_orders", 2).alias("late_pct"))
            .orderBy(F.col("avg_review_score").desc_nulls_first(),
                     F.col("total_revenue").desc_nulls_first(),
                     F.col("seller_id").asc())
            .limit(k))
