"""Per-table cleaning jobs (raw -> clean), one lazy plan each."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feria.functions import (flag, floor_days, nan_to_null, normalize_text, strip_ws, to_ts,
                             upper_strip, year_month)
from feria.operators.aggregates import (grouped_and_global_medians, grouped_medians,
                                        grouped_modes)
from feria.lazy import LazyTables
from feria.operators.dedup import latest_per_key

# Inclusive bounding box of valid coordinates.
LAT_RANGE = (-33.7, 5.3)
LNG_RANGE = (-73.9, -28.8)

DIM_COLS = ["product_weight_g", "product_length_cm", "product_height_cm", "product_width_cm"]
ORDER_TS = ["order_purchase_timestamp", "order_approved_at", "order_delivered_carrier_date",
            "order_delivered_customer_date", "order_estimated_delivery_date"]


def in_bbox(lat: str, lng: str):
    return (F.col(lat).between(*LAT_RANGE)) & (F.col(lng).between(*LNG_RANGE))


def clean_geolocation(geo: DataFrame) -> DataFrame:
    """Drop coordinates outside the box, normalise the city, then one row
    per zip: exact median lat / lng, most frequent city / state.

    Medians and modes run as two-stage aggregates (count per value first),
    so a zip holding a large share of all rows is spread over many tasks.
    """
    z = "geolocation_zip_code_prefix"
    g = (geo.where(in_bbox("geolocation_lat", "geolocation_lng"))
         .where(F.col(z).isNotNull())
         .withColumn("geolocation_city", normalize_text("geolocation_city")))
    med = grouped_medians(g, [z], ["geolocation_lat", "geolocation_lng"])
    modes = grouped_modes(g, [z], ["geolocation_city", "geolocation_state"])
    return med.join(modes, z).select(z, "geolocation_lat", "geolocation_lng",
                                     "geolocation_city", "geolocation_state")


def clean_customers(customers: DataFrame) -> DataFrame:
    return customers.withColumns({
        "customer_city": normalize_text("customer_city"),
        "customer_state": upper_strip("customer_state"),
    })


def clean_sellers(sellers: DataFrame) -> DataFrame:
    return sellers.withColumns({
        "seller_city": normalize_text("seller_city"),
        "seller_state": upper_strip("seller_state"),
    })


def translation_lookup(translation: DataFrame) -> DataFrame:
    """One row per Portuguese name (a dict keeps the last duplicate; with no
    file order in Spark the largest English name is kept), NULL keys dropped."""
    return (translation.where(F.col("product_category_name").isNotNull())
            .groupBy("product_category_name")
            .agg(F.max("product_category_name_english").alias("product_category_name_english")))


def clean_products(products: DataFrame, translation: DataFrame) -> DataFrame:
    """Category 'unknown' for NULL, English name with fall-back to the key,
    NaN and zero sizes -> NULL, then fill from the category median and last from the
    global median (both over the pre-fill column)."""
    p = products.withColumn("product_category_name",
                            F.coalesce(F.col("product_category_name"), F.lit("unknown")))
    p = p.withColumns({c: F.nullif(nan_to_null(c), F.lit(0).cast(p.schema[c].dataType))
                       for c in DIM_COLS})
    lk = translation_lookup(translation)
    # The lookup is one row per category: small, and AQE turns this into a
    # broadcast join at run time from its measured size.
    p = (p.join(lk, "product_category_name", "left")
         .withColumn("product_category_name_english",
                     F.coalesce(F.col("product_category_name_english"),
                                F.col("product_category_name"))))
    # Medians are taken over the pre-fill columns, per category and globally, in
    # one pass; they are one row per category, which goes to every task if small.
    med = grouped_and_global_medians(p, "product_category_name", DIM_COLS)
    cat_med = med.where(F.col("product_category_name").isNotNull()) \
        .select("product_category_name", *[F.col(c).alias(f"_cm_{c}") for c in DIM_COLS])
    glob_med = med.where(F.col("product_category_name").isNull()) \
        .agg(*[F.max(c).alias(f"_gm_{c}") for c in DIM_COLS])
    out = (p.join(cat_med, "product_category_name", "left")
           .crossJoin(F.broadcast(glob_med)))  # one row by construction
    out = out.withColumns({c: F.coalesce(F.col(c), F.col(f"_cm_{c}"), F.col(f"_gm_{c}"))
                           for c in DIM_COLS})
    cols = products.columns + ["product_category_name_english"]
    return out.select(*cols)


def clean_orders(orders: DataFrame, order_items: DataFrame) -> DataFrame:
    """Parse dates, delivered flag, floored day counts (negative delivery
    time -> NULL, delay keeps its sign), year / month / 'yyyy-MM', and the
    has-items flag from a left join to the distinct item keys."""
    o = orders.withColumns({c: to_ts(orders, c) for c in ORDER_TS})
    dt = floor_days("order_delivered_customer_date", "order_purchase_timestamp")
    o = o.withColumns({
        "is_delivered": flag(F.col("order_status") == "delivered"),
        "delivery_time_days": F.when(dt >= 0, dt),
        "delay_days": floor_days("order_delivered_customer_date",
                                 "order_estimated_delivery_date"),
        "order_year": F.year("order_purchase_timestamp"),
        "order_month": F.month("order_purchase_timestamp"),
        "order_yearmonth": year_month("order_purchase_timestamp"),
    })
    # Distinct first: duplicates are combined map-side, so a hot order never
    # lands whole in one task of the join.
    keys = order_items.select("order_id").distinct().withColumn("_hit", F.lit(1))
    return (o.join(keys, "order_id", "left")
            .withColumn("has_items", F.coalesce(F.col("_hit"), F.lit(0)))
            .drop("_hit")
            .select(*o.columns, "has_items"))


def clean_order_items(items: DataFrame) -> DataFrame:
    return items.withColumns({
        "shipping_limit_date": to_ts(items, "shipping_limit_date"),
        "total_item_value": F.col("price") + F.col("freight_value"),
    })


def clean_payments(payments: DataFrame) -> DataFrame:
    """Keep strictly positive payments (drops zero, negative and NULL),
    payment type lower-cased and stripped."""
    return (payments.where(F.col("payment_value") > 0)
            .withColumn("payment_type", strip_ws(F.lower("payment_type"))))


def clean_reviews(reviews: DataFrame) -> DataFrame:
    """Parse dates, keep the latest answered review per order (NULL time
    last, ties by smallest review id), empty text for NULL comments, then
    the negative (score <= 2) and has-comment flags."""
    r = reviews.withColumns({
        "review_creation_date": to_ts(reviews, "review_creation_date"),
        "review_answer_timestamp": to_ts(reviews, "review_answer_timestamp"),
    })
    r = latest_per_key(r, "order_id", "review_answer_timestamp", "review_id")
    r = r.withColumns({
        "review_comment_title": F.coalesce(F.col("review_comment_title"), F.lit("")),
        "review_comment_message": F.coalesce(F.col("review_comment_message"), F.lit("")),
    })
    return r.withColumns({
        "is_negative": flag(F.col("review_score") <= 2),
        "has_comment": flag(F.char_length("review_comment_message") > 0),
    })


def clean_all(raw: dict[str, DataFrame]) -> LazyTables:
    """All cleaned tables from the raw ones, each planned on first access
    (product and geolocation cleaning run sketch jobs while planning, so a
    query that needs neither never pays for them)."""
    return LazyTables({
        "geolocation": lambda: clean_geolocation(raw["geolocation"]),
        "customers": lambda: clean_customers(raw["customers"]),
        "sellers": lambda: clean_sellers(raw["sellers"]),
        "products": lambda: clean_products(raw["products"], raw["category_translation"]),
        "orders": lambda: clean_orders(raw["orders"], raw["order_items"]),
        "order_items": lambda: clean_order_items(raw["order_items"]),
        "payments": lambda: clean_payments(raw["payments"]),
        "reviews": lambda: clean_reviews(raw["reviews"]),
    })
