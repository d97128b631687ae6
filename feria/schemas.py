"""Explicit schemas for the raw marketplace tables and the star schema.

No schema inference anywhere: raw CSVs are read with these StructTypes and
the warehouse tables are projected and cast to them on load.
"""

from __future__ import annotations

from pyspark.sql import types as T

S, I, L, D = T.StringType(), T.IntegerType(), T.LongType(), T.DoubleType()
SH = T.ShortType()
TS = T.TimestampNTZType()
MONEY = T.DecimalType(10, 2)
SIZE = T.DecimalType(8, 2)
COORD = T.DecimalType(9, 6)


def _st(*fields) -> T.StructType:
    return T.StructType([T.StructField(n, t, nullable) for n, t, nullable in fields])


# ---------------------------------------------------------------- raw files
# Timestamps arrive as text in the CSVs and are parsed tolerantly later,
# so the raw schema declares them as strings.
RAW = {
    "customers": _st(("customer_id", S, True), ("customer_unique_id", S, True),
                     ("customer_zip_code_prefix", I, True), ("customer_city", S, True),
                     ("customer_state", S, True)),
    "sellers": _st(("seller_id", S, True), ("seller_zip_code_prefix", I, True),
                   ("seller_city", S, True), ("seller_state", S, True)),
    "products": _st(("product_id", S, True), ("product_category_name", S, True),
                    ("product_name_lenght", I, True), ("product_description_lenght", I, True),
                    ("product_photos_qty", I, True), ("product_weight_g", D, True),
                    ("product_length_cm", D, True), ("product_height_cm", D, True),
                    ("product_width_cm", D, True)),
    "orders": _st(("order_id", S, True), ("customer_id", S, True), ("order_status", S, True),
                  ("order_purchase_timestamp", S, True), ("order_approved_at", S, True),
                  ("order_delivered_carrier_date", S, True),
                  ("order_delivered_customer_date", S, True),
                  ("order_estimated_delivery_date", S, True)),
    "order_items": _st(("order_id", S, True), ("order_item_id", I, True), ("product_id", S, True),
                       ("seller_id", S, True), ("shipping_limit_date", S, True),
                       ("price", MONEY, True), ("freight_value", MONEY, True)),
    "payments": _st(("order_id", S, True), ("payment_sequential", I, True),
                    ("payment_type", S, True), ("payment_installments", I, True),
                    ("payment_value", MONEY, True)),
    "reviews": _st(("review_id", S, True), ("order_id", S, True), ("review_score", I, True),
                   ("review_comment_title", S, True), ("review_comment_message", S, True),
                   ("review_creation_date", S, True), ("review_answer_timestamp", S, True)),
    "geolocation": _st(("geolocation_zip_code_prefix", I, True), ("geolocation_lat", D, True),
                       ("geolocation_lng", D, True), ("geolocation_city", S, True),
                       ("geolocation_state", S, True)),
    "category_translation": _st(("product_category_name", S, True),
                                ("product_category_name_english", S, True)),
}

# Reviews hold free text with quoted line breaks: the records of that file are
# put together before they are parsed.
MULTILINE_TABLES = {"reviews"}

# ------------------------------------------------------------- star schema
# The warehouse column names and types, one table each.
STAR_TYPES = {
    "dim_geolocation": [("zip_code_prefix", I), ("city", S), ("state", S),
                        ("lat", COORD), ("lng", COORD)],
    "dim_customers": [("customer_id", None), ("customer_unique_id", None),
                      ("zip_code_prefix", I), ("city", S), ("state", S)],
    "dim_sellers": [("seller_id", None), ("zip_code_prefix", I), ("city", S), ("state", S)],
    "dim_products": [("product_id", None), ("category_name_pt", S), ("category_name_en", S),
                     ("name_length", I), ("description_length", I), ("photos_qty", I),
                     ("weight_g", MONEY), ("length_cm", SIZE), ("height_cm", SIZE),
                     ("width_cm", SIZE)],
    "fact_orders": [("order_id", None), ("customer_id", None), ("order_status", S),
                    ("is_delivered", SH), ("has_items", SH),
                    ("purchase_timestamp", TS), ("approved_at", TS),
                    ("delivered_carrier_date", TS), ("delivered_customer_date", TS),
                    ("estimated_delivery_date", TS), ("delivery_time_days", I),
                    ("delay_days", I), ("order_year", SH), ("order_month", SH),
                    ("order_yearmonth", S)],
    "fact_order_items": [("order_id", None), ("order_item_id", SH), ("product_id", None),
                         ("seller_id", None), ("shipping_limit_date", TS), ("price", MONEY),
                         ("freight_value", MONEY), ("total_item_value", MONEY)],
    "fact_payments": [("payment_id", L), ("order_id", None), ("payment_sequential", SH),
                      ("payment_type", S), ("payment_installments", SH),
                      ("payment_value", MONEY)],
    "fact_reviews": [("review_id", None), ("order_id", None), ("review_score", SH),
                     ("is_negative", SH), ("has_comment", SH), ("review_comment_title", S),
                     ("review_comment_message", S), ("review_creation_date", TS),
                     ("review_answer_timestamp", TS)],
}
# ``None`` = identifier column: keeps the source key type (string ids in the
# CSV files, integer ids in the driver bindings).

# Cleaned-table column -> warehouse column. Every table maps all columns it
# keeps (customer city / state included), so no kept column can silently
# vanish.
RENAME = {
    "dim_geolocation": {"geolocation_zip_code_prefix": "zip_code_prefix",
                        "geolocation_lat": "lat", "geolocation_lng": "lng",
                        "geolocation_city": "city", "geolocation_state": "state"},
    "dim_customers": {"customer_zip_code_prefix": "zip_code_prefix",
                      "customer_city": "city", "customer_state": "state"},
    "dim_sellers": {"seller_zip_code_prefix": "zip_code_prefix",
                    "seller_city": "city", "seller_state": "state"},
    "dim_products": {"product_category_name": "category_name_pt",
                     "product_category_name_english": "category_name_en",
                     "product_name_lenght": "name_length",
                     "product_description_lenght": "description_length",
                     "product_photos_qty": "photos_qty", "product_weight_g": "weight_g",
                     "product_length_cm": "length_cm", "product_height_cm": "height_cm",
                     "product_width_cm": "width_cm"},
    "fact_orders": {"order_purchase_timestamp": "purchase_timestamp",
                    "order_approved_at": "approved_at",
                    "order_delivered_carrier_date": "delivered_carrier_date",
                    "order_delivered_customer_date": "delivered_customer_date",
                    "order_estimated_delivery_date": "estimated_delivery_date"},
    "fact_order_items": {},
    "fact_payments": {},
    "fact_reviews": {},
}

# Primary keys, NOT NULL columns, defaults and checks of the warehouse.
PRIMARY_KEY = {
    "dim_geolocation": ["zip_code_prefix"], "dim_customers": ["customer_id"],
    "dim_sellers": ["seller_id"], "dim_products": ["product_id"],
    "fact_orders": ["order_id"], "fact_order_items": ["order_id", "order_item_id"],
    "fact_payments": ["payment_id"], "fact_reviews": ["review_id"],
}
NOT_NULL = {
    "dim_geolocation": ["zip_code_prefix", "state"],
    "dim_customers": ["customer_id", "customer_unique_id"],
    "dim_sellers": ["seller_id"],
    "dim_products": ["product_id"],
    "fact_orders": ["order_id", "customer_id", "order_status", "is_delivered", "has_items"],
    "fact_order_items": ["order_id", "order_item_id", "price", "freight_value"],
    "fact_payments": ["payment_id", "order_id", "payment_type", "payment_value"],
    "fact_reviews": ["review_id", "order_id", "review_score", "is_negative", "has_comment"],
}
DEFAULTS = {
    "fact_orders": {"is_delivered": 0, "has_items": 1},
    "fact_order_items": {"freight_value": 0},
    "fact_reviews": {"is_negative": 0, "has_comment": 0},
}
# VARCHAR / CHAR lengths declared by the warehouse.
MAX_LENGTH = {
    "dim_geolocation": {"city": 100, "state": 2},
    "dim_customers": {"customer_id": 50, "customer_unique_id": 50, "city": 100, "state": 2},
    "dim_sellers": {"seller_id": 50, "city": 100, "state": 2},
    "dim_products": {"product_id": 50, "category_name_pt": 100, "category_name_en": 100},
    "fact_orders": {"order_id": 50, "customer_id": 50, "order_status": 20,
                    "order_yearmonth": 7},
    "fact_order_items": {"order_id": 50, "product_id": 50, "seller_id": 50},
    "fact_payments": {"order_id": 50, "payment_type": 30},
    "fact_reviews": {"review_id": 50, "order_id": 50},
}
CHECKS = {"fact_reviews": {"review_score": (1, 5)}}

# Declared foreign keys: (child table, child column, parent table, parent column).
FOREIGN_KEYS = [
    ("dim_customers", "zip_code_prefix", "dim_geolocation", "zip_code_prefix"),
    ("dim_sellers", "zip_code_prefix", "dim_geolocation", "zip_code_prefix"),
    ("fact_orders", "customer_id", "dim_customers", "customer_id"),
    ("fact_order_items", "order_id", "fact_orders", "order_id"),
    ("fact_order_items", "product_id", "dim_products", "product_id"),
    ("fact_order_items", "seller_id", "dim_sellers", "seller_id"),
    ("fact_payments", "order_id", "fact_orders", "order_id"),
    ("fact_reviews", "order_id", "fact_orders", "order_id"),
]

# Load order: dimensions before facts.
LOAD_ORDER = ["dim_geolocation", "dim_customers", "dim_sellers", "dim_products",
              "fact_orders", "fact_order_items", "fact_payments", "fact_reviews"]
