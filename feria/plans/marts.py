"""Pre-aggregates and the denormalised order mart."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feria.operators.aggregates import first_max_by, mode_by


def payments_summary(payments_clean: DataFrame) -> DataFrame:
    """One row per order: total paid, max installments, distinct methods and
    the method of the largest payment (first arrival wins a tie)."""
    return (payments_clean.groupBy("order_id")
            .agg(F.sum("payment_value").alias("total_payment"),
                 F.max("payment_installments").alias("payment_installments"),
                 F.count_distinct("payment_type").alias("payment_methods_count"),
                 first_max_by("payment_type", "payment_value", "payment_sequential")
                 .alias("primary_payment_type")))


def items_per_order(items_clean: DataFrame) -> DataFrame:
    """One row per order: item count, revenue, freight and the most frequent
    seller / product (smallest id on ties).

    The two modes are two-stage aggregates (count per (order, id) first) so
    an order with a huge number of items never sits in one task's hash map;
    all three partial results are hash-partitioned by order_id, so joining
    them needs no further shuffle.
    """
    base = (items_clean.groupBy("order_id")
            .agg(F.count("order_item_id").alias("item_count"),
                 F.sum("price").alias("items_revenue"),
                 F.sum("freight_value").alias("freight_total")))
    seller = mode_by(items_clean, ["order_id"], "seller_id")
    product = mode_by(items_clean, ["order_id"], "product_id")
    return (base.join(seller, "order_id", "left").join(product, "order_id", "left")
            .select("order_id", "item_count", "items_revenue", "freight_total", "seller_id",
                    "product_id"))


def master(clean: dict[str, DataFrame]) -> DataFrame:
    """Orders having items, widened with customer, payment summary, review,
    items summary, main product category and main seller.

    Join order keeps one hash partitioning on order_id for the four
    order-grain inputs (the two summaries are already partitioned by it),
    then attaches the dimensions.
    """
    orders = clean["orders"]
    base = orders.where(F.col("has_items") == 1)
    pay = payments_summary(clean["payments"])
    rev = clean["reviews"].select("order_id", "review_score", "is_negative", "has_comment")
    items = items_per_order(clean["order_items"])
    cust = clean["customers"].select("customer_id", "customer_unique_id", "customer_city",
                                     "customer_state")
    prod = clean["products"].select("product_id", "product_category_name_english")
    sell = clean["sellers"].select("seller_id", "seller_city", "seller_state")
    m = (base.join(pay, "order_id", "left")
         .join(rev, "order_id", "left")
         .join(items, "order_id", "left")
         .join(cust, "customer_id", "left")
         .join(prod, "product_id", "left")
         .join(sell, "seller_id", "left"))
    cols = (orders.columns
            + ["customer_unique_id", "customer_city", "customer_state"]
            + [c for c in pay.columns if c != "order_id"]
            + ["review_score", "is_negative", "has_comment"]
            + [c for c in items.columns if c != "order_id"]
            + ["product_category_name_english", "seller_city", "seller_state"])
    return m.select(*cols)
