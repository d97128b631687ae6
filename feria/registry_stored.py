"""Queries that write tables and files and read them back: the text path of the
raw files, the clean layer, the published load, keyed appends, exports.

Each writes what it needs, made from the driver tables, to a new folder in the
shared folder, and answers from what is read there.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from feria.plans import analytics as A
from feria.plans import colocated, cube, publish
from feria.plans import dashboard as Dsh
from feria.plans import marts as M
from feria.plans.clean import clean_all
from feria.plans.refresh import load_from_clean_dir
from feria.plans.warehouse import SOURCE, build_table, write_clean
from feria.registry import ORACLE, QUERIES, SAMPLE_FILTER, clean, normalize_output, raw, register, star
from feria.registry_quality import FIRST_SQL, ITEM_ARRIVAL, TARGET_SQL, _incoming_items, _target_items
from feria.schemas import LOAD_ORDER
from feria.session import work_dir
from feria.sources.keyed_table import KeyedTable
from feria.sources.readers import RAW_FILES, read_raw_dir
from feria.sources.sinks import export_csv


def _same_as(name: str, known: str):
    """Register a query whose rows are those of a known one."""
    def deco(fn):
        QUERIES[name] = lambda s, d: normalize_output(fn(s, d))
        ORACLE[name] = ORACLE[known]
        return fn
    return deco


# ------------------------------------------------------------- the text path
def _breaks(df: DataFrame) -> DataFrame:
    """Line breaks and quotes in the comments, as in typed text."""
    return df.withColumn("review_comment_message", F.concat(F.lit('"'), F.replace("review_comment_message", F.lit(" "), F.lit(',"\r\n')))) \
        if "review_comment_message" in df.columns else df


def _no_breaks(df: DataFrame) -> DataFrame:
    message = F.replace(F.substring("review_comment_message", 2, 1 << 30), F.lit(',"\r\n'), F.lit(" "))
    return df.withColumn("review_comment_message", message) if "review_comment_message" in df.columns else df


def text_tables(spark, sf_dir, *tables: str) -> dict[str, DataFrame]:
    """Raw tables written as CSV text, with a byte-order mark in the lookup and
    line breaks in the comments, and read by the raw reader: dates are text."""
    folder = work_dir(spark, "text")
    known = raw(spark, sf_dir)
    for t in tables:
        df = _breaks(known[t]).select(*[F.col(f.name).cast("string").alias(f.name) for f in known[t].schema.fields])
        if t == "category_translation":
            df = df.withColumnRenamed(df.columns[0], "﻿" + df.columns[0])
        export_csv(df, f"{folder}/{RAW_FILES[t]}")
    out = {}
    for t, df in read_raw_dir(spark, folder).items():
        numbers = [f.name for f in known[t].schema.fields if isinstance(f.dataType, T.LongType)]
        out[t] = _no_breaks(df.withColumns({c: F.col(c).cast("bigint") for c in numbers if c in df.columns}))
    return out


_same_as("text_clean_orders", "clean_orders")(lambda s, d: clean_all(text_tables(s, d, "orders", "order_items"))["orders"])
_same_as("text_clean_products", "clean_products")(lambda s, d: clean_all(text_tables(s, d, "products", "category_translation"))["products"])
_same_as("text_clean_reviews", "clean_reviews")(lambda s, d: clean_all(text_tables(s, d, "reviews"))["reviews"])


# ------------------------------------------------- clean layer, load, exports
_same_as("stored_clean_master", "master")(
    lambda s, d: M.master(write_clean(s, clean(s, d), work_dir(s, "clean"))))


def _without_products(s, d):
    """The load from a clean layer that lacks the products."""
    r, out = raw(s, d), work_dir(s, "load")
    cleaned = clean_all(r)
    write_clean(s, {t: cleaned[t] for t in set(SOURCE.values()) - {"products"}}, f"{out}/clean")
    status = load_from_clean_dir(s, r, f"{out}/clean", f"{out}/star")
    return status.select("table", "rows")


_same_as("load_without_products", "star_row_counts")(_without_products)


def _published(s, d):
    out = work_dir(s, "published")
    publish.publish_star(s, clean(s, d), out)
    return out


_same_as("published_star_counts", "star_row_counts")(lambda s, d: reduce(DataFrame.unionByName, [
    df.agg(F.lit(t).alias("table"), F.count(F.lit(1)).alias("rows")) for t, df in publish.read_published(s, _published(s, d)).items()]))


def _verification(s, d):
    """The published rows against a table of the counts that are due."""
    c = clean(s, d)
    due = reduce(DataFrame.unionByName, [c[SOURCE[t]].agg(F.lit(t).alias("table"), F.count(F.lit(1)).alias("rows")) for t in LOAD_ORDER])
    return publish.verify_published(s, _published(s, d), due)


QUERIES["published_verification"] = lambda s, d: normalize_output(_verification(s, d))
ORACLE["published_verification"] = f'SELECT "table", cleaned AS expected, loaded, not_loaded AS missing FROM ({ORACLE["load_verification"]}) x'


def _exported(s, d):
    out = work_dir(s, "export")
    df = M.payments_summary(clean(s, d)["payments"])
    export_csv(df, out)
    return s.read.option("header", True).schema(df.schema).csv(out)


_same_as("exported_payments_summary", "payments_summary")(_exported)


# -------------------------------------------------------------- keyed appends
_COLUMNS = ["order_id", "order_item_id", "product_id", "seller_id", "shipping_limit_date"]
_KEYS = ["order_id", "order_item_id"]


def _keyed(s, d):
    table = KeyedTable(s, work_dir(s, "keyed"), _KEYS, buckets=32)
    table.append(_target_items(s, d).select(*_COLUMNS), ITEM_ARRIVAL[:2])
    return table, table.append(_incoming_items(s, d), ITEM_ARRIVAL)


register("keyed_append_table", f"""
SELECT CAST(order_id AS BIGINT) AS order_id, CAST(order_item_id AS BIGINT) AS order_item_id, CAST(product_id AS BIGINT) AS product_id,
       CAST(seller_id AS BIGINT) AS seller_id, shipping_limit_date
FROM (SELECT order_id, order_item_id, product_id, seller_id, shipping_limit_date FROM {TARGET_SQL} t
      UNION ALL SELECT f.order_id, f.order_item_id, f.product_id, f.seller_id, f.shipping_limit_date FROM {FIRST_SQL} f
      ANTI JOIN {TARGET_SQL} t ON f.order_id = t.order_id AND f.order_item_id = t.order_item_id) x""")(
    lambda s, d: _keyed(s, d)[0].read())


@_same_as("keyed_append_report", "insert_ignore_report")
def _keyed_report(s, d):
    done = _keyed(s, d)[1]
    return s.createDataFrame([(done.appended + done.skipped, done.appended, done.skipped)], "incoming long, appended long, skipped long")


# --------------------------------------------------- columns and NaN (K-09, B-19)
register("default_freight", """
SELECT CAST(order_id AS BIGINT) AS order_id, CAST(order_item_id AS BIGINT) AS order_item_id, CAST(price AS DOUBLE) AS price,
       CAST(0 AS DOUBLE) AS freight_value FROM fact_order_items""")(
    lambda s, d: build_table("fact_order_items", clean(s, d)["order_items"].drop("freight_value")).rows
    .select("order_id", "order_item_id", "price", "freight_value"))


def _nan_products(s, d):
    """Sizes that are missing arrive as NaN."""
    r = raw(s, d)
    p = r["products"]
    sizes = [f.name for f in p.schema.fields if isinstance(f.dataType, T.DoubleType)]
    p = p.withColumns({c: F.when(F.col(c).isNull() | (F.col(c) == 0), F.lit(float("nan"))).otherwise(F.col(c)) for c in sizes})
    return clean_all({"products": p, "category_translation": r["category_translation"]})["products"]


_same_as("nan_clean_products", "clean_products")(_nan_products)


# ------------------------------------------------------- co-located star schema
def _colocated(s, d):
    out = work_dir(s, "colocated")
    return colocated.write_colocated(s, star(s, d), out, buckets=16)


_same_as("colocated_q4", "q4_incident_rates")(lambda s, d: A.q4_incident_rates(_colocated(s, d)))
_same_as("colocated_q5", "q5_seller_quality")(lambda s, d: A.q5_seller_quality(_colocated(s, d)))
_same_as("colocated_kpi_row_filtered", "kpi_row_filtered")(lambda s, d: Dsh.kpi_row(_colocated(s, d), SAMPLE_FILTER))


# ------------------------------------------------------------ dashboard cube
def _cube(s, d):
    out = work_dir(s, "cube")
    return cube.write_cube(s, cube.build_cube(cube.write_rows(s, star(s, d), f"{out}/rows")), out)


for _name, _answer in {"kpi_row": cube.kpi_row, "kpi_row_by_order": cube.kpi_row_by_order, "dash_q1_monthly": cube.monthly,
                       "dash_q2_categories": cube.top_categories, "dash_q4_incidents": cube.incident_split,
                       "score_distribution": cube.score_distribution}.items():
    _same_as(f"cube_{_name}_filtered", f"{_name}_filtered")(lambda s, d, answer=_answer: answer(_cube(s, d), SAMPLE_FILTER))
