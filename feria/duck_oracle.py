"""Independent SQL statements of every registered query, for DuckDB.

The driver pre-registers the Parquet tables as views; each statement here
re-derives the raw tables (bindings), the cleaned tables and the star schema
as CTEs and then asks its question. It shares no code path with the Spark
plans: rounding is done in integer arithmetic, modes and arg-max with
``row_number``, de-duplication with windows.

Output typing convention (both engines): integers BIGINT, money and ratios
DOUBLE, text VARCHAR, times TIMESTAMP.
"""

from __future__ import annotations

import re


# ----------------------------------------------------------- SQL helpers
def money(x: str) -> str:
    return f"CAST(CAST(floor(({x}) * 100 + 0.5) AS BIGINT) * 0.01 AS DECIMAL(10,2))"


def norm(x: str) -> str:
    return f"regexp_replace(trim(strip_accents(lower({x}))), '\\s+', ' ', 'g')"


def floor_days(a: str, b: str) -> str:
    return f"CAST(floor((epoch_us({a}) - epoch_us({b})) / 86400000000) AS INTEGER)"


def pct(a: str, b: str, n: int) -> str:
    """round(a * 100 / b, n), half away from zero, for a >= 0; b = 0 -> NULL."""
    k = 10 ** n
    return (f"(CAST(({a}) AS HUGEINT) * {200 * k} + ({b})) // (2 * nullif(CAST(({b}) AS HUGEINT), 0))"
            f" / {k}.0")


def ratio(a: str, b: str, n: int) -> str:
    """round(a / b, n) half away from zero, any sign of a, b > 0."""
    k = 10 ** n
    return (f"CASE WHEN ({a}) < 0 THEN -1 ELSE 1 END * "
            f"((abs(CAST(({a}) AS HUGEINT)) * {2 * k} + ({b})) // (2 * nullif(CAST(({b}) AS HUGEINT), 0)))"
            f" / {k}.0")


def mean(x: str, n: int) -> str:
    return ratio(f"sum({x})", f"count({x})", n)


def money_mean(x: str, n: int) -> str:
    return ratio(f"sum(CAST(({x}) * 100 AS BIGINT))", f"count({x}) * 100", n)


K = "CAST(json_extract_string(props, '$.k') AS INTEGER)"
STATE = "substr(n.n_name, 1, 1) || chr(65 + n.n_nationkey)"

# ------------------------------------------------------------- the CTEs
CTES: list[tuple[str, str]] = [
    # ---- bindings: driver tables as raw marketplace tables
    ("raw_customers", f"""
SELECT c.c_custkey AS customer_id, c.c_custkey // 2 AS customer_unique_id,
       c.c_nationkey AS customer_zip_code_prefix, c.c_mktsegment AS customer_city,
       {STATE} AS customer_state
FROM customer c LEFT JOIN nation n ON c.c_nationkey = n.n_nationkey"""),
    ("raw_sellers", f"""
SELECT s.s_suppkey AS seller_id, s.s_nationkey AS seller_zip_code_prefix,
       r.r_name AS seller_city, {STATE} AS seller_state
FROM supplier s LEFT JOIN nation n ON s.s_nationkey = n.n_nationkey
LEFT JOIN region r ON n.n_regionkey = r.r_regionkey"""),
    ("raw_geolocation", f"""
SELECT c.c_nationkey AS geolocation_zip_code_prefix, c.c_acctbal / 1000 - 3 AS geolocation_lat,
       CAST(-30.0 - (c.c_custkey % 50) AS DOUBLE) AS geolocation_lng,
       c.c_mktsegment AS geolocation_city, {STATE} AS geolocation_state
FROM customer c LEFT JOIN nation n ON c.c_nationkey = n.n_nationkey"""),
    ("raw_products", """
SELECT p_partkey AS product_id,
       CASE WHEN p_partkey % 17 = 0 THEN NULL ELSE p_brand END AS product_category_name,
       length(p_name) AS product_name_lenght, p_size * 10 AS product_description_lenght,
       p_size % 5 AS product_photos_qty,
       CAST((p_size % 10) * 100 AS DOUBLE) AS product_weight_g,
       CAST(p_size % 7 AS DOUBLE) AS product_length_cm,
       CAST(p_size % 11 AS DOUBLE) AS product_height_cm,
       CAST(p_size % 13 AS DOUBLE) AS product_width_cm
FROM part"""),
    ("raw_category_translation", """
SELECT DISTINCT p_brand AS product_category_name,
       'brand_' || split_part(p_brand, '#', 2) AS product_category_name_english
FROM part"""),
    ("raw_orders", """
SELECT o.o_orderkey AS order_id, o.o_custkey AS customer_id,
       CASE o.o_orderstatus WHEN 'F' THEN 'delivered' WHEN 'P' THEN 'canceled'
            ELSE 'shipped' END AS order_status,
       o.o_orderdate AS order_purchase_timestamp,
       CASE WHEN o.o_orderstatus = 'P' AND o.o_orderkey % 4 = 0 THEN NULL
            ELSE o.o_orderdate + to_hours(CAST(o.o_orderkey % 7 - 1 AS INTEGER)) END
            AS order_approved_at,
       CASE WHEN o.o_orderstatus <> 'P' THEN li.first_ship END AS order_delivered_carrier_date,
       CASE WHEN o.o_orderstatus = 'F' THEN li.last_ship END AS order_delivered_customer_date,
       o.o_orderdate + to_days(CAST(40 + 20 * CAST(substr(o.o_orderpriority, 1, 1) AS INTEGER)
                                    AS INTEGER)) AS order_estimated_delivery_date
FROM orders o LEFT JOIN (SELECT l_orderkey, min(l_shipdate) AS first_ship,
                                max(l_shipdate) AS last_ship
                         FROM lineitem GROUP BY l_orderkey) li
  ON o.o_orderkey = li.l_orderkey"""),
    ("raw_order_items", f"""
SELECT l_orderkey AS order_id, l_linenumber AS order_item_id, l_partkey AS product_id,
       l_suppkey AS seller_id, l_shipdate AS shipping_limit_date,
       {money('l_extendedprice')} AS price, {money('l_extendedprice * l_tax')} AS freight_value
FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber
                                   ORDER BY l_partkey, l_suppkey, l_extendedprice,
                                            l_shipdate, l_tax) AS rn
      FROM lineitem) WHERE rn = 1"""),
    ("raw_payments", f"""
SELECT event_id // 2 AS order_id, CAST(event_id % 2 + 1 AS INTEGER) AS payment_sequential,
       CASE WHEN event_id % 5 = 0 THEN upper(event_type) || ' ' ELSE event_type END
            AS payment_type,
       {K} % 12 AS payment_installments,
       {money(f'CASE WHEN {K} % 50 = 0 THEN 0.0 ELSE value END')} AS payment_value
FROM events WHERE event_type NOT IN ('click', 'view')"""),
    ("raw_reviews", """
SELECT event_id AS review_id, event_id // 2 AS order_id, k % 5 + 1 AS review_score,
       CASE WHEN k % 3 = 0 THEN 'titulo ' || CAST(k AS VARCHAR) END AS review_comment_title,
       CASE WHEN k % 4 = 1 THEN '' WHEN k % 4 = 2 THEN ' '
            WHEN k % 4 = 3 THEN 'comentario ' || CAST(k AS VARCHAR) END
            AS review_comment_message,
       ts - to_days(k % 3) AS review_creation_date,
       CASE WHEN k % 23 = 0 THEN NULL ELSE ts END AS review_answer_timestamp
FROM (SELECT *, """ + K + """ AS k FROM events) WHERE event_type IN ('click', 'view')"""),

    # ---- cleaning
    ("geo_f", f"""
SELECT geolocation_zip_code_prefix AS z, geolocation_lat AS lat, geolocation_lng AS lng,
       {norm('geolocation_city')} AS city, geolocation_state AS state
FROM raw_geolocation
WHERE geolocation_lat BETWEEN -33.7 AND 5.3 AND geolocation_lng BETWEEN -73.9 AND -28.8
  AND geolocation_zip_code_prefix IS NOT NULL"""),
    ("geo_city", """
SELECT z, city FROM (SELECT z, city, row_number() OVER (PARTITION BY z ORDER BY n DESC, city) AS rn
                     FROM (SELECT z, city, count(*) AS n FROM geo_f WHERE city IS NOT NULL
                           GROUP BY z, city)) WHERE rn = 1"""),
    ("geo_state", """
SELECT z, state FROM (SELECT z, state, row_number() OVER (PARTITION BY z ORDER BY n DESC, state) AS rn
                      FROM (SELECT z, state, count(*) AS n FROM geo_f WHERE state IS NOT NULL
                            GROUP BY z, state)) WHERE rn = 1"""),
    ("cl_geolocation", """
SELECT g.z AS geolocation_zip_code_prefix, g.lat AS geolocation_lat, g.lng AS geolocation_lng,
       c.city AS geolocation_city, s.state AS geolocation_state
FROM (SELECT z, quantile_cont(lat, 0.5) AS lat, quantile_cont(lng, 0.5) AS lng
      FROM geo_f GROUP BY z) g
LEFT JOIN geo_city c ON g.z = c.z LEFT JOIN geo_state s ON g.z = s.z"""),
    ("cl_customers", f"""
SELECT customer_id, customer_unique_id, customer_zip_code_prefix,
       {norm('customer_city')} AS customer_city, upper(trim(customer_state)) AS customer_state
FROM raw_customers"""),
    ("cl_sellers", f"""
SELECT seller_id, seller_zip_code_prefix, {norm('seller_city')} AS seller_city,
       upper(trim(seller_state)) AS seller_state
FROM raw_sellers"""),
    ("prod_p0", """
SELECT product_id, coalesce(product_category_name, 'unknown') AS product_category_name,
       product_name_lenght, product_description_lenght, product_photos_qty,
       nullif(product_weight_g, 0) AS product_weight_g,
       nullif(product_length_cm, 0) AS product_length_cm,
       nullif(product_height_cm, 0) AS product_height_cm,
       nullif(product_width_cm, 0) AS product_width_cm
FROM raw_products"""),
    ("prod_lk", """
SELECT product_category_name, max(product_category_name_english) AS en
FROM raw_category_translation WHERE product_category_name IS NOT NULL
GROUP BY product_category_name"""),
    ("prod_cm", """
SELECT product_category_name,
       quantile_cont(product_weight_g, 0.5) AS w, quantile_cont(product_length_cm, 0.5) AS l,
       quantile_cont(product_height_cm, 0.5) AS h, quantile_cont(product_width_cm, 0.5) AS wd
FROM prod_p0 GROUP BY product_category_name"""),
    ("prod_gm", """
SELECT quantile_cont(product_weight_g, 0.5) AS w, quantile_cont(product_length_cm, 0.5) AS l,
       quantile_cont(product_height_cm, 0.5) AS h, quantile_cont(product_width_cm, 0.5) AS wd
FROM prod_p0"""),
    ("cl_products", """
SELECT p.product_id, p.product_category_name, p.product_name_lenght,
       p.product_description_lenght, p.product_photos_qty,
       coalesce(p.product_weight_g, cm.w, gm.w) AS product_weight_g,
       coalesce(p.product_length_cm, cm.l, gm.l) AS product_length_cm,
       coalesce(p.product_height_cm, cm.h, gm.h) AS product_height_cm,
       coalesce(p.product_width_cm, cm.wd, gm.wd) AS product_width_cm,
       coalesce(lk.en, p.product_category_name) AS product_category_name_english
FROM prod_p0 p LEFT JOIN prod_lk lk ON p.product_category_name = lk.product_category_name
LEFT JOIN prod_cm cm ON p.product_category_name = cm.product_category_name
CROSS JOIN prod_gm gm"""),
    ("cl_orders", f"""
SELECT o.order_id, o.customer_id, o.order_status, o.order_purchase_timestamp,
       o.order_approved_at, o.order_delivered_carrier_date, o.order_delivered_customer_date,
       o.order_estimated_delivery_date,
       CAST(coalesce(o.order_status = 'delivered', false) AS INTEGER) AS is_delivered,
       CASE WHEN {floor_days('o.order_delivered_customer_date', 'o.order_purchase_timestamp')} >= 0
            THEN {floor_days('o.order_delivered_customer_date', 'o.order_purchase_timestamp')}
       END AS delivery_time_days,
       {floor_days('o.order_delivered_customer_date', 'o.order_estimated_delivery_date')}
            AS delay_days,
       year(o.order_purchase_timestamp) AS order_year,
       month(o.order_purchase_timestamp) AS order_month,
       strftime(o.order_purchase_timestamp, '%Y-%m') AS order_yearmonth,
       CAST(EXISTS (SELECT 1 FROM raw_order_items i WHERE i.order_id = o.order_id) AS INTEGER)
            AS has_items
FROM raw_orders o"""),
    ("cl_order_items", """
SELECT order_id, order_item_id, product_id, seller_id, shipping_limit_date, price,
       freight_value, price + freight_value AS total_item_value
FROM raw_order_items"""),
    ("cl_payments", """
SELECT order_id, payment_sequential, trim(lower(payment_type)) AS payment_type,
       payment_installments, payment_value
FROM raw_payments WHERE payment_value > 0"""),
    ("cl_reviews", """
SELECT review_id, order_id, review_score,
       coalesce(review_comment_title, '') AS review_comment_title,
       coalesce(review_comment_message, '') AS review_comment_message,
       review_creation_date, review_answer_timestamp,
       CAST(coalesce(review_score <= 2, false) AS INTEGER) AS is_negative,
       CAST(length(coalesce(review_comment_message, '')) > 0 AS INTEGER) AS has_comment
FROM (SELECT *, row_number() OVER (PARTITION BY order_id
                                   ORDER BY review_answer_timestamp DESC NULLS LAST,
                                            review_id) AS rn
      FROM raw_reviews) WHERE rn = 1"""),
    ("pay_pick", """
SELECT order_id, payment_type FROM (
  SELECT order_id, payment_type,
         row_number() OVER (PARTITION BY order_id
                            ORDER BY payment_value DESC, payment_sequential, payment_type) AS rn
  FROM cl_payments) WHERE rn = 1"""),
    ("payments_summary", """
SELECT p.order_id, sum(p.payment_value) AS total_payment,
       max(p.payment_installments) AS payment_installments,
       count(DISTINCT p.payment_type) AS payment_methods_count,
       any_value(k.payment_type) AS primary_payment_type
FROM cl_payments p JOIN pay_pick k ON p.order_id = k.order_id GROUP BY p.order_id"""),
    ("item_mode_seller", """
SELECT order_id, seller_id FROM (
  SELECT order_id, seller_id, row_number() OVER (PARTITION BY order_id ORDER BY n DESC, seller_id) rn
  FROM (SELECT order_id, seller_id, count(*) AS n FROM cl_order_items
        WHERE seller_id IS NOT NULL GROUP BY order_id, seller_id)) WHERE rn = 1"""),
    ("item_mode_product", """
SELECT order_id, product_id FROM (
  SELECT order_id, product_id, row_number() OVER (PARTITION BY order_id ORDER BY n DESC, product_id) rn
  FROM (SELECT order_id, product_id, count(*) AS n FROM cl_order_items
        WHERE product_id IS NOT NULL GROUP BY order_id, product_id)) WHERE rn = 1"""),
    ("items_per_order", """
SELECT a.order_id, a.item_count, a.items_revenue, a.freight_total, s.seller_id, p.product_id
FROM (SELECT order_id, count(order_item_id) AS item_count, sum(price) AS items_revenue,
             sum(freight_value) AS freight_total
      FROM cl_order_items GROUP BY order_id) a
LEFT JOIN item_mode_seller s ON a.order_id = s.order_id
LEFT JOIN item_mode_product p ON a.order_id = p.order_id"""),

    # ---- star schema (keys are unique by construction in the bindings, so
    # the insert-ignore step reduces to the constraint filter here)
    ("dim_geolocation", """
SELECT geolocation_zip_code_prefix AS zip_code_prefix, geolocation_city AS city,
       geolocation_state AS state, CAST(geolocation_lat AS DECIMAL(9,6)) AS lat,
       CAST(geolocation_lng AS DECIMAL(9,6)) AS lng
FROM cl_geolocation
WHERE geolocation_zip_code_prefix IS NOT NULL AND geolocation_state IS NOT NULL
  AND coalesce(length(geolocation_city), 0) <= 100 AND length(geolocation_state) <= 2"""),
    ("dim_customers", """
SELECT customer_id, customer_unique_id, customer_zip_code_prefix AS zip_code_prefix,
       customer_city AS city, customer_state AS state
FROM cl_customers
WHERE customer_id IS NOT NULL AND customer_unique_id IS NOT NULL
  AND coalesce(length(customer_city), 0) <= 100 AND coalesce(length(customer_state), 0) <= 2
  AND length(CAST(customer_id AS VARCHAR)) <= 50
  AND length(CAST(customer_unique_id AS VARCHAR)) <= 50"""),
    ("dim_sellers", """
SELECT seller_id, seller_zip_code_prefix AS zip_code_prefix, seller_city AS city,
       seller_state AS state
FROM cl_sellers
WHERE seller_id IS NOT NULL AND coalesce(length(seller_city), 0) <= 100
  AND coalesce(length(seller_state), 0) <= 2"""),
    ("dim_products", """
SELECT product_id, product_category_name AS category_name_pt,
       product_category_name_english AS category_name_en,
       product_name_lenght AS name_length, product_description_lenght AS description_length,
       product_photos_qty AS photos_qty, CAST(product_weight_g AS DECIMAL(10,2)) AS weight_g,
       CAST(product_length_cm AS DECIMAL(8,2)) AS length_cm,
       CAST(product_height_cm AS DECIMAL(8,2)) AS height_cm,
       CAST(product_width_cm AS DECIMAL(8,2)) AS width_cm
FROM cl_products
WHERE product_id IS NOT NULL AND coalesce(length(product_category_name), 0) <= 100
  AND coalesce(length(product_category_name_english), 0) <= 100"""),
    ("fact_orders", """
SELECT order_id, customer_id, order_status, is_delivered, has_items,
       order_purchase_timestamp AS purchase_timestamp, order_approved_at AS approved_at,
       order_delivered_carrier_date AS delivered_carrier_date,
       order_delivered_customer_date AS delivered_customer_date,
       order_estimated_delivery_date AS estimated_delivery_date,
       delivery_time_days, delay_days, order_year, order_month, order_yearmonth
FROM cl_orders
WHERE order_id IS NOT NULL AND customer_id IS NOT NULL AND order_status IS NOT NULL
  AND length(order_status) <= 20"""),
    ("fact_order_items", """
SELECT order_id, order_item_id, product_id, seller_id, shipping_limit_date, price,
       freight_value, CAST(total_item_value AS DECIMAL(10,2)) AS total_item_value
FROM cl_order_items
WHERE order_id IS NOT NULL AND order_item_id IS NOT NULL AND price IS NOT NULL
  AND freight_value IS NOT NULL"""),
    ("fact_payments", """
SELECT CAST('0x' || substr(md5(concat_ws('|', order_id, payment_sequential, n)), 1, 15) AS BIGINT) AS payment_id,
       order_id, payment_sequential, payment_type, payment_installments, payment_value
FROM (SELECT *, row_number() OVER (PARTITION BY order_id, payment_sequential
        ORDER BY payment_type NULLS FIRST, payment_installments NULLS FIRST, payment_value NULLS FIRST) AS n
      FROM cl_payments) p
WHERE order_id IS NOT NULL AND payment_type IS NOT NULL AND payment_value IS NOT NULL
  AND length(payment_type) <= 30"""),
    ("fact_reviews", """
SELECT review_id, order_id, review_score, is_negative, has_comment, review_comment_title,
       review_comment_message, review_creation_date, review_answer_timestamp
FROM cl_reviews
WHERE review_id IS NOT NULL AND order_id IS NOT NULL AND review_score BETWEEN 1 AND 5"""),
]

_CTE_NAMES = [n for n, _ in CTES]
_CTE_SQL = dict(CTES)


def with_ctes(final_sql: str, extra: list[tuple[str, str]] | None = None) -> str:
    """Prefix ``final_sql`` with exactly the CTEs it needs (transitively)."""
    defs = list(CTES) + list(extra or [])
    sql_of = dict(defs)
    order = [n for n, _ in defs]
    need: set[str] = set()
    stack = [final_sql]
    while stack:
        text = stack.pop()
        for n in order:
            if n not in need and re.search(rf"\b{n}\b", text):
                need.add(n)
                stack.append(sql_of[n])
    parts = [f"{n} AS ({sql_of[n]}\n)" for n in order if n in need]
    if not parts:
        return final_sql.strip()
    return "WITH " + ",\n".join(parts) + "\n" + final_sql.strip()
