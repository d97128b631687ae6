"""Registered profiling, data-quality and exploration queries."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feria import duck_oracle as O
from feria.operators import profile as P
from feria.operators import quality as Q
from feria.plans import explore as X
from feria.plans import marts as M
from feria.plans.warehouse import SOURCE, build_table, write_clean
from feria.plans import dashboard as Dsh
from feria.registry import (CLEAN_COLS, MASTER_COLS, STAR_COLS, _cast_sql, _q2_sql, clean, raw,
                            register, star)
from feria.schemas import FOREIGN_KEYS, LOAD_ORDER, PRIMARY_KEY
from feria.session import work_dir

# Spark type names of the raw binding columns (for the profile's dtype).
RAW_ORDERS_TYPES = [("order_id", "bigint"), ("customer_id", "bigint"),
                    ("order_status", "string"), ("order_purchase_timestamp", "timestamp_ntz"),
                    ("order_approved_at", "timestamp_ntz"),
                    ("order_delivered_carrier_date", "timestamp_ntz"),
                    ("order_delivered_customer_date", "timestamp_ntz"),
                    ("order_estimated_delivery_date", "timestamp_ntz")]


# ---------------------------------------------------------------- profiles
def _profile_sql(table: str, cte: str, cols: list[tuple[str, str]], order: bool = True) -> str:
    parts = []
    for i, (c, t) in enumerate(cols):
        nulls = f"count(*) FILTER (WHERE {c} IS NULL)"
        uniq = f"count(DISTINCT CAST({c} AS VARCHAR))"
        sample = (f"CAST(CAST({c} AS DECIMAL(38,9)) AS VARCHAR)" if t == "double"
                  else f"CAST({c} AS VARCHAR)")
        parts.append(f"""
SELECT '{table}' AS "table", CAST({i} AS BIGINT) AS pos, '{c}' AS "column", '{t}' AS dtype,
       CAST({nulls} AS BIGINT) AS nulls, {O.pct(nulls, 'count(*)', 2)} AS null_pct,
       CAST({uniq} AS BIGINT) AS "unique", {O.pct(uniq, 'count(*)', 2)} AS unique_pct,
       min({sample}) AS sample_value
FROM {cte}""")
    return " UNION ALL ".join(parts) + (" ORDER BY pos" if order else "")


register("profile_columns_orders", _profile_sql("orders", "raw_orders", RAW_ORDERS_TYPES))(
    lambda s, d: P.profile_columns(raw(s, d)["orders"], "orders"))

# Spark type names of every raw binding column, for the all-table profile.
_I, _L, _S, _D, _T, _M = "int", "bigint", "string", "double", "timestamp_ntz", "decimal(10,2)"
RAW_TYPES = {
    "customers": [("customer_id", _L), ("customer_unique_id", _L),
                  ("customer_zip_code_prefix", _I), ("customer_city", _S),
                  ("customer_state", _S)],
    "sellers": [("seller_id", _L), ("seller_zip_code_prefix", _I), ("seller_city", _S),
                ("seller_state", _S)],
    "geolocation": [("geolocation_zip_code_prefix", _I), ("geolocation_lat", _D),
                    ("geolocation_lng", _D), ("geolocation_city", _S),
                    ("geolocation_state", _S)],
    "products": [("product_id", _L), ("product_category_name", _S),
                 ("product_name_lenght", _I), ("product_description_lenght", _I),
                 ("product_photos_qty", _I), ("product_weight_g", _D),
                 ("product_length_cm", _D), ("product_height_cm", _D),
                 ("product_width_cm", _D)],
    "category_translation": [("product_category_name", _S),
                             ("product_category_name_english", _S)],
    "orders": RAW_ORDERS_TYPES,
    "order_items": [("order_id", _L), ("order_item_id", _I), ("product_id", _L),
                    ("seller_id", _L), ("shipping_limit_date", _T), ("price", _M),
                    ("freight_value", _M)],
    "payments": [("order_id", _L), ("payment_sequential", _I), ("payment_type", _S),
                 ("payment_installments", _I), ("payment_value", _M)],
    "reviews": [("review_id", _L), ("order_id", _L), ("review_score", _I),
                ("review_comment_title", _S), ("review_comment_message", _S),
                ("review_creation_date", _T), ("review_answer_timestamp", _T)],
}


def _profile_all(s, d):
    r = raw(s, d)
    return reduce(DataFrame.unionByName, [P.profile_columns(r[t], t) for t in RAW_TYPES])


register("profile_columns_raw", " UNION ALL ".join(
    f"SELECT * FROM ({_profile_sql(t, f'raw_{t}', cols, order=False)}) p_{t}"
    for t, cols in RAW_TYPES.items()))(_profile_all)


def _null_counts_sql(table: str, cte: str, cols: list[str]) -> str:
    parts = []
    for i, c in enumerate(cols):
        nulls = f"count(*) FILTER (WHERE {c} IS NULL)"
        parts.append(f"""
SELECT '{table}' AS "table", CAST({i} AS BIGINT) AS pos, '{c}' AS "column",
       CAST({nulls} AS BIGINT) AS nulls, {O.pct(nulls, 'count(*)', 2)} AS null_pct
FROM {cte}""")
    return " UNION ALL ".join(parts)


register("null_counts_order_dates", _null_counts_sql(
    "orders", "raw_orders", [c for c, _ in RAW_ORDERS_TYPES[3:]]))(
    lambda s, d: X.date_parse_nulls(raw(s, d)))
register("null_counts_reviews", _null_counts_sql(
    "reviews", "raw_reviews", ["review_id", "order_id", "review_score", "review_comment_title",
                               "review_comment_message", "review_creation_date",
                               "review_answer_timestamp"]))(
    lambda s, d: P.null_counts(raw(s, d)["reviews"], "reviews"))


# cleaned-table summary: rows, columns, total NULLs
SUMMARY_TABLES = {**{t: f"cl_{t}" for t in CLEAN_COLS}, "payments_summary": "payments_summary",
                  "master": "master_x"}
SUMMARY_COLS = {**CLEAN_COLS,
                "payments_summary": "order_id total_payment payment_installments "
                                    "payment_methods_count primary_payment_type",
                "master": MASTER_COLS}
MASTER_SQL = """
SELECT o.*, c.customer_unique_id, c.customer_city, c.customer_state,
       ps.total_payment, ps.payment_installments, ps.payment_methods_count,
       ps.primary_payment_type, r.review_score, r.is_negative, r.has_comment,
       i.item_count, i.items_revenue, i.freight_total, i.seller_id, i.product_id,
       p.product_category_name_english, s.seller_city, s.seller_state
FROM cl_orders o
LEFT JOIN payments_summary ps ON o.order_id = ps.order_id
LEFT JOIN cl_reviews r ON o.order_id = r.order_id
LEFT JOIN items_per_order i ON o.order_id = i.order_id
LEFT JOIN cl_customers c ON o.customer_id = c.customer_id
LEFT JOIN cl_products p ON i.product_id = p.product_id
LEFT JOIN cl_sellers s ON i.seller_id = s.seller_id
WHERE o.has_items = 1"""
O.CTES.append(("master_x", MASTER_SQL))


def _summary_sql() -> str:
    parts = []
    for name, cte in SUMMARY_TABLES.items():
        cols = [x.split(":")[0] for x in SUMMARY_COLS[name].split()]
        nulls = " + ".join(f"count(*) FILTER (WHERE {c} IS NULL)" for c in cols)
        parts.append(f"""
SELECT '{name}' AS "table", CAST(count(*) AS BIGINT) AS "rows",
       CAST({len(cols)} AS BIGINT) AS "columns", CAST({nulls} AS BIGINT) AS total_nulls
FROM {cte}""")
    return " UNION ALL ".join(parts)


def _summary(s, d):
    # Stored once: the master reads six of the tables that are counted.
    c = write_clean(s, clean(s, d), work_dir(s, "summary"))
    tables = dict(c)
    tables["payments_summary"] = M.payments_summary(c["payments"])
    tables["master"] = M.master(c)
    return P.table_summary(tables)


register("table_summary_clean", _summary_sql())(_summary)


# ---------------------------------------------------------- value counts
def _vc_sql(cte: str, col: str, top: int | None = None, by_value: bool = False) -> str:
    order = col if by_value else f'"count" DESC, {col}'
    lim = f" LIMIT {top}" if top else ""
    return (f'SELECT {col}, CAST(count(*) AS BIGINT) AS "count" FROM {cte} '
            f"WHERE {col} IS NOT NULL GROUP BY {col} ORDER BY {order}{lim}")


VALUE_COUNTS = [
    ("customers_by_state_top10", "customers", "customer_state", 10, False),
    ("customers_by_city_top10", "customers", "customer_city", 10, False),
    ("sellers_by_state_top10", "sellers", "seller_state", 10, False),
    ("sellers_by_city_top10", "sellers", "seller_city", 10, False),
    ("order_status_counts", "orders", "order_status", None, False),
    ("categories_top15", "products", "product_category_name", 15, False),
    ("payment_type_counts", "payments", "payment_type", None, False),
    ("installments_counts", "payments", "payment_installments", None, True),
    ("review_score_counts", "reviews", "review_score", None, True),
]
for _name, _t, _c, _top, _bv in VALUE_COUNTS:
    register(_name, _vc_sql(f"raw_{_t}", f"{_c}", _top, _bv).replace(
        f"SELECT {_c},", f"SELECT {_c}," if _c not in ("payment_installments", "review_score")
        else f"SELECT CAST({_c} AS BIGINT) AS {_c},"))(
        lambda s, d, t=_t, c=_c, top=_top, bv=_bv: P.value_counts(raw(s, d)[t], c, top, bv))

register("monthly_orders", f"""
SELECT strftime(order_purchase_timestamp, '%Y-%m') AS month, CAST(count(*) AS BIGINT) AS "count"
FROM raw_orders WHERE order_purchase_timestamp IS NOT NULL GROUP BY 1 ORDER BY 1""")(
    lambda s, d: X.monthly_orders(raw(s, d)))


# --------------------------------------------------------- numeric summaries
def _describe_sql(cte: str, col: str) -> str:
    def q(p):
        return f"floor(quantile_cont(CAST({col} * 100 AS DOUBLE), {p}) + 0.5) / 100"
    return f"""
SELECT CAST(count({col}) AS BIGINT) AS "count",
       {O.ratio(f"sum(CAST(round({col} * 100) AS BIGINT))", f"count({col}) * 100", 2)} AS mean,
       round(stddev_samp(CAST({col} AS DOUBLE)), 2) AS std,
       CAST(min({col}) AS DOUBLE) AS "min", {q(0.25)} AS p25, {q(0.5)} AS p50,
       {q(0.75)} AS p75, CAST(max({col}) AS DOUBLE) AS "max"
FROM {cte} WHERE {col} IS NOT NULL"""


for _name, _t, _c in [("describe_price", "order_items", "price"),
                      ("describe_freight", "order_items", "freight_value"),
                      ("describe_payment_value", "payments", "payment_value")]:
    register(_name, _describe_sql(f"raw_{_t}", _c))(
        lambda s, d, t=_t, c=_c: P.describe(raw(s, d)[t], c))


def _p99_cte(cte: str, col: str) -> str:
    return (f"(SELECT * FROM {cte} WHERE CAST({col} AS DOUBLE) <= "
            f"(SELECT quantile_cont(CAST({col} AS DOUBLE), 0.99) FROM {cte}))")


register("p99_filter_price", f"""
SELECT CAST(order_id AS BIGINT) AS order_id, CAST(order_item_id AS BIGINT) AS order_item_id,
       CAST(price AS DOUBLE) AS price FROM {_p99_cte('raw_order_items', 'price')} t""")(
    lambda s, d: P.quantile_filter(raw(s, d)["order_items"], "price", 0.99)
    .select("order_id", "order_item_id", "price"))


def _hist_sql(src: str, col: str, bins: int) -> str:
    v = f"(SELECT CAST({col} AS DOUBLE) AS x FROM {src} t WHERE {col} IS NOT NULL)"
    r = (f"(SELECT CASE WHEN lo0 = hi0 THEN lo0 - 0.5 ELSE lo0 END AS lo, "
         f"CASE WHEN lo0 = hi0 THEN hi0 + 0.5 ELSE hi0 END AS hi "
         f"FROM (SELECT min(x) AS lo0, max(x) AS hi0 FROM {v} v0) r0)")
    c = (f"(SELECT least(CAST(floor((x - lo) * {bins} / (hi - lo)) AS BIGINT), {bins - 1}) "
         f"AS bin, count(*) AS n FROM {v} v1, {r} r1 GROUP BY 1)")
    return f"""
SELECT b.bin, lo + b.bin * ((hi - lo) / {bins}) AS bin_lo,
       lo + (b.bin + 1) * ((hi - lo) / {bins}) AS bin_hi,
       CAST(coalesce(c.n, 0) AS BIGINT) AS "count"
FROM (SELECT range AS bin FROM range({bins})) b CROSS JOIN {r} r2 LEFT JOIN {c} c ON b.bin = c.bin
ORDER BY b.bin"""


HISTOGRAMS = [
    ("histogram_price_p99", "order_items", "price", 60),
    ("histogram_freight_p99", "order_items", "freight_value", 60),
    ("histogram_weight_p99", "products", "product_weight_g", 40),
    ("histogram_length_p99", "products", "product_length_cm", 40),
    ("histogram_height_p99", "products", "product_height_cm", 40),
    ("histogram_width_p99", "products", "product_width_cm", 40),
]
for _name, _t, _c, _b in HISTOGRAMS:
    register(_name, _hist_sql(_p99_cte(f"raw_{_t}", _c), _c, _b))(
        lambda s, d, t=_t, c=_c, b=_b: P.histogram(
            P.quantile_filter(raw(s, d)[t], c, 0.99), c, b))

register("histogram_comment_length", _hist_sql(
    "(SELECT length(coalesce(review_comment_message, '')) AS len FROM raw_reviews)", "len", 50))(
    lambda s, d: X.comment_length_histogram(raw(s, d)))


# ------------------------------------------------------------- findings
register("items_per_order_stats", f"""
SELECT {O.ratio('sum(n)', 'count(*)', 2)} AS mean_items, CAST(max(n) AS BIGINT) AS max_items
FROM (SELECT order_id, count(order_item_id) AS n FROM raw_order_items GROUP BY order_id) t""")(
    lambda s, d: X.items_per_order_stats(raw(s, d)))
register("multi_payment_stats", """
SELECT CAST(count(*) FILTER (WHERE n > 1) AS BIGINT) AS orders_multi_payment,
       CAST(max(n) AS BIGINT) AS max_payments
FROM (SELECT order_id, count(*) AS n FROM raw_payments GROUP BY order_id) t""")(
    lambda s, d: X.multi_payment_stats(raw(s, d)))
register("zero_payments", """
SELECT CAST(count(*) FILTER (WHERE payment_value = 0) AS BIGINT) AS zero_payments
FROM raw_payments""")(lambda s, d: X.zero_payments(raw(s, d)))
register("price_checks", """
SELECT CAST(count(*) FILTER (WHERE price = 0) AS BIGINT) AS price_zero,
       CAST(count(*) FILTER (WHERE price < 0) AS BIGINT) AS price_negative,
       CAST(count(*) FILTER (WHERE freight_value = 0) AS BIGINT) AS freight_zero,
       CAST(count(*) FILTER (WHERE freight_value < 0) AS BIGINT) AS freight_negative
FROM raw_order_items""")(lambda s, d: X.price_checks(raw(s, d)))
register("product_checks", f"""
SELECT CAST(count(*) FILTER (WHERE product_category_name IS NULL) AS BIGINT) AS no_category,
       {O.ratio('count(*) FILTER (WHERE product_category_name IS NULL) * 100', 'count(*)', 2)}
            AS no_category_pct,
       CAST(count(*) FILTER (WHERE product_weight_g = 0) AS BIGINT) AS zero_product_weight_g,
       CAST(count(*) FILTER (WHERE product_length_cm = 0) AS BIGINT) AS zero_product_length_cm,
       CAST(count(*) FILTER (WHERE product_height_cm = 0) AS BIGINT) AS zero_product_height_cm,
       CAST(count(*) FILTER (WHERE product_width_cm = 0) AS BIGINT) AS zero_product_width_cm
FROM raw_products""")(lambda s, d: X.product_checks(raw(s, d)))
register("review_checks", f"""
SELECT (SELECT CAST(count(*) - count(DISTINCT order_id)
                    - CASE WHEN count(*) FILTER (WHERE order_id IS NULL) > 0 THEN 1 ELSE 0 END
                    AS BIGINT) FROM raw_reviews) AS repeated_orders,
       CAST(count(*) FILTER (WHERE review_score <= 2) AS BIGINT) AS negative_reviews,
       {O.ratio('count(*) FILTER (WHERE review_score <= 2) * 100', 'count(*)', 2)} AS negative_pct
FROM raw_reviews""")(lambda s, d: X.review_checks(raw(s, d)))
register("geolocation_checks", f"""
SELECT CAST(count(DISTINCT geolocation_zip_code_prefix) AS BIGINT) AS zips,
       CAST(count(*) - (SELECT count(*) FROM (SELECT DISTINCT geolocation_zip_code_prefix
                                              FROM raw_geolocation) z) AS BIGINT)
            AS rows_repeating_zip,
       {O.ratio('(count(*) - (SELECT count(*) FROM (SELECT DISTINCT geolocation_zip_code_prefix FROM raw_geolocation) z)) * 100', 'count(*)', 2)}
            AS repeat_pct,
       CAST(count(*) FILTER (WHERE geolocation_lat < -33.7 OR geolocation_lat > 5.3) AS BIGINT)
            AS lat_outside,
       CAST(count(*) FILTER (WHERE geolocation_lng < -73.9 OR geolocation_lng > -28.8) AS BIGINT)
            AS lng_outside
FROM raw_geolocation""")(lambda s, d: X.geolocation_checks(raw(s, d)))
register("customer_checks", """
SELECT CAST(count(*) - (SELECT count(*) FROM (SELECT DISTINCT customer_id FROM raw_customers) z)
            AS BIGINT) AS duplicate_ids,
       CAST(count(DISTINCT customer_id) AS BIGINT) AS customer_ids,
       CAST(count(DISTINCT customer_unique_id) AS BIGINT) AS buyers
FROM raw_customers""")(lambda s, d: X.customer_checks(raw(s, d)))
register("temporal_anomalies", """
SELECT CAST(count(*) FILTER (WHERE order_approved_at < order_purchase_timestamp) AS BIGINT)
            AS approved_before_purchase,
       CAST(count(*) FILTER (WHERE order_delivered_customer_date < order_delivered_carrier_date)
            AS BIGINT) AS delivered_before_carrier
FROM raw_orders""")(lambda s, d: X.temporal_anomalies(raw(s, d)))
register("purchase_range", """
SELECT min(order_purchase_timestamp) AS first_purchase,
       max(order_purchase_timestamp) AS last_purchase FROM raw_orders""")(
    lambda s, d: X.purchase_range(raw(s, d)))
register("delivery_stats", f"""
SELECT CAST(count(*) FILTER (WHERE {O.floor_days('order_delivered_customer_date', 'order_purchase_timestamp')} < 0)
            AS BIGINT) AS negative_delivery_times,
       {O.mean('delivery_time_days', 1)} AS mean_days,
       round(quantile_cont(delivery_time_days, 0.5), 1) AS median_days,
       CAST(count(*) FILTER (WHERE delay_days > 0) AS BIGINT) AS late_orders
FROM cl_orders""")(lambda s, d: X.delivery_stats(clean(s, d)["orders"]))

register("hash_sample_coordinates", """
SELECT CAST(geolocation_zip_code_prefix AS BIGINT) AS geolocation_zip_code_prefix,
       geolocation_lat, geolocation_lng
FROM raw_geolocation
ORDER BY md5(concat_ws('|', CAST(geolocation_zip_code_prefix AS VARCHAR),
                       CAST(CAST(geolocation_lat AS DECIMAL(38,9)) AS VARCHAR),
                       CAST(CAST(geolocation_lng AS DECIMAL(38,9)) AS VARCHAR), '42'))
LIMIT 10000""")(lambda s, d: X.coordinate_sample(raw(s, d)))


# -------------------------------------------------------- integrity (raw)
FK_EDGES_RAW = [("orders", "customer_id", "customers", "customer_id"),
                ("order_items", "order_id", "orders", "order_id"),
                ("order_items", "product_id", "products", "product_id"),
                ("order_items", "seller_id", "sellers", "seller_id"),
                ("payments", "order_id", "orders", "order_id"),
                ("reviews", "order_id", "orders", "order_id")]


def _fk_sql(edges, prefix: str, child_name=lambda t: t, declared: bool = False) -> str:
    parts = []
    for ct, fk, pt, pk in edges:
        orphans = ("count(*) FILTER (WHERE p._k IS NULL"
                   + (f" AND c.{fk} IS NOT NULL)" if declared else ")"))
        parts.append(f"""
SELECT '{child_name(ct)}.{fk}' AS child, '{child_name(pt)}.{pk}' AS parent,
       CAST({orphans} AS BIGINT) AS orphans, CAST(count(*) AS BIGINT) AS "rows",
       {O.pct(orphans, 'count(*)', 2)} AS orphan_pct
FROM {prefix}{ct} c LEFT JOIN (SELECT DISTINCT {pk} AS _k FROM {prefix}{pt}) p ON c.{fk} = p._k""")
    return " UNION ALL ".join(parts)


register("fk_orphans_raw", _fk_sql(FK_EDGES_RAW, "raw_"))(
    lambda s, d: X.integrity_report(raw(s, d)))
register("keys_without_items", """
SELECT CAST(order_id AS BIGINT) AS order_id FROM raw_orders
EXCEPT SELECT CAST(order_id AS BIGINT) FROM raw_order_items""")(
    lambda s, d: X.keys_without_items(raw(s, d)))
register("keys_without_payment", """
SELECT CAST(order_id AS BIGINT) AS order_id FROM raw_orders
EXCEPT SELECT CAST(order_id AS BIGINT) FROM raw_payments""")(
    lambda s, d: X.keys_without_payment(raw(s, d)))
register("dup_keys_reviews_by_order", """
SELECT CAST(order_id AS BIGINT) AS order_id, CAST(count(*) AS BIGINT) AS n FROM raw_reviews
GROUP BY order_id HAVING count(*) > 1""")(
    lambda s, d: Q.duplicate_keys(raw(s, d)["reviews"], ["order_id"]))


# ------------------------------------------------- cleaning audit and keys
RAW_FOR_CLEAN = {"geolocation": "geolocation", "customers": "customers", "sellers": "sellers",
                 "products": "products", "orders": "orders", "order_items": "order_items",
                 "payments": "payments", "reviews": "reviews"}


def _accounting(s, d):
    r, c = raw(s, d), clean(s, d)
    return reduce(DataFrame.unionByName,
                  [Q.row_accounting(t, r[t], c[t]) for t in RAW_FOR_CLEAN])


register("row_accounting", " UNION ALL ".join(f"""
SELECT '{t}' AS "table", CAST(b AS BIGINT) AS before, CAST(a AS BIGINT) AS after,
       CAST(b - a AS BIGINT) AS removed, {O.pct('b - a', 'b', 2)} AS removed_pct
FROM (SELECT (SELECT count(*) FROM raw_{t}) AS b, (SELECT count(*) FROM cl_{t}) AS a) x"""
                                             for t in RAW_FOR_CLEAN))(_accounting)

CLEAN_KEYS = {"customers": "customer_id", "sellers": "seller_id", "products": "product_id",
              "orders": "order_id", "reviews": "order_id",
              "geolocation": "geolocation_zip_code_prefix"}


def _key_checks(s, d):
    c = clean(s, d)
    parts = []
    for t, k in CLEAN_KEYS.items():
        nulls = c[t].agg(F.count_if(F.col(k).isNull()).alias("null_keys"))
        dups = Q.duplicate_count(c[t].select(k), [k]).select(
            F.col("duplicates").alias("duplicate_keys"))
        parts.append(nulls.crossJoin(dups).select(F.lit(t).alias("table"), F.lit(k).alias("key"),
                                                  "null_keys", "duplicate_keys",
                                                  F.lit(None).cast("bigint").alias("not_positive")))
    pay = c["payments"].agg(F.lit("payments").alias("table"),
                            F.lit("payment_value").alias("key"),
                            F.lit(0).cast("bigint").alias("null_keys"),
                            F.lit(None).cast("bigint").alias("duplicate_keys"),
                            F.count_if(F.col("payment_value") <= 0).alias("not_positive"))
    return reduce(DataFrame.unionByName, parts + [pay])


register("key_checks_clean", " UNION ALL ".join([f"""
SELECT '{t}' AS "table", '{k}' AS "key",
       CAST(count(*) FILTER (WHERE {k} IS NULL) AS BIGINT) AS null_keys,
       CAST(count(*) - (SELECT count(*) FROM (SELECT DISTINCT {k} FROM cl_{t}) z) AS BIGINT)
            AS duplicate_keys, CAST(NULL AS BIGINT) AS not_positive
FROM cl_{t}""" for t, k in CLEAN_KEYS.items()] + ["""
SELECT 'payments', 'payment_value', CAST(0 AS BIGINT), CAST(NULL AS BIGINT),
       CAST(count(*) FILTER (WHERE payment_value <= 0) AS BIGINT) FROM cl_payments"""]))(
    _key_checks)


# ------------------------------------------------------ star schema checks
def _star_fk(s, d):
    st = star(s, d)
    return Q.fk_report([(st[ct], ct, fk, st[pt], pt, pk) for ct, fk, pt, pk in FOREIGN_KEYS],
                       null_is_orphan=False)


register("fk_orphans_star", _fk_sql(FOREIGN_KEYS, "", declared=True))(_star_fk)


def _rejects(s, d):
    c = clean(s, d)
    parts = [build_table(t, c[SOURCE[t]]).rejects.agg(
        F.lit(t).alias("table"), F.count(F.lit(1)).alias("rejected")) for t in LOAD_ORDER]
    return reduce(DataFrame.unionByName, parts)


REJECT_SQL = {
    "dim_geolocation": ("cl_geolocation", "geolocation_zip_code_prefix IS NULL OR geolocation_state IS NULL OR length(geolocation_city) > 100 OR length(geolocation_state) > 2"),
    "dim_customers": ("cl_customers", "customer_id IS NULL OR customer_unique_id IS NULL OR length(customer_city) > 100 OR length(customer_state) > 2"),
    "dim_sellers": ("cl_sellers", "seller_id IS NULL OR length(seller_city) > 100 OR length(seller_state) > 2"),
    "dim_products": ("cl_products", "product_id IS NULL OR length(product_category_name) > 100 OR length(product_category_name_english) > 100"),
    "fact_orders": ("cl_orders", "order_id IS NULL OR customer_id IS NULL OR order_status IS NULL OR length(order_status) > 20"),
    "fact_order_items": ("cl_order_items", "order_id IS NULL OR order_item_id IS NULL OR price IS NULL OR freight_value IS NULL"),
    "fact_payments": ("cl_payments", "order_id IS NULL OR payment_type IS NULL OR payment_value IS NULL OR length(payment_type) > 30"),
    "fact_reviews": ("cl_reviews", "review_id IS NULL OR order_id IS NULL OR review_score IS NULL OR review_score NOT BETWEEN 1 AND 5"),
}
register("star_rejects", " UNION ALL ".join(
    f"SELECT '{t}' AS \"table\", CAST(count(*) FILTER (WHERE {cond}) AS BIGINT) AS rejected "
    f"FROM {cte}" for t, (cte, cond) in REJECT_SQL.items()))(_rejects)

register("star_row_counts", " UNION ALL ".join(
    f"SELECT '{t}' AS \"table\", CAST(count(*) AS BIGINT) AS \"rows\" FROM {t}"
    for t in LOAD_ORDER))(
    lambda s, d: reduce(DataFrame.unionByName, [
        v.agg(F.lit(k).alias("table"), F.count(F.lit(1)).alias("rows"))
        for k, v in star(s, d).items()]))

register("star_key_duplicates", " UNION ALL ".join(
    f"SELECT '{t}' AS \"table\", CAST(count(*) - (SELECT count(*) FROM (SELECT DISTINCT "
    f"{', '.join(PRIMARY_KEY[t])} FROM {t}) z) AS BIGINT) AS duplicates FROM {t}"
    for t in LOAD_ORDER))(
    lambda s, d: reduce(DataFrame.unionByName, [
        Q.duplicate_count(star(s, d)[t].select(*PRIMARY_KEY[t]), PRIMARY_KEY[t])
        .select(F.lit(t).alias("table"), "duplicates")
        for t in LOAD_ORDER]))

_ = STAR_COLS, _cast_sql  # shared column specs live in feria.registry


# ------------------------------------------------------ text normalisation
from feria.functions import normalize_text  # noqa: E402
from feria.operators.dedup import By, insert_ignore, latest_per_key  # noqa: E402
from feria.sources.bindings import read_driver  # noqa: E402

register("normalize_text_documents", f"""
SELECT CAST(doc_id AS BIGINT) AS doc_id, {O.norm('text')} AS text_norm FROM documents""")(
    lambda s, d: read_driver(s, d, "documents").select(
        "doc_id", normalize_text("text").alias("text_norm")))


# ---------------------------------------------------------- insert-ignore
# An earlier load holds the items of orders placed before 1998; the new
# batch is every line item (with its duplicated keys). Rows to append are
# the first arrival per key among keys not yet loaded.
ITEM_ARRIVAL = [By("product_id"), By("seller_id"), By("_price"), By("shipping_limit_date"),
                By("_tax")]


def _incoming_items(s, d):
    li = read_driver(s, d, "lineitem")
    return li.select(F.col("l_orderkey").alias("order_id"),
                     F.col("l_linenumber").alias("order_item_id"),
                     F.col("l_partkey").alias("product_id"), F.col("l_suppkey").alias("seller_id"),
                     F.col("l_shipdate").alias("shipping_limit_date"),
                     F.col("l_extendedprice").alias("_price"), F.col("l_tax").alias("_tax"))


def _target_items(s, d):
    o = read_driver(s, d, "orders").where(F.col("o_orderdate") < F.lit("1998-01-01")
                                          .cast("timestamp_ntz"))
    return raw(s, d)["order_items"].join(
        o.select(F.col("o_orderkey").alias("order_id")), "order_id", "left_semi")


def _appended(s, d):
    fresh = insert_ignore(_target_items(s, d), _incoming_items(s, d),
                             ["order_id", "order_item_id"], ITEM_ARRIVAL)
    return fresh.select("order_id", "order_item_id", "product_id", "seller_id",
                        "shipping_limit_date")


INCOMING_SQL = """(SELECT l_orderkey AS order_id, l_linenumber AS order_item_id,
  l_partkey AS product_id, l_suppkey AS seller_id, l_shipdate AS shipping_limit_date,
  l_extendedprice AS _price, l_tax AS _tax FROM lineitem)"""
TARGET_SQL = """(SELECT i.* FROM raw_order_items i WHERE i.order_id IN
  (SELECT o_orderkey FROM orders WHERE o_orderdate < TIMESTAMP '1998-01-01'))"""
FIRST_SQL = f"""(SELECT * FROM (SELECT *, row_number() OVER (
  PARTITION BY order_id, order_item_id
  ORDER BY product_id, seller_id, _price, shipping_limit_date, _tax) AS rn
  FROM {INCOMING_SQL} x) WHERE rn = 1)"""

register("insert_ignore_items", f"""
SELECT CAST(f.order_id AS BIGINT) AS order_id, CAST(f.order_item_id AS BIGINT) AS order_item_id,
       CAST(f.product_id AS BIGINT) AS product_id, CAST(f.seller_id AS BIGINT) AS seller_id,
       f.shipping_limit_date
FROM {FIRST_SQL} f ANTI JOIN {TARGET_SQL} t
  ON f.order_id = t.order_id AND f.order_item_id = t.order_item_id""")(_appended)


def _ignore_report(s, d):
    inc = _incoming_items(s, d)
    fresh = insert_ignore(_target_items(s, d), inc, ["order_id", "order_item_id"], ITEM_ARRIVAL)
    return (inc.agg(F.count(F.lit(1)).alias("incoming"))
            .crossJoin(fresh.agg(F.count(F.lit(1)).alias("appended")))  # one row each
            .withColumn("skipped", F.col("incoming") - F.col("appended")))


register("insert_ignore_report", f"""
SELECT (SELECT CAST(count(*) AS BIGINT) FROM {INCOMING_SQL} a) AS incoming,
       (SELECT CAST(count(*) AS BIGINT) FROM {FIRST_SQL} f ANTI JOIN {TARGET_SQL} t
          ON f.order_id = t.order_id AND f.order_item_id = t.order_item_id) AS appended,
       (SELECT CAST(count(*) AS BIGINT) FROM {INCOMING_SQL} a)
       - (SELECT CAST(count(*) AS BIGINT) FROM {FIRST_SQL} f ANTI JOIN {TARGET_SQL} t
          ON f.order_id = t.order_id AND f.order_item_id = t.order_item_id) AS skipped""")(
    _ignore_report)


# latest answered review per order on the raw reviews (keyed de-duplication)
register("latest_review_per_order", """
SELECT CAST(review_id AS BIGINT) AS review_id, CAST(order_id AS BIGINT) AS order_id,
       review_answer_timestamp
FROM (SELECT *, row_number() OVER (PARTITION BY order_id
        ORDER BY review_answer_timestamp DESC NULLS LAST, review_id) AS rn FROM raw_reviews)
WHERE rn = 1""")(
    lambda s, d: latest_per_key(
        raw(s, d)["reviews"].select("review_id", "order_id", "review_answer_timestamp"),
        "order_id", "review_answer_timestamp", "review_id"))


# ------------------------------------------------- more report frames
register("distinct_sample_customer_cities", """
SELECT customer_city FROM (SELECT DISTINCT customer_city FROM raw_customers
                           WHERE customer_city IS NOT NULL) t
ORDER BY customer_city LIMIT 20""")(
    lambda s, d: raw(s, d)["customers"].where(F.col("customer_city").isNotNull())
    .select("customer_city").distinct().orderBy("customer_city").limit(20))

register("distinct_sample_seller_cities", """
SELECT seller_city FROM (SELECT DISTINCT seller_city FROM raw_sellers
                         WHERE seller_city IS NOT NULL) t
ORDER BY seller_city LIMIT 20""")(
    lambda s, d: raw(s, d)["sellers"].where(F.col("seller_city").isNotNull())
    .select("seller_city").distinct().orderBy("seller_city").limit(20))

register("dash_q2_chart_sorted", f"""
SELECT * FROM ({_q2_sql(Dsh.Filters())}) t ORDER BY revenue, category""")(
    lambda s, d: Dsh.top_categories(star(s, d)).orderBy("revenue", "category"))


def _load_verification(s, d):
    c, st = clean(s, d), star(s, d)
    parts = [c[SOURCE[t]].agg(F.lit(t).alias("table"), F.count(F.lit(1)).alias("cleaned"))
             .crossJoin(st[t].agg(F.count(F.lit(1)).alias("loaded")))
             .select("table", "cleaned", "loaded",
                     (F.col("cleaned") - F.col("loaded")).alias("not_loaded"))
             for t in LOAD_ORDER]
    return reduce(DataFrame.unionByName, parts)


register("load_verification", " UNION ALL ".join(f"""
SELECT '{t}' AS "table", CAST(a AS BIGINT) AS cleaned, CAST(b AS BIGINT) AS loaded,
       CAST(a - b AS BIGINT) AS not_loaded
FROM (SELECT (SELECT count(*) FROM {cte}) AS a, (SELECT count(*) FROM {t}) AS b) x"""
                                              for t, (cte, _) in REJECT_SQL.items()))(
    _load_verification)


# issue register filled from measured counts
ISSUES = [
    ("orders", "order_approved_at", "nulls", "order_approved_at IS NULL", "raw_orders"),
    ("orders", "order_delivered_customer_date", "nulls",
     "order_delivered_customer_date IS NULL", "raw_orders"),
    ("orders", "order_approved_at", "temporal anomaly",
     "order_approved_at < order_purchase_timestamp", "raw_orders"),
    ("products", "product_category_name", "nulls", "product_category_name IS NULL",
     "raw_products"),
    ("products", "product_weight_g", "zero value", "product_weight_g = 0", "raw_products"),
    ("geolocation", "geolocation_lat", "outside bounding box",
     "NOT (geolocation_lat BETWEEN -33.7 AND 5.3 AND geolocation_lng BETWEEN -73.9 AND -28.8)",
     "raw_geolocation"),
    ("reviews", "review_comment_message", "nulls", "review_comment_message IS NULL",
     "raw_reviews"),
    ("payments", "payment_value", "zero value", "payment_value = 0", "raw_payments"),
    ("customers", "customer_city", "encoding",
     "customer_city <> lower(trim(customer_city))", "raw_customers"),
    ("sellers", "seller_city", "encoding",
     "seller_city <> lower(trim(seller_city))", "raw_sellers"),
]
# Columns whose repeated values are an issue.
REPEATED_KEYS = [("geolocation", "geolocation_zip_code_prefix"), ("reviews", "order_id")]


def _issues(s, d):
    r = raw(s, d)
    parts = [r[cte[4:]].agg(F.lit(t).alias("table"), F.lit(c).alias("column"),
                            F.lit(p).alias("problem"),
                            F.count_if(F.expr(cond)).alias("count"))
             for t, c, p, cond, cte in ISSUES]
    parts += [Q.duplicate_count(r[t], [c]).select(
        F.lit(t).alias("table"), F.lit(c).alias("column"), F.lit("duplicate key").alias("problem"),
        F.col("duplicates").alias("count")) for t, c in REPEATED_KEYS]
    return Q.issue_register(s, reduce(DataFrame.unionByName, parts))


ACTIONS_SQL = """(VALUES ('nulls', 'keep NULL where valid, impute where a rule exists'),
 ('temporal anomaly', 'report, do not remove'), ('outside bounding box', 'filter by the bounding box'),
 ('duplicate key', 'aggregate or keep one row per key'), ('zero value', 'treat as missing or remove'),
 ('encoding', 'normalise text'), ('orphan key', 'flag and exclude from joins')) a(problem, action)"""
register("issue_register", f"""
SELECT m."table", m."column", m.problem, m."count", a.action FROM (""" + " UNION ALL ".join(
    f"SELECT '{t}' AS \"table\", '{c}' AS \"column\", '{p}' AS problem, "
    f"CAST(count(*) FILTER (WHERE {cond}) AS BIGINT) AS \"count\" FROM {cte}"
    for t, c, p, cond, cte in ISSUES) + "".join(
    f" UNION ALL SELECT '{t}', '{c}', 'duplicate key', "
    f"CAST(count(*) - (SELECT count(*) FROM (SELECT DISTINCT {c} FROM raw_{t}) z) AS BIGINT) FROM raw_{t}"
    for t, c in REPEATED_KEYS) + f") m LEFT JOIN {ACTIONS_SQL} ON m.problem = a.problem")(
    _issues)


# domain rules over the cleaned tables (one row per rule)
# (table, rule name, SQL predicate) - predicates are plain SQL, valid in both
# engines, and only turned into Columns when a query runs.
DOMAIN_RULES = [
    ("payments", "payment_value <= 0", "payment_value <= 0"),
    ("reviews", "review_score not in 1..5", "review_score NOT BETWEEN 1 AND 5"),
    ("order_items", "price <= 0", "price <= 0"),
    ("order_items", "freight_value < 0", "freight_value < 0"),
    ("orders", "delivery_time_days < 0", "delivery_time_days < 0"),
    ("products", "product_weight_g <= 0", "product_weight_g <= 0"),
]


def _domain(s, d):
    c = clean(s, d)
    return reduce(DataFrame.unionByName, [
        c[t].agg(F.lit(t).alias("table"), F.lit(rule).alias("rule"),
                 F.count_if(F.expr(cond)).alias("violations"))
        for t, rule, cond in DOMAIN_RULES])


register("domain_violations", " UNION ALL ".join(
    f"SELECT '{t}' AS \"table\", '{rule}' AS rule, "
    f"CAST(count(*) FILTER (WHERE {cond}) AS BIGINT) AS violations FROM cl_{t}"
    for t, rule, cond in DOMAIN_RULES))(_domain)

register("bbox_outliers", """
SELECT CAST(geolocation_zip_code_prefix AS BIGINT) AS geolocation_zip_code_prefix,
       geolocation_lat, geolocation_lng
FROM raw_geolocation
WHERE geolocation_lat < -33.7 OR geolocation_lat > 5.3
   OR geolocation_lng < -73.9 OR geolocation_lng > -28.8""")(
    lambda s, d: raw(s, d)["geolocation"].where(
        (F.col("geolocation_lat") < -33.7) | (F.col("geolocation_lat") > 5.3)
        | (F.col("geolocation_lng") < -73.9) | (F.col("geolocation_lng") > -28.8))
    .select("geolocation_zip_code_prefix", "geolocation_lat", "geolocation_lng"))


# full-row duplicates per raw table (rows repeating an earlier identical row)
def _full_dups(s, d):
    r = raw(s, d)
    return reduce(DataFrame.unionByName, [
        Q.duplicate_count(r[t]).select(F.lit(t).alias("table"), "rows", "duplicates")
        for t in RAW_TYPES])


register("full_row_duplicates", " UNION ALL ".join(
    f"SELECT '{t}' AS \"table\", CAST(count(*) AS BIGINT) AS \"rows\", "
    f"CAST(count(*) - (SELECT count(*) FROM (SELECT DISTINCT * FROM raw_{t}) z) AS BIGINT) "
    f"AS duplicates FROM raw_{t}" for t in RAW_TYPES))(_full_dups)
