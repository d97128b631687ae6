"""Registered queries: name -> (Spark callable, DuckDB oracle SQL or None).

Every callable takes ``(spark, sf_dir)``, reads the driver tables under
``sf_dir`` through the bindings and returns a lazy DataFrame. Output columns
are normalised (integers BIGINT, decimals DOUBLE) so both engines agree on
types.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from feria import duck_oracle as O
from feria.plans import analytics as A
from feria.plans.clean import clean_all
from feria.lazy import LazyTables
from feria.plans.warehouse import SOURCE, build_table
from feria.schemas import LOAD_ORDER
from feria.sources.bindings import raw_tables

QueryFn = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, QueryFn] = {}
ORACLE: dict[str, str] = {}


def normalize_output(df: DataFrame) -> DataFrame:
    cols = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, (T.ByteType, T.ShortType, T.IntegerType, T.LongType)):
            c = c.cast("bigint")
        elif isinstance(f.dataType, (T.DecimalType, T.FloatType)):
            c = c.cast("double")
        elif isinstance(f.dataType, T.BooleanType):
            c = c.cast("bigint")
        cols.append(c.alias(f.name))
    return df.select(*cols)


def register(name: str, oracle: str | None):
    def deco(fn: QueryFn) -> QueryFn:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return normalize_output(fn(spark, sf_dir))
        run.__name__ = name
        run.__doc__ = fn.__doc__
        QUERIES[name] = run
        if oracle is not None:
            ORACLE[name] = O.with_ctes(oracle)
        return run
    return deco


# ----------------------------------------------------------- shared inputs
def raw(spark, sf_dir):
    return raw_tables(spark, sf_dir)


def clean(spark, sf_dir):
    return clean_all(raw(spark, sf_dir))


def star(spark, sf_dir):
    cleaned = clean(spark, sf_dir)
    return LazyTables({t: (lambda t=t: build_table(t, cleaned[SOURCE[t]]).rows)
                       for t in LOAD_ORDER})


# ------------------------------------------------------------------ Q1-Q5
@register("q1_monthly_volume", f"""
SELECT order_yearmonth, CAST(count(*) AS BIGINT) AS total_orders,
       CAST(count(*) FILTER (WHERE is_delivered = 1) AS BIGINT) AS delivered_orders,
       {O.pct("count(*) FILTER (WHERE is_delivered = 1)", "count(*)", 2)} AS delivery_rate_pct
FROM fact_orders WHERE order_yearmonth IS NOT NULL
GROUP BY order_yearmonth ORDER BY order_yearmonth""")
def _q1(spark, sf_dir):
    return A.q1_monthly_volume(star(spark, sf_dir))


@register("q2_top_categories", f"""
SELECT p.category_name_en, CAST(count(DISTINCT oi.order_id) AS BIGINT) AS total_orders,
       CAST(sum(oi.price) AS DOUBLE) AS total_revenue,
       {O.money_mean("oi.price", 2)} AS avg_price,
       CAST(count(*) AS BIGINT) AS items_sold
FROM fact_order_items oi JOIN dim_products p ON oi.product_id = p.product_id
WHERE p.category_name_en IS NOT NULL
GROUP BY p.category_name_en
ORDER BY total_revenue DESC NULLS FIRST, p.category_name_en LIMIT 10""")
def _q2(spark, sf_dir):
    return A.q2_top_categories(star(spark, sf_dir))


@register("q3_delivery_by_state", f"""
SELECT c.state AS customer_state, CAST(count(*) AS BIGINT) AS delivered_orders,
       {O.mean("o.delivery_time_days", 1)} AS avg_delivery_days,
       round(quantile_cont(o.delivery_time_days, 0.5), 1) AS median_delivery_days,
       {O.mean("o.delay_days", 1)} AS avg_delay_days,
       CAST(count(*) FILTER (WHERE o.delay_days > 0) AS BIGINT) AS late_deliveries,
       {O.pct("count(*) FILTER (WHERE o.delay_days > 0)", "count(*)", 2)} AS late_pct
FROM fact_orders o JOIN dim_customers c ON o.customer_id = c.customer_id
WHERE o.is_delivered = 1 AND o.delivery_time_days IS NOT NULL
GROUP BY c.state ORDER BY avg_delivery_days DESC NULLS FIRST, customer_state""")
def _q3(spark, sf_dir):
    return A.q3_delivery_by_state(star(spark, sf_dir))


# The oracle states Q4 with filtered counts over the order/review join
# rather than a table of 0/1 flags: same meaning, independent formulation.
Q4_JOIN = "fact_orders o LEFT JOIN fact_reviews r ON o.order_id = r.order_id"
Q4_CANCELED = "o.order_status = 'canceled'"
Q4_LATE = "o.delay_days > 0"
Q4_NEG = "r.is_negative = 1"
Q4_ANY = f"({Q4_CANCELED} OR {Q4_LATE} OR {Q4_NEG})"


def _cnt(cond: str) -> str:
    return f"count(*) FILTER (WHERE {cond})"


@register("q4_incident_rates", f"""
SELECT CAST(count(*) AS BIGINT) AS total_orders,
       CAST({_cnt(Q4_CANCELED)} AS BIGINT) AS canceled,
       CAST({_cnt(Q4_LATE)} AS BIGINT) AS late_deliveries,
       CAST({_cnt(Q4_NEG)} AS BIGINT) AS negative_reviews,
       CAST({_cnt(Q4_ANY)} AS BIGINT) AS with_any_incident,
       {O.pct(_cnt(Q4_CANCELED), "count(*)", 2)} AS canceled_pct,
       {O.pct(_cnt(Q4_LATE), "count(*)", 2)} AS late_pct,
       {O.pct(_cnt(Q4_NEG), "count(*)", 2)} AS negative_review_pct,
       {O.pct(_cnt(Q4_ANY), "count(*)", 2)} AS incident_pct
FROM {Q4_JOIN}""")
def _q4(spark, sf_dir):
    return A.q4_incident_rates(star(spark, sf_dir))


@register("q5_seller_quality", f"""
SELECT oi.seller_id, s.city AS seller_city, s.state AS seller_state,
       CAST(count(DISTINCT oi.order_id) AS BIGINT) AS total_orders,
       CAST(sum(oi.price) AS DOUBLE) AS total_revenue,
       {O.mean("r.review_score", 2)} AS avg_review_score,
       CAST(count(*) FILTER (WHERE r.is_negative = 1) AS BIGINT) AS negative_reviews,
       {O.pct("count(*) FILTER (WHERE r.is_negative = 1)", "count(DISTINCT oi.order_id)", 2)}
            AS negative_pct,
       {O.mean("o.delivery_time_days", 1)} AS avg_delivery_days,
       CAST(count(*) FILTER (WHERE o.delay_days > 0) AS BIGINT) AS late_orders,
       {O.pct("count(*) FILTER (WHERE o.delay_days > 0)", "count(DISTINCT oi.order_id)", 2)}
            AS late_pct
FROM fact_order_items oi
JOIN fact_orders o ON oi.order_id = o.order_id
JOIN dim_sellers s ON oi.seller_id = s.seller_id
LEFT JOIN fact_reviews r ON o.order_id = r.order_id
WHERE o.is_delivered = 1
GROUP BY oi.seller_id, s.city, s.state
HAVING count(DISTINCT oi.order_id) >= 50
ORDER BY avg_review_score DESC NULLS FIRST, total_revenue DESC NULLS FIRST, oi.seller_id
LIMIT 20""")
def _q5(spark, sf_dir):
    return A.q5_seller_quality(star(spark, sf_dir))


# -------------------------------------------------------------- dashboard
from feria.plans import dashboard as Dsh  # noqa: E402

# A concrete user choice used by the "_filtered" variants (years, customer
# states, order statuses).
SAMPLE_FILTER = Dsh.Filters(years=(1996, 1999), states=("NB", "NC", "NH", "NK", "NP", "NX"),
                            statuses=("delivered", "shipped"))


def flt_sql(flt: "Dsh.Filters") -> str:
    parts = [f"o.order_year BETWEEN {flt.years[0]} AND {flt.years[1]}" if flt.years
             else "o.order_year IS NOT NULL"]
    q = lambda v: "'" + str(v).replace("'", "''") + "'"
    if flt.states:
        parts.append(f"c.state IN ({', '.join(q(s) for s in flt.states)})")
    if flt.statuses:
        parts.append(f"o.order_status IN ({', '.join(q(s) for s in flt.statuses)})")
    return " AND ".join(parts)


OC = "fact_orders o JOIN dim_customers c ON o.customer_id = c.customer_id"


def _kpi_sql(flt, by_order: bool) -> str:
    pay = ("(SELECT order_id, sum(payment_value) AS payment_value FROM fact_payments "
           "GROUP BY order_id)" if by_order else "fact_payments")
    return f"""
SELECT CAST(count(DISTINCT o.order_id) AS BIGINT) AS total_orders,
       CAST(round(sum(p.payment_value), 0) AS DOUBLE) AS total_revenue,
       CAST(count(DISTINCT c.customer_unique_id) AS BIGINT) AS unique_buyers,
       {O.mean("o.delivery_time_days", 1)} AS avg_delivery_days,
       {O.pct("count(*) FILTER (WHERE o.order_status = 'canceled')", "count(*)", 2)}
            AS cancel_rate,
       {O.mean("r.review_score", 2)} AS avg_review
FROM {OC} LEFT JOIN {pay} p ON o.order_id = p.order_id
LEFT JOIN fact_reviews r ON o.order_id = r.order_id
WHERE {flt_sql(flt)}"""


def _monthly_sql(flt, by_order: bool) -> str:
    pay = ("(SELECT order_id, sum(payment_value) AS payment_value FROM fact_payments "
           "GROUP BY order_id)" if by_order else "fact_payments")
    return f"""
SELECT o.order_yearmonth, CAST(count(*) AS BIGINT) AS total_orders,
       CAST(count(*) FILTER (WHERE o.is_delivered = 1) AS BIGINT) AS delivered,
       CAST(round(sum(p.payment_value), 0) AS DOUBLE) AS revenue
FROM {OC} LEFT JOIN {pay} p ON o.order_id = p.order_id
WHERE {flt_sql(flt)} AND o.order_yearmonth IS NOT NULL
GROUP BY o.order_yearmonth"""


def _q2_sql(flt) -> str:
    return f"""
SELECT p.category_name_en AS category, CAST(count(DISTINCT oi.order_id) AS BIGINT) AS orders,
       CAST(round(sum(oi.price), 0) AS DOUBLE) AS revenue,
       {O.money_mean("oi.price", 2)} AS avg_price, CAST(count(*) AS BIGINT) AS items_sold
FROM fact_order_items oi JOIN dim_products p ON oi.product_id = p.product_id
JOIN {OC.replace('fact_orders o', 'fact_orders o', 1)} ON oi.order_id = o.order_id
WHERE p.category_name_en IS NOT NULL AND {flt_sql(flt)}
GROUP BY p.category_name_en
ORDER BY revenue DESC NULLS FIRST, category LIMIT 10"""


def _q3_sql(flt, limit: str = "") -> str:
    return f"""
SELECT c.state, CAST(count(*) AS BIGINT) AS orders,
       {O.mean("o.delivery_time_days", 1)} AS avg_days,
       round(quantile_cont(o.delivery_time_days, 0.5), 1) AS median_days,
       {O.mean("o.delay_days", 1)} AS avg_delay,
       {O.pct("count(*) FILTER (WHERE o.delay_days > 0)", "count(*)", 1)} AS late_pct
FROM {OC}
WHERE {flt_sql(flt)} AND o.is_delivered = 1 AND o.delivery_time_days IS NOT NULL
GROUP BY c.state HAVING count(*) >= 10
ORDER BY avg_days DESC NULLS FIRST, c.state {limit}"""


def _q4_sql(flt) -> str:
    canceled, late, neg = "o.order_status = 'canceled'", "o.delay_days > 0", "r.is_negative = 1"
    return f"""
SELECT CAST(count(*) FILTER (WHERE {canceled}) AS BIGINT) AS canceled,
       CAST(count(*) FILTER (WHERE {late}) AS BIGINT) AS late,
       CAST(count(*) FILTER (WHERE {neg}) AS BIGINT) AS negative_reviews,
       CAST(count(*) FILTER (WHERE NOT coalesce({canceled} OR {late} OR {neg}, false))
            AS BIGINT) AS no_incident,
       CAST(count(*) AS BIGINT) AS total
FROM {OC} LEFT JOIN fact_reviews r ON o.order_id = r.order_id
WHERE {flt_sql(flt)}"""


def _score_sql(flt) -> str:
    tot = "sum(count(*)) OVER ()"
    return f"""
SELECT CAST(r.review_score AS BIGINT) AS review_score, CAST(count(*) AS BIGINT) AS total,
       {O.pct("count(*)", tot, 1)} AS pct
FROM fact_reviews r JOIN {OC} ON r.order_id = o.order_id
WHERE {flt_sql(flt)}
GROUP BY r.review_score ORDER BY r.review_score"""


def _q5_sql(flt, by_order: bool) -> str:
    if by_order:
        items = ("(SELECT seller_id, order_id, sum(price) AS price FROM fact_order_items "
                 "GROUP BY seller_id, order_id)")
        n = "count(*)"
    else:
        items = "fact_order_items"
        n = "count(DISTINCT oi.order_id)"
    return f"""
SELECT oi.seller_id, s.state AS seller_state, CAST({n} AS BIGINT) AS orders,
       CAST(round(sum(oi.price), 0) AS DOUBLE) AS revenue,
       {O.mean("r.review_score", 2)} AS avg_score,
       {O.pct("count(*) FILTER (WHERE r.is_negative = 1)", n, 1)} AS negative_pct,
       {O.mean("o.delivery_time_days", 1)} AS avg_delivery_days,
       {O.pct("count(*) FILTER (WHERE o.delay_days > 0)", n, 1)} AS late_pct
FROM {items} oi JOIN fact_orders o ON oi.order_id = o.order_id
JOIN dim_sellers s ON oi.seller_id = s.seller_id
JOIN dim_customers c ON o.customer_id = c.customer_id
LEFT JOIN fact_reviews r ON o.order_id = r.order_id
WHERE {flt_sql(flt)} AND o.is_delivered = 1
GROUP BY oi.seller_id, s.state HAVING {n} >= 30
ORDER BY avg_score DESC NULLS FIRST, revenue DESC NULLS FIRST, oi.seller_id"""


def _dash(name, sql, fn):
    register(name, sql)(fn)


ALL = Dsh.Filters()
for _suffix, _flt in (("", ALL), ("_filtered", SAMPLE_FILTER)):
    _dash(f"kpi_row{_suffix}", _kpi_sql(_flt, False),
          lambda s, d, f=_flt: Dsh.kpi_row(star(s, d), f))
    _dash(f"kpi_row_by_order{_suffix}", _kpi_sql(_flt, True),
          lambda s, d, f=_flt: Dsh.kpi_row_by_order(star(s, d), f))
    _dash(f"dash_q1_monthly{_suffix}", _monthly_sql(_flt, False) + " ORDER BY 1",
          lambda s, d, f=_flt: Dsh.monthly(star(s, d), f))
    _dash(f"dash_q1_monthly_by_order{_suffix}", _monthly_sql(_flt, True) + " ORDER BY 1",
          lambda s, d, f=_flt: Dsh.monthly_by_order(star(s, d), f))
    _dash(f"dash_q1_peak{_suffix}",
          _monthly_sql(_flt, False) + " ORDER BY total_orders DESC, order_yearmonth LIMIT 1",
          lambda s, d, f=_flt: Dsh.peak_month(Dsh.monthly(star(s, d), f)))
    _dash(f"dash_q2_categories{_suffix}", _q2_sql(_flt),
          lambda s, d, f=_flt: Dsh.top_categories(star(s, d), f))
    _dash(f"dash_q3_delivery{_suffix}", _q3_sql(_flt),
          lambda s, d, f=_flt: Dsh.delivery_by_state(star(s, d), f))
    _dash(f"dash_q4_incidents{_suffix}", _q4_sql(_flt),
          lambda s, d, f=_flt: Dsh.incident_split(star(s, d), f))
    _dash(f"score_distribution{_suffix}", _score_sql(_flt),
          lambda s, d, f=_flt: Dsh.score_distribution(star(s, d), f))
    _dash(f"dash_q5_sellers{_suffix}", _q5_sql(_flt, False),
          lambda s, d, f=_flt: Dsh.seller_scatter(star(s, d), f))
    _dash(f"dash_q5_sellers_by_order{_suffix}", _q5_sql(_flt, True),
          lambda s, d, f=_flt: Dsh.seller_scatter_by_order(star(s, d), f))

_dash("kpi_cards", f"""
SELECT format('{{:,}}', coalesce(total_orders, 0)) AS total_orders,
       'R$ ' || format('{{:,.0f}}', coalesce(total_revenue, 0)) AS total_revenue,
       format('{{:,}}', coalesce(unique_buyers, 0)) AS unique_buyers,
       format('{{:.1f}}', coalesce(avg_delivery_days, 0)) || ' days' AS avg_delivery,
       format('{{:.2f}}', coalesce(cancel_rate, 0)) || '%' AS cancel_rate,
       format('{{:.2f}}', coalesce(avg_review, 0)) AS avg_review
FROM ({_kpi_sql(ALL, False)}) k""", lambda s, d: Dsh.kpi_cards(Dsh.kpi_row(star(s, d), ALL)))
_dash("dash_q3_delivery_top15", _q3_sql(ALL, "LIMIT 15"),
      lambda s, d: Dsh.delivery_top(Dsh.delivery_by_state(star(s, d), ALL), 15))
_dash("top_sellers_table", f"""
SELECT substr(CAST(seller_id AS VARCHAR), 1, 8) || '…' AS seller, orders,
       'R$ ' || format('{{:,.0f}}', revenue) AS revenue_brl, avg_score AS score, late_pct
FROM ({_q5_sql(ALL, False)} LIMIT 10) q""",
      lambda s, d: Dsh.top_sellers_table(Dsh.seller_scatter(star(s, d), ALL), 10))
_dash("filter_choices", """
SELECT choice, value FROM (
  SELECT DISTINCT 'year' AS choice, CAST(order_year AS VARCHAR) AS value FROM fact_orders
  WHERE order_year IS NOT NULL
  UNION ALL SELECT DISTINCT 'state', state FROM dim_customers WHERE state IS NOT NULL
  UNION ALL SELECT DISTINCT 'status', order_status FROM fact_orders) t
ORDER BY choice, value""", lambda s, d: Dsh.filter_choices(star(s, d)))
_dash("year_bounds", """
SELECT CAST(coalesce(min(order_year), 2016) AS BIGINT) AS min_year,
       CAST(coalesce(max(order_year), 2018) AS BIGINT) AS max_year FROM fact_orders""",
      lambda s, d: Dsh.year_bounds(star(s, d)))


# ------------------------------------------------ cleaned tables and marts
from feria.plans import marts as M  # noqa: E402


def _cast_sql(cols: str) -> str:
    """'a:i b:d c' -> select list with BIGINT / DOUBLE casts (s/t untouched)."""
    out = []
    for spec in cols.split():
        name, _, kind = spec.partition(":")
        if kind == "i":
            out.append(f"CAST({name} AS BIGINT) AS {name}")
        elif kind == "d":
            out.append(f"CAST({name} AS DOUBLE) AS {name}")
        else:
            out.append(name)
    return ", ".join(out)


CLEAN_COLS = {
    "geolocation": "geolocation_zip_code_prefix:i geolocation_lat:d geolocation_lng:d "
                   "geolocation_city geolocation_state",
    "customers": "customer_id:i customer_unique_id:i customer_zip_code_prefix:i customer_city "
                 "customer_state",
    "sellers": "seller_id:i seller_zip_code_prefix:i seller_city seller_state",
    "products": "product_id:i product_category_name product_name_lenght:i "
                "product_description_lenght:i product_photos_qty:i product_weight_g:d "
                "product_length_cm:d product_height_cm:d product_width_cm:d "
                "product_category_name_english",
    "orders": "order_id:i customer_id:i order_status order_purchase_timestamp order_approved_at "
              "order_delivered_carrier_date order_delivered_customer_date "
              "order_estimated_delivery_date is_delivered:i delivery_time_days:i delay_days:i "
              "order_year:i order_month:i order_yearmonth has_items:i",
    "order_items": "order_id:i order_item_id:i product_id:i seller_id:i shipping_limit_date "
                   "price:d freight_value:d total_item_value:d",
    "payments": "order_id:i payment_sequential:i payment_type payment_installments:i "
                "payment_value:d",
    "reviews": "review_id:i order_id:i review_score:i review_comment_title "
               "review_comment_message review_creation_date review_answer_timestamp "
               "is_negative:i has_comment:i",
}

for _t, _cols in CLEAN_COLS.items():
    register(f"clean_{_t}", f"SELECT {_cast_sql(_cols)} FROM cl_{_t}")(
        lambda s, d, t=_t: clean(s, d)[t])

register("payments_summary", f"""SELECT {_cast_sql(
    "order_id:i total_payment:d payment_installments:i payment_methods_count:i "
    "primary_payment_type")} FROM payments_summary""")(
    lambda s, d: M.payments_summary(clean(s, d)["payments"]))
register("items_per_order", f"""SELECT {_cast_sql(
    "order_id:i item_count:i items_revenue:d freight_total:d seller_id:i product_id:i")}
FROM items_per_order""")(lambda s, d: M.items_per_order(clean(s, d)["order_items"]))

MASTER_COLS = (CLEAN_COLS["orders"] + " customer_unique_id:i customer_city customer_state "
               "total_payment:d payment_installments:i payment_methods_count:i "
               "primary_payment_type review_score:i is_negative:i has_comment:i item_count:i "
               "items_revenue:d freight_total:d seller_id:i product_id:i "
               "product_category_name_english seller_city seller_state")
register("master", f"""
SELECT {_cast_sql(MASTER_COLS)} FROM (
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
  WHERE o.has_items = 1) m""")(lambda s, d: M.master(clean(s, d)))

STAR_COLS = {
    "dim_geolocation": "zip_code_prefix:i city state lat:d lng:d",
    "dim_customers": "customer_id:i customer_unique_id:i zip_code_prefix:i city state",
    "dim_sellers": "seller_id:i zip_code_prefix:i city state",
    "dim_products": "product_id:i category_name_pt category_name_en name_length:i "
                    "description_length:i photos_qty:i weight_g:d length_cm:d height_cm:d "
                    "width_cm:d",
    "fact_orders": "order_id:i customer_id:i order_status is_delivered:i has_items:i "
                   "purchase_timestamp approved_at delivered_carrier_date "
                   "delivered_customer_date estimated_delivery_date delivery_time_days:i "
                   "delay_days:i order_year:i order_month:i order_yearmonth",
    "fact_order_items": "order_id:i order_item_id:i product_id:i seller_id:i "
                        "shipping_limit_date price:d freight_value:d total_item_value:d",
    "fact_payments": "payment_id:i order_id:i payment_sequential:i payment_type payment_installments:i "
                     "payment_value:d",
    "fact_reviews": "review_id:i order_id:i review_score:i is_negative:i has_comment:i "
                    "review_comment_title review_comment_message review_creation_date "
                    "review_answer_timestamp",
}
for _t, _cols in STAR_COLS.items():
    register(f"star_{_t}", f"SELECT {_cast_sql(_cols)} FROM {_t}")(
        lambda s, d, t=_t, c=_cols: star(s, d)[t].select(*[x.split(':')[0] for x in c.split()]))


# profiling, data quality, exploration (registers on import)
from feria import registry_quality  # noqa: E402,F401
from feria import registry_dirty  # noqa: E402,F401
from feria import registry_sql  # noqa: E402,F401
from feria import registry_statements  # noqa: E402,F401
from feria import registry_stored  # noqa: E402,F401
