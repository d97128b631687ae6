"""The dashboard statements as SQL text with named parameters.

The choices of a user never become part of the text: years, states, statuses
and limits are parameter markers, lists are passed as arrays, and ``spark.sql``
binds them as literals, so a quote in a choice is only a quote. An empty list
means every value, an order without a year is never shown. The tables are bound
by name, too: no view is left in the caller's session.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from feria.plans.analytics import Star
from feria.plans.dashboard import Filters

FILTER = """(:any_year OR o.order_year BETWEEN :first_year AND :last_year) AND o.order_year IS NOT NULL
  AND (:any_state OR array_contains(:states, c.state))
  AND (:any_status OR array_contains(:statuses, o.order_status))"""
ORDERS = "{fact_orders} o JOIN {dim_customers} c ON o.customer_id = c.customer_id"


def _percent(part: str, whole: str, digits: int) -> str:
    return f"CAST(ROUND(CAST({part} AS DECIMAL(20,0)) * 100 / NULLIF(CAST({whole} AS DECIMAL(20,0)), 0), {digits}) AS DOUBLE)"


def _mean(x: str, digits: int) -> str:
    return f"CAST(ROUND(CAST(SUM({x}) AS DECIMAL(20,0)) / NULLIF(CAST(COUNT({x}) AS DECIMAL(20,0)), 0), {digits}) AS DOUBLE)"


def _money(x: str) -> str:
    return f"CAST(ROUND(SUM({x}), 0) AS DOUBLE)"


#: name -> statement; those that take more than the filters name their defaults.
STATEMENTS = {
    "kpi_row": f"""
SELECT COUNT(DISTINCT o.order_id) AS total_orders, {_money('p.payment_value')} AS total_revenue,
       COUNT(DISTINCT c.customer_unique_id) AS unique_buyers, {_mean('o.delivery_time_days', 1)} AS avg_delivery_days,
       {_percent("COUNT_IF(o.order_status = 'canceled')", 'COUNT(*)', 2)} AS cancel_rate, {_mean('r.review_score', 2)} AS avg_review
FROM {ORDERS} LEFT JOIN {{fact_payments}} p ON o.order_id = p.order_id LEFT JOIN {{fact_reviews}} r ON o.order_id = r.order_id
WHERE {FILTER}""",
    "dash_q1_monthly": f"""
SELECT o.order_yearmonth, COUNT(*) AS total_orders, COUNT_IF(o.is_delivered = 1) AS delivered, {_money('p.payment_value')} AS revenue
FROM {ORDERS} LEFT JOIN {{fact_payments}} p ON o.order_id = p.order_id
WHERE {FILTER} AND o.order_yearmonth IS NOT NULL
GROUP BY o.order_yearmonth ORDER BY o.order_yearmonth""",
    "dash_q2_categories": f"""
SELECT p.category_name_en AS category, COUNT(DISTINCT i.order_id) AS orders, {_money('i.price')} AS revenue,
       CAST(ROUND(CAST(SUM(CAST(i.price * 100 AS BIGINT)) AS DECIMAL(20,0)) / CAST(COUNT(i.price) * 100 AS DECIMAL(20,0)), 2) AS DOUBLE) AS avg_price,
       COUNT(*) AS items_sold
FROM {{fact_order_items}} i JOIN {{dim_products}} p ON i.product_id = p.product_id JOIN {ORDERS.replace(' JOIN', ' ON i.order_id = o.order_id JOIN', 1)}
WHERE {FILTER} AND p.category_name_en IS NOT NULL
GROUP BY p.category_name_en ORDER BY revenue DESC NULLS FIRST, category LIMIT :top""",
    "dash_q3_delivery": f"""
SELECT c.state, COUNT(*) AS orders, {_mean('o.delivery_time_days', 1)} AS avg_days,
       ROUND(PERCENTILE(o.delivery_time_days, 0.5), 1) AS median_days, {_mean('o.delay_days', 1)} AS avg_delay,
       {_percent('COUNT_IF(o.delay_days > 0)', 'COUNT(*)', 1)} AS late_pct
FROM {ORDERS}
WHERE {FILTER} AND o.is_delivered = 1 AND o.delivery_time_days IS NOT NULL
GROUP BY c.state HAVING COUNT(*) >= :least_orders
ORDER BY avg_days DESC NULLS FIRST, c.state NULLS LAST""",
    "dash_q4_incidents": f"""
SELECT SUM(x.c) AS canceled, SUM(x.l) AS late, SUM(x.n) AS negative_reviews, COUNT(*) - SUM(GREATEST(x.c, x.l, x.n)) AS no_incident, COUNT(*) AS total
FROM (SELECT CASE WHEN o.order_status = 'canceled' THEN 1 ELSE 0 END AS c, CASE WHEN o.delay_days > 0 THEN 1 ELSE 0 END AS l,
             COALESCE(CAST(r.is_negative AS INT), 0) AS n
      FROM {ORDERS} LEFT JOIN {{fact_reviews}} r ON o.order_id = r.order_id WHERE {FILTER}) x""",
    "score_distribution": f"""
SELECT review_score, total, {_percent('total', 'SUM(total) OVER ()', 1)} AS pct
FROM (SELECT r.review_score, COUNT(*) AS total
      FROM {{fact_reviews}} r JOIN {ORDERS.replace(' JOIN', ' ON r.order_id = o.order_id JOIN', 1)} WHERE {FILTER} GROUP BY r.review_score) x
ORDER BY review_score""",
    "dash_q5_sellers": f"""
SELECT i.seller_id, s.state AS seller_state, COUNT(DISTINCT i.order_id) AS orders, {_money('i.price')} AS revenue,
       {_mean('r.review_score', 2)} AS avg_score, {_percent('COUNT_IF(r.is_negative = 1)', 'COUNT(DISTINCT i.order_id)', 1)} AS negative_pct,
       {_mean('o.delivery_time_days', 1)} AS avg_delivery_days, {_percent('COUNT_IF(o.delay_days > 0)', 'COUNT(DISTINCT i.order_id)', 1)} AS late_pct
FROM {{fact_order_items}} i JOIN {ORDERS.replace(' JOIN', ' ON i.order_id = o.order_id JOIN', 1)}
JOIN {{dim_sellers}} s ON i.seller_id = s.seller_id LEFT JOIN {{fact_reviews}} r ON i.order_id = r.order_id
WHERE {FILTER} AND o.is_delivered = 1
GROUP BY i.seller_id, s.state HAVING COUNT(DISTINCT i.order_id) >= :least_orders
ORDER BY avg_score DESC NULLS FIRST, revenue DESC NULLS FIRST, i.seller_id""",
}
DEFAULTS = {"dash_q2_categories": {"top": 10}, "dash_q3_delivery": {"least_orders": 10}, "dash_q5_sellers": {"least_orders": 30}}
TABLES = ["fact_orders", "fact_order_items", "fact_payments", "fact_reviews", "dim_customers", "dim_products", "dim_sellers"]


def arguments(flt: Filters) -> dict:
    """The parameters of the filters. An empty list is passed as one of an
    empty text, with a flag that it is not looked at."""
    first, last = flt.years or (0, 0)

    def texts(values: tuple[str, ...]):
        return F.array(*[F.lit(v) for v in values]) if values else F.array(F.lit(""))

    return {"any_year": flt.years is None, "first_year": first, "last_year": last,
            "any_state": not flt.states, "states": texts(flt.states), "any_status": not flt.statuses, "statuses": texts(flt.statuses)}


def run_statement(spark: SparkSession, star: Star, name: str, flt: Filters = Filters(), **more: int) -> DataFrame:
    """One of ``STATEMENTS`` over the warehouse tables, for the user's choice;
    ``more`` replaces the defaults of its other parameters (top, least_orders)."""
    text, known = STATEMENTS[name], DEFAULTS.get(name, {})
    if unknown := set(more) - set(known):
        raise TypeError(f"{name} has no parameter {sorted(unknown)}")
    tables = {t: star[t] for t in TABLES if f"{{{t}}}" in text}
    return spark.sql(text, args={**arguments(flt), **known, **more}, **tables)
