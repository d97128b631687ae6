"""The business questions as SQL text over the warehouse tables.

``spark.sql`` gets the tables a statement names as arguments: only those are
planned, and no view is left in the caller's session.
"""

from __future__ import annotations

from feria.registry import ORACLE, QUERIES, normalize_output, star


def _pct(part: str, whole: str, n: int) -> str:
    return (f"CAST(ROUND(CAST({part} AS DECIMAL(20,0)) * 100"
            f" / NULLIF(CAST({whole} AS DECIMAL(20,0)), 0), {n}) AS DOUBLE)")


def _mean(x: str, n: int) -> str:
    return (f"CAST(ROUND(CAST(SUM({x}) AS DECIMAL(20,0))"
            f" / NULLIF(CAST(COUNT({x}) AS DECIMAL(20,0)), 0), {n}) AS DOUBLE)")


DELIVERED = "COUNT(*) FILTER (WHERE is_delivered = 1)"
LATE = "COUNT(*) FILTER (WHERE o.delay_days > 0)"
NEGATIVE = "COUNT(*) FILTER (WHERE r.is_negative = 1)"
ORDERS = "COUNT(DISTINCT oi.order_id)"
SQL = {
    "q1_monthly_volume": f"""
SELECT order_yearmonth, COUNT(*) AS total_orders, {DELIVERED} AS delivered_orders,
       {_pct(DELIVERED, 'COUNT(*)', 2)} AS delivery_rate_pct
FROM {{fact_orders}} WHERE order_yearmonth IS NOT NULL
GROUP BY order_yearmonth ORDER BY order_yearmonth""",
    "q2_top_categories": f"""
SELECT p.category_name_en, COUNT(DISTINCT oi.order_id) AS total_orders,
       CAST(SUM(oi.price) AS DOUBLE) AS total_revenue,
       CAST(ROUND(CAST(SUM(CAST(oi.price * 100 AS BIGINT)) AS DECIMAL(20,0))
            / CAST(COUNT(oi.price) * 100 AS DECIMAL(20,0)), 2) AS DOUBLE) AS avg_price,
       COUNT(*) AS items_sold
FROM {{fact_order_items}} oi JOIN {{dim_products}} p ON oi.product_id = p.product_id
WHERE p.category_name_en IS NOT NULL
GROUP BY p.category_name_en
ORDER BY total_revenue DESC NULLS FIRST, p.category_name_en LIMIT 10""",
    "q3_delivery_by_state": f"""
SELECT c.state AS customer_state, COUNT(*) AS delivered_orders,
       {_mean('o.delivery_time_days', 1)} AS avg_delivery_days,
       ROUND(PERCENTILE(o.delivery_time_days, 0.5), 1) AS median_delivery_days,
       {_mean('o.delay_days', 1)} AS avg_delay_days, {LATE} AS late_deliveries,
       {_pct(LATE, 'COUNT(*)', 2)} AS late_pct
FROM {{fact_orders}} o JOIN {{dim_customers}} c ON o.customer_id = c.customer_id
WHERE o.is_delivered = 1 AND o.delivery_time_days IS NOT NULL
GROUP BY c.state ORDER BY avg_delivery_days DESC NULLS FIRST, customer_state NULLS LAST""",
    "q4_incident_rates": f"""
SELECT COUNT(*) AS total_orders, SUM(c) AS canceled, SUM(l) AS late_deliveries, SUM(n) AS negative_reviews,
       SUM(GREATEST(c, l, n)) AS with_any_incident, {_pct('SUM(c)', 'COUNT(*)', 2)} AS canceled_pct,
       {_pct('SUM(l)', 'COUNT(*)', 2)} AS late_pct, {_pct('SUM(n)', 'COUNT(*)', 2)} AS negative_review_pct,
       {_pct('SUM(GREATEST(c, l, n))', 'COUNT(*)', 2)} AS incident_pct
FROM (SELECT CASE WHEN o.order_status = 'canceled' THEN 1 ELSE 0 END AS c,
             CASE WHEN o.delay_days > 0 THEN 1 ELSE 0 END AS l, COALESCE(CAST(r.is_negative AS INT), 0) AS n
      FROM {{fact_orders}} o LEFT JOIN {{fact_reviews}} r ON o.order_id = r.order_id) x""",
    "q5_seller_quality": f"""
SELECT oi.seller_id, s.city AS seller_city, s.state AS seller_state, {ORDERS} AS total_orders,
       CAST(ROUND(SUM(oi.price), 2) AS DOUBLE) AS total_revenue, {_mean('r.review_score', 2)} AS avg_review_score,
       {NEGATIVE} AS negative_reviews, {_pct(NEGATIVE, ORDERS, 2)} AS negative_pct,
       {_mean('o.delivery_time_days', 1)} AS avg_delivery_days, {LATE} AS late_orders,
       {_pct(LATE, ORDERS, 2)} AS late_pct
FROM {{fact_order_items}} oi JOIN {{fact_orders}} o ON oi.order_id = o.order_id
JOIN {{dim_sellers}} s ON oi.seller_id = s.seller_id LEFT JOIN {{fact_reviews}} r ON oi.order_id = r.order_id
WHERE o.is_delivered = 1
GROUP BY oi.seller_id, s.city, s.state HAVING {ORDERS} >= 50
ORDER BY avg_review_score DESC NULLS FIRST, total_revenue DESC NULLS FIRST, oi.seller_id LIMIT 20""",
}
TABLES = ["fact_orders", "fact_order_items", "fact_reviews", "dim_products", "dim_customers", "dim_sellers"]


def _run(text: str):
    def run(spark, sf_dir):
        st = star(spark, sf_dir)
        return normalize_output(spark.sql(text, **{t: st[t] for t in TABLES if f"{{{t}}}" in text}))
    return run


for _name, _text in SQL.items():
    QUERIES[f"{_name}_sql"] = _run(_text)
    ORACLE[f"{_name}_sql"] = ORACLE[_name]
