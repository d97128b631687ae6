"""Checks and loads over dirty inputs: the cleaned tables with faults that
follow from their keys, so that no check passes by finding nothing.

Orphan and NULL keys, repeated keys and rows, prices and counts beyond their
declared type, over-long text, values outside their domain. The DuckDB side has
the same faults as CTEs.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feria import duck_oracle as O
from feria.operators import quality as Q
from feria.operators.profile import hash_sample
from feria.plans.warehouse import build_table
from feria.registry import clean, raw, register

# (table, column, SQL that both engines read): the faults of each table.
FAULTS = {
    "order_items": {
        "order_id": "CASE WHEN order_id % 11 = 0 THEN -order_id ELSE order_id END",
        "seller_id": "CASE WHEN order_id % 13 = 0 THEN NULL ELSE seller_id END",
        "price": "CASE WHEN order_id % 17 = 0 THEN CAST(price AS DECIMAL(20,2)) + 99999999 "
                 "WHEN order_id % 19 = 0 THEN CAST(-1 AS DECIMAL(20,2)) ELSE CAST(price AS DECIMAL(20,2)) END",
    },
    "payments": {
        "payment_type": "CASE WHEN order_id % 19 = 0 THEN repeat(payment_type, 20) ELSE payment_type END",
        "payment_installments": "CASE WHEN order_id % 23 = 0 THEN 70000 ELSE payment_installments END",
        "payment_value": "CASE WHEN order_id % 29 = 0 THEN CAST(-1 AS DECIMAL(10,2)) ELSE payment_value END",
    },
    "reviews": {
        "review_id": "CASE WHEN review_id % 3 = 0 THEN CAST(review_id - review_id % 10 AS BIGINT) ELSE review_id END",
        "review_score": "CASE WHEN order_id % 7 = 0 THEN review_score + 5 ELSE review_score END",
    },
}
# Rows that occur twice.
REPEATED = {"order_items": "order_id % 5 = 0", "payments": "order_id % 31 = 0", "reviews": "order_id % 37 = 0"}
COLUMNS = {
    "order_items": "order_id order_item_id product_id seller_id shipping_limit_date price freight_value total_item_value",
    "payments": "order_id payment_sequential payment_type payment_installments payment_value",
    "reviews": "review_id order_id review_score review_comment_title review_comment_message review_creation_date "
               "review_answer_timestamp is_negative has_comment",
}
STAR_OF = {"order_items": "fact_order_items", "payments": "fact_payments", "reviews": "fact_reviews"}
CHILD_KEYS = [("order_items", "order_id", "orders", "order_id"), ("order_items", "seller_id", "sellers", "seller_id")]


def dirty(s, d, table: str) -> DataFrame:
    df = clean(s, d)[table].select(*COLUMNS[table].split())
    faulty = df.select(*[F.expr(FAULTS[table].get(c, f"`{c}`")).alias(c) for c in df.columns])
    again = df.where(F.expr(REPEATED[table]))
    again = again.select(*[F.expr(FAULTS[table].get(c, f"`{c}`")).alias(c) for c in df.columns])
    return faulty.unionByName(again)


def _dirty_sql(table: str) -> str:
    cols = ", ".join(f"{FAULTS[table].get(c, c)} AS {c}" for c in COLUMNS[table].split())
    return f"SELECT {cols} FROM cl_{table} UNION ALL SELECT {cols} FROM cl_{table} WHERE {REPEATED[table]}"


O.CTES.extend((f"dirty_{t}", _dirty_sql(t)) for t in FAULTS)

# What the load rejects, as one reason per row (in the order of its rules).
REASONS = {
    "order_items": "concat_ws('; ', CASE WHEN price > 99999999.99 THEN 'price does not fit decimal(10,2)' END, "
                   "CASE WHEN price > 99999999.99 THEN 'price is null' END)",
    "payments": "concat_ws('; ', CASE WHEN payment_installments > 32767 THEN 'payment_installments does not fit smallint' END, "
                "CASE WHEN length(payment_type) > 30 THEN 'payment_type longer than 30' END)",
    "reviews": "CASE WHEN review_score NOT BETWEEN 1 AND 5 THEN 'review_score not in [1,5]' ELSE '' END",
}
KEY_SQL = {"order_items": "(order_id, order_item_id)",
           "payments": "(order_id, payment_sequential, n)", "reviews": "review_id"}


def _rejects(s, d):
    parts = [build_table(STAR_OF[t], dirty(s, d, t)).rejects.groupBy("reason")
             .agg(F.count(F.lit(1)).alias("rejected")).select(F.lit(t).alias("table"), "reason", "rejected") for t in FAULTS]
    return reduce(DataFrame.unionByName, parts)


register("dirty_star_rejects", " UNION ALL ".join(
    f"SELECT '{t}' AS \"table\", {r} AS reason, CAST(count(*) AS BIGINT) AS rejected FROM dirty_{t} WHERE {r} <> '' GROUP BY 2"
    for t, r in REASONS.items()))(_rejects)


def _verification(s, d):
    parts = []
    for t in FAULTS:
        df = dirty(s, d, t)
        parts.append(df.agg(F.lit(t).alias("table"), F.count(F.lit(1)).alias("cleaned")).crossJoin(
            F.broadcast(build_table(STAR_OF[t], df).rows.agg(F.count(F.lit(1)).alias("loaded")))))  # one row each
    return reduce(DataFrame.unionByName, parts).withColumn("not_loaded", F.col("cleaned") - F.col("loaded"))


register("dirty_load_verification", " UNION ALL ".join(f"""
SELECT '{t}' AS "table", CAST(a AS BIGINT) AS cleaned, CAST(b AS BIGINT) AS loaded, CAST(a - b AS BIGINT) AS not_loaded
FROM (SELECT (SELECT count(*) FROM dirty_{t}) AS a,
             (SELECT count(DISTINCT {KEY_SQL[t]}) FROM (SELECT *, row_number() OVER (PARTITION BY {COLUMNS[t].split()[0]}, {COLUMNS[t].split()[1]}) AS n FROM dirty_{t}) z
              WHERE {REASONS[t]} = '') AS b) x""" for t in FAULTS))(_verification)


def _dups(s, d):
    keys = {"order_items": ["order_id", "order_item_id"], "payments": ["order_id", "payment_sequential"], "reviews": ["review_id"]}
    parts = []
    for t, k in keys.items():
        df = dirty(s, d, t)
        whole = Q.duplicate_count(df).select(F.lit(t).alias("table"), "rows", F.col("duplicates").alias("repeated_rows"))
        parts.append(whole.crossJoin(F.broadcast(Q.duplicate_count(df, k).select(F.col("duplicates").alias("repeated_keys")))))  # one row
    return reduce(DataFrame.unionByName, parts)


register("dirty_duplicates", " UNION ALL ".join(f"""
SELECT '{t}' AS "table", CAST(count(*) AS BIGINT) AS "rows",
  CAST(count(*) - (SELECT count(*) FROM (SELECT DISTINCT * FROM dirty_{t}) z) AS BIGINT) AS repeated_rows,
  CAST(count(*) - (SELECT count(*) FROM (SELECT DISTINCT {k} FROM dirty_{t}) z) AS BIGINT) AS repeated_keys FROM dirty_{t}"""
    for t, k in {"order_items": "order_id, order_item_id", "payments": "order_id, payment_sequential", "reviews": "review_id"}.items()))(_dups)


def _fk(declared: bool):
    def run(s, d):
        c = clean(s, d)
        return Q.fk_report([(dirty(s, d, ct), ct, fk, c[pt], pt, pk) for ct, fk, pt, pk in CHILD_KEYS], null_is_orphan=not declared)
    return run


def _fk_sql(declared: bool) -> str:
    parts = []
    for ct, fk, pt, pk in CHILD_KEYS:
        orphans = f"count(*) FILTER (WHERE p._k IS NULL{f' AND c.{fk} IS NOT NULL' if declared else ''})"
        parts.append(f"""
SELECT '{ct}.{fk}' AS child, '{pt}.{pk}' AS parent, CAST({orphans} AS BIGINT) AS orphans, CAST(count(*) AS BIGINT) AS "rows",
  {O.pct(orphans, 'count(*)', 2)} AS orphan_pct
FROM dirty_{ct} c LEFT JOIN (SELECT DISTINCT {pk} AS _k FROM cl_{pt}) p ON c.{fk} = p._k""")
    return " UNION ALL ".join(parts)


register("dirty_fk_orphans_files", _fk_sql(False))(_fk(False))
register("dirty_fk_orphans_declared", _fk_sql(True))(_fk(True))

RULES = [("order_items", "price <= 0"), ("payments", "payment_value <= 0"), ("reviews", "review_score NOT BETWEEN 1 AND 5"),
         ("order_items", "seller_id IS NULL"), ("order_items", "order_id < 0")]
register("dirty_domain_violations", " UNION ALL ".join(
    f"SELECT '{t}' AS \"table\", '{r}' AS rule, CAST(count(*) FILTER (WHERE {r}) AS BIGINT) AS violations FROM dirty_{t}" for t, r in RULES))(
    lambda s, d: reduce(DataFrame.unionByName, [
        dirty(s, d, t).agg(F.lit(t).alias("table"), F.lit(r).alias("rule"), F.count_if(F.expr(r)).alias("violations")) for t, r in RULES]))

register("hash_sample_payments", """
SELECT CAST(order_id AS BIGINT) AS order_id, CAST(payment_sequential AS BIGINT) AS payment_sequential FROM (
  SELECT DISTINCT order_id, payment_sequential FROM raw_payments) t
ORDER BY md5(concat_ws('|', CAST(order_id AS VARCHAR), CAST(payment_sequential AS VARCHAR), '42')) LIMIT 200""")(
    lambda s, d: hash_sample(raw(s, d)["payments"].select("order_id", "payment_sequential").distinct(), 200, ["order_id", "payment_sequential"]))
