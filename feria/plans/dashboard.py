"""Dashboard queries: global filters, KPI row, filtered Q1-Q5 variants,
review-score distribution, filter choice lists and the top-seller table.

Filters are Column predicates (``between`` / ``isin``), never spliced text,
so values holding quotes are safe. An empty choice means "all". The year
range always applies, as on the dashboard: when no range is given the
full range of years is used, which drops orders whose year is NULL.

Two grains are offered where the dashboard joins N payments per order
before aggregating:

* the *written* form (``kpi_row``, ``monthly``) reproduces those numbers,
  where counts and averages are weighted by payment rows;
* the ``*_by_order`` form pre-aggregates payments per order first, so every
  order counts once.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from feria.functions import mean_round, money_mean_round, money_round, pct, ratio_round
from feria.operators.aggregates import weighted_median
from feria.plans.analytics import Star, days_by_state, seller_orders, seller_sums

# Year range used when the data holds no year at all.
DEFAULT_YEARS = (2016, 2018)


@dataclass(frozen=True)
class Filters:
    years: tuple[int, int] | None = None        # inclusive; None = every non-NULL year
    states: tuple[str, ...] = field(default_factory=tuple)    # customer states; () = all
    statuses: tuple[str, ...] = field(default_factory=tuple)  # order statuses; () = all

    def predicate(self) -> Column:
        """Predicate over columns ``order_year``, ``state``, ``order_status``."""
        conds = [F.col("order_year").between(*self.years) if self.years
                 else F.col("order_year").isNotNull()]
        if self.states:
            conds.append(F.col("state").isin(*self.states))
        if self.statuses:
            conds.append(F.col("order_status").isin(*self.statuses))
        return reduce(lambda a, b: a & b, conds)


def filtered_orders(star: Star, flt: Filters, cols: list[str]) -> DataFrame:
    """Orders joined to their customer's state, filtered; ``cols`` from the
    order fact are kept (plus customer_unique_id / state when asked). An order
    fact that carries its customer (``colocated``) needs no join."""
    o = star["fact_orders"]
    c = star["dim_customers"].select("customer_id", "customer_unique_id", "state")
    keep = list(dict.fromkeys(["order_id", "customer_id", "order_year", "order_status"] + cols))
    if "_customer" in o.columns:
        return (o.where("_customer").select(*[x for x in keep if x in o.columns], F.col("_buyer").alias("customer_unique_id"),
                                            F.col("_state").alias("state")).where(flt.predicate()))
    return o.select(*[x for x in keep if x in o.columns]).join(c, "customer_id") \
        .where(flt.predicate())


def _payments_per_order(star: Star) -> DataFrame:
    return star["fact_payments"].groupBy("order_id").agg(
        F.sum("payment_value").alias("payment_value"))


# -------------------------------------------------------------------- KPIs
def kpi_row(star: Star, flt: Filters = Filters()) -> DataFrame:
    """Six headline metrics as written: orders joined to every payment row."""
    o = filtered_orders(star, flt, ["delivery_time_days"])
    p = star["fact_payments"].select("order_id", "payment_value")
    r = star["fact_reviews"].select("order_id", "review_score")
    j = o.join(p, "order_id", "left").join(r, "order_id", "left")
    return _kpis(j)


def kpi_row_by_order(star: Star, flt: Filters = Filters()) -> DataFrame:
    """Same metrics with payments summed per order first (one row per order)."""
    o = filtered_orders(star, flt, ["delivery_time_days"])
    r = star["fact_reviews"].select("order_id", "review_score")
    j = o.join(_payments_per_order(star), "order_id", "left").join(r, "order_id", "left")
    return _kpis(j)


def kpi_cards(kpi: DataFrame) -> DataFrame:
    """The KPI row as display text; a missing metric shows as 0."""
    z = lambda c: F.coalesce(F.col(c), F.lit(0))
    return kpi.select(
        F.format_number(z("total_orders"), 0).alias("total_orders"),
        F.concat(F.lit("R$ "), F.format_number(z("total_revenue"), 0)).alias("total_revenue"),
        F.format_number(z("unique_buyers"), 0).alias("unique_buyers"),
        F.concat(F.format_string("%.1f", z("avg_delivery_days").cast("double")),
                 F.lit(" days")).alias("avg_delivery"),
        F.concat(F.format_string("%.2f", z("cancel_rate").cast("double")), F.lit("%"))
        .alias("cancel_rate"),
        F.format_string("%.2f", z("avg_review").cast("double")).alias("avg_review"))


def _kpis(j: DataFrame) -> DataFrame:
    n = F.count(F.lit(1))
    return j.agg(
        F.count_distinct("order_id").alias("total_orders"),
        money_round(F.sum("payment_value"), 0).alias("total_revenue"),
        F.count_distinct("customer_unique_id").alias("unique_buyers"),
        mean_round("delivery_time_days", 1).alias("avg_delivery_days"),
        pct(F.count_if(F.col("order_status") == "canceled"), n, 2).alias("cancel_rate"),
        mean_round("review_score", 2).alias("avg_review"))


# ------------------------------------------------------------ monthly (Q1)
def monthly(star: Star, flt: Filters = Filters()) -> DataFrame:
    """Orders, delivered and revenue per month; order x payment rows."""
    o = filtered_orders(star, flt, ["order_yearmonth", "is_delivered"])
    p = star["fact_payments"].select("order_id", "payment_value")
    return _monthly(o.join(p, "order_id", "left"))


def monthly_by_order(star: Star, flt: Filters = Filters()) -> DataFrame:
    o = filtered_orders(star, flt, ["order_yearmonth", "is_delivered"])
    return _monthly(o.join(_payments_per_order(star), "order_id", "left"))


def _monthly(j: DataFrame) -> DataFrame:
    return (j.where(F.col("order_yearmonth").isNotNull())
            .groupBy("order_yearmonth")
            .agg(F.count(F.lit(1)).alias("total_orders"),
                 F.count_if(F.col("is_delivered") == 1).alias("delivered"),
                 money_round(F.sum("payment_value"), 0).alias("revenue"))
            .orderBy("order_yearmonth"))


def peak_month(monthly_df: DataFrame) -> DataFrame:
    """The month with most orders; the earliest month wins a tie."""
    return monthly_df.orderBy(F.col("total_orders").desc(), F.col("order_yearmonth").asc()) \
        .limit(1)


# ---------------------------------------------------------- categories (Q2)
def top_categories(star: Star, flt: Filters = Filters(), k: int = 10) -> DataFrame:
    oi = star["fact_order_items"].select("order_id", "product_id", "price")
    p = star["dim_products"].select("product_id", "category_name_en") \
        .where(F.col("category_name_en").isNotNull())
    o = filtered_orders(star, flt, [])
    j = oi.join(p, "product_id").join(o.select("order_id"), "order_id")
    return (j.groupBy("category_name_en")
            .agg(F.count_distinct("order_id").alias("orders"),
                 money_round(F.sum("price"), 0).alias("revenue"),
                 money_mean_round("price", 2).alias("avg_price"),
                 F.count(F.lit(1)).alias("items_sold"))
            .withColumnRenamed("category_name_en", "category")
            .orderBy(F.col("revenue").desc_nulls_first(), F.col("category").asc())
            .limit(k))


# ------------------------------------------------------- delivery time (Q3)
def delivery_by_state(star: Star, flt: Filters = Filters(), min_orders: int = 10) -> DataFrame:
    o = filtered_orders(star, flt, ["is_delivered", "delivery_time_days", "delay_days"])
    rows = o.where((F.col("is_delivered") == 1) & F.col("delivery_time_days").isNotNull())
    return (days_by_state(rows).groupBy("state")
            .agg(F.sum("_n").alias("orders"),
                 ratio_round(F.sum("_days"), F.sum("_n_days"), 1).alias("avg_days"),
                 F.round(weighted_median("delivery_time_days", "_n_days"), 1).alias("median_days"),
                 ratio_round(F.sum("_delay"), F.sum("_n_delay"), 1).alias("avg_delay"),
                 pct(F.sum("_late"), F.sum("_n"), 1).alias("late_pct"))
            .where(F.col("orders") >= min_orders)
            .orderBy(F.col("avg_days").desc_nulls_first(), F.col("state").asc_nulls_last()))


def delivery_top(df: DataFrame, n: int = 15) -> DataFrame:
    """The first ``n`` rows of the delivery table (already sorted)."""
    return df.limit(n)


# ------------------------------------------------------------ incidents (Q4)
def incident_split(star: Star, flt: Filters = Filters()) -> DataFrame:
    """Canceled, late and negative-review counts (overlapping), orders with
    no incident at all (exclusive) and the total."""
    o = filtered_orders(star, flt, ["delay_days"])
    r = star["fact_reviews"].select("order_id", "is_negative")
    j = o.join(r, "order_id", "left").select(
        F.when(F.col("order_status") == "canceled", 1).otherwise(0).alias("c"),
        F.when(F.col("delay_days") > 0, 1).otherwise(0).alias("l"),
        F.coalesce(F.col("is_negative").cast("int"), F.lit(0)).alias("n"))
    return j.agg(F.sum("c").alias("canceled"), F.sum("l").alias("late"),
                 F.sum("n").alias("negative_reviews"),
                 (F.count(F.lit(1)) - F.sum(F.greatest("c", "l", "n"))).alias("no_incident"),
                 F.count(F.lit(1)).alias("total"))


def score_distribution(star: Star, flt: Filters = Filters()) -> DataFrame:
    """Reviews per score with the share of all filtered reviews; the share
    is a window over the 5 grouped rows, never over raw rows."""
    o = filtered_orders(star, flt, [])
    r = star["fact_reviews"].select("order_id", "review_score")
    g = (r.join(o.select("order_id"), "order_id")
         .groupBy("review_score").agg(F.count(F.lit(1)).alias("total")))
    share = pct(F.col("total"), F.sum("total").over(Window.partitionBy()), 1)
    return g.withColumn("pct", share).orderBy("review_score")


# --------------------------------------------------------------- sellers (Q5)
def _seller_rows(star: Star, flt: Filters) -> DataFrame:
    o = filtered_orders(star, flt, ["is_delivered", "delivery_time_days", "delay_days"]) \
        .where(F.col("is_delivered") == 1)
    return seller_orders(star, o.select("order_id", "delivery_time_days", "delay_days"))


def _seller_table(star: Star, sums: DataFrame, min_orders: int) -> DataFrame:
    """The seller dimension joins the per-seller sums."""
    s = star["dim_sellers"].select("seller_id", F.col("state").alias("seller_state"))
    return (sums.where(F.col("_orders") >= min_orders).join(s, "seller_id")
            .select("seller_id", "seller_state", F.col("_orders").alias("orders"),
                    money_round("_revenue", 0).alias("revenue"),
                    ratio_round("_score", "_scores", 2).alias("avg_score"),
                    pct("_negative", "_orders", 1).alias("negative_pct"),
                    ratio_round("_days", "_n_days", 1).alias("avg_delivery_days"),
                    pct("_late", "_orders", 1).alias("late_pct"))
            .orderBy(F.col("avg_score").desc_nulls_first(), F.col("revenue").desc_nulls_first(),
                     F.col("seller_id").asc()))


def seller_scatter(star: Star, flt: Filters = Filters(), min_orders: int = 30) -> DataFrame:
    """Seller quality vs volume as written: item-row weighted averages and
    counts, distinct orders in the denominators."""
    return _seller_table(star, seller_sums(_seller_rows(star, flt), F.col("_items")), min_orders)


def seller_scatter_by_order(star: Star, flt: Filters = Filters(),
                            min_orders: int = 30) -> DataFrame:
    """Grain-correct variant: every order weighs once in averages and counts,
    so percentages stay within 0-100."""
    return _seller_table(star, seller_sums(_seller_rows(star, flt), F.lit(1)), min_orders)


def top_sellers_table(scatter: DataFrame, n: int = 10) -> DataFrame:
    """Display table of the first ``n`` sellers: shortened id, orders,
    revenue as 'R$ 1,234', score, late %."""
    return scatter.limit(n).select(
        F.concat(F.substring(F.col("seller_id").cast("string"), 1, 8), F.lit("…"))
        .alias("seller"),
        "orders",
        F.concat(F.lit("R$ "), F.format_number("revenue", 0)).alias("revenue_brl"),
        F.col("avg_score").alias("score"),
        "late_pct")


# ------------------------------------------------------------ filter choices
def filter_choices(star: Star) -> DataFrame:
    """Sorted choice lists as (choice, value) rows: years, customer states,
    order statuses."""
    o, c = star["fact_orders"], star["dim_customers"]
    years = (o.where(F.col("order_year").isNotNull())
             .select(F.lit("year").alias("choice"), F.col("order_year").cast("string")
                     .alias("value")).distinct())
    states = (c.where(F.col("state").isNotNull())
              .select(F.lit("state").alias("choice"), F.col("state").alias("value")).distinct())
    statuses = o.select(F.lit("status").alias("choice"), F.col("order_status").alias("value")) \
        .distinct()
    return years.unionByName(states).unionByName(statuses).orderBy("choice", "value")


def year_bounds(star: Star) -> DataFrame:
    """(min, max) order year for the range slider; the fixed default range
    when no order has a year."""
    o = star["fact_orders"]
    return o.agg(F.coalesce(F.min("order_year").cast("int"), F.lit(DEFAULT_YEARS[0]))
                 .alias("min_year"),
                 F.coalesce(F.max("order_year").cast("int"), F.lit(DEFAULT_YEARS[1]))
                 .alias("max_year"))
