import datetime as dt
from decimal import Decimal

from feria.plans import analytics as A
from feria.plans import dashboard as D

T = dt.datetime


def small_star(spark):
    orders = spark.createDataFrame([
        ("o1", "c1", "delivered", 1, 1, 10, 2, 2018, "2018-01"),
        ("o2", "c2", "canceled", 0, 1, None, None, 2018, "2018-01"),
        ("o3", "c3", "delivered", 1, 1, 5, -3, None, None),
        ("o4", "c1", "delivered", 1, 1, 7, 0, 2017, "2017-12"),
    ], "order_id string, customer_id string, order_status string, is_delivered int, "
       "has_items int, delivery_time_days int, delay_days int, order_year int, "
       "order_yearmonth string")
    customers = spark.createDataFrame([("c1", "u1", "SP"), ("c2", "u2", "R'J"),
                                       ("c3", "u3", "MG")],
                                      "customer_id string, customer_unique_id string, "
                                      "state string")
    payments = spark.createDataFrame([("o1", Decimal("10.00")), ("o1", Decimal("20.00")),
                                      ("o1", Decimal("30.00")), ("o2", Decimal("5.00"))],
                                     "order_id string, payment_value decimal(10,2)")
    reviews = spark.createDataFrame([("o1", 5, 0), ("o2", 1, 1)],
                                    "order_id string, review_score int, is_negative int")
    items = spark.createDataFrame([("o1", "s1", Decimal("10.00")), ("o1", "s1", Decimal("5.00")),
                                   ("o4", "s1", Decimal("1.00")), ("o4", "s2", Decimal("2.00"))],
                                  "order_id string, seller_id string, price decimal(10,2)")
    sellers = spark.createDataFrame([("s1", "city", "SP"), ("s2", "c", "PR")],
                                    "seller_id string, city string, state string")
    return {"fact_orders": orders, "dim_customers": customers, "fact_payments": payments,
            "fact_reviews": reviews, "fact_order_items": items, "dim_sellers": sellers}


def test_kpi_written_vs_by_order(spark):
    st = small_star(spark)
    w = D.kpi_row(st).first()
    b = D.kpi_row_by_order(st).first()
    assert (w.total_orders, w.total_revenue, w.unique_buyers) == (3, 65.0, 2)
    # written form: o1 counts three times (one row per payment)
    assert w.avg_delivery_days == 9.3 and b.avg_delivery_days == 8.5
    assert w.cancel_rate == 20.0 and b.cancel_rate == 33.33
    assert w.avg_review == 4.0 and b.avg_review == 3.0


def test_filters_quote_empty_and_null_year(spark):
    st = small_star(spark)
    r = D.kpi_row(st, D.Filters(states=("R'J",))).first()
    assert r.total_orders == 1
    r = D.kpi_row(st, D.Filters(years=(2018, 2018))).first()
    assert r.total_orders == 2
    assert D.kpi_row(st, D.Filters()).first().total_orders == 3   # NULL year dropped


def test_incident_split_overlap_counts_once(spark):
    st = small_star(spark)
    r = D.incident_split(st).first()
    # o2 is canceled AND negatively reviewed: two categories, one incident
    assert (r.canceled, r.late, r.negative_reviews, r.no_incident, r.total) == (1, 1, 1, 1, 3)


def test_q5_seller_without_review_sorts_first(spark):
    st = small_star(spark)
    st["fact_reviews"] = st["fact_reviews"].where("order_id <> 'o1'")
    q = A.q5_seller_quality(st, min_orders=1).collect()
    assert q[0].avg_review_score is None


def test_peak_month_first_max(spark):
    m = spark.createDataFrame([("2018-01", 5), ("2017-12", 5), ("2017-11", 1)],
                              "order_yearmonth string, total_orders int")
    assert D.peak_month(m).first().order_yearmonth == "2017-12"


def test_top_sellers_table_format(spark):
    sc = spark.createDataFrame([("abcdefghijk", 3, 1234567.0, 4.5, 10.0)],
                               "seller_id string, orders int, revenue double, "
                               "avg_score double, late_pct double")
    r = D.top_sellers_table(sc).first()
    assert (r.seller, r.revenue_brl) == ("abcdefgh…", "R$ 1,234,567")
