import datetime as dt
from decimal import Decimal

from feria.plans import clean as C
from feria.plans.marts import items_per_order, master, payments_summary

T = dt.datetime


def test_products_imputation_order(spark):
    prods = spark.createDataFrame([
        ("p1", "cama", 0.0, 10.0, 1.0, 1.0),     # zero weight -> category median
        ("p2", "cama", 300.0, 20.0, 1.0, 1.0),
        ("p3", "cama", 500.0, None, 1.0, 1.0),
        ("p4", "vazio", None, 5.0, 1.0, 1.0),    # all-null weights -> global median
        ("p5", None, None, 1.0, 1.0, 1.0),       # NULL category -> 'unknown'
    ], "product_id string, product_category_name string, product_weight_g double, "
       "product_length_cm double, product_height_cm double, product_width_cm double")
    trans = spark.createDataFrame([("cama", "bed"), (None, "x")],
                                  "product_category_name string, "
                                  "product_category_name_english string")
    out = {r.product_id: r for r in C.clean_products(prods, trans).collect()}
    assert out["p1"].product_weight_g == 400.0
    assert out["p4"].product_weight_g == 400.0        # global median of 300, 500
    assert out["p5"].product_category_name == "unknown"
    assert out["p5"].product_category_name_english == "unknown"
    assert out["p4"].product_category_name_english == "vazio"   # falls back to the key
    assert out["p1"].product_category_name_english == "bed"
    assert out["p3"].product_length_cm == 15.0


def test_payments_keep_strictly_positive(spark):
    pay = spark.createDataFrame([
        ("o1", 1, " Credit_Card ", 1, Decimal("10.00")), ("o1", 2, "voucher", 1, Decimal("0.00")),
        ("o2", 1, "boleto", 1, Decimal("-1.00")), ("o3", 1, "boleto", 1, None)],
        "order_id string, payment_sequential int, payment_type string, "
        "payment_installments int, payment_value decimal(10,2)")
    out = C.clean_payments(pay).collect()
    assert [(r.order_id, r.payment_type) for r in out] == [("o1", "credit_card")]


def test_payment_summary_primary_type_first_arrival(spark):
    pay = spark.createDataFrame([
        ("o1", 1, "card", 2, Decimal("10.00")), ("o1", 2, "voucher", 5, Decimal("10.00")),
        ("o1", 3, "card", 1, Decimal("1.00"))],
        "order_id string, payment_sequential int, payment_type string, "
        "payment_installments int, payment_value decimal(10,2)")
    r = payments_summary(pay).first()
    assert (r.total_payment, r.payment_installments, r.payment_methods_count,
            r.primary_payment_type) == (Decimal("21.00"), 5, 2, "card")


def test_reviews_flags_and_dedup(spark):
    rev = spark.createDataFrame([
        ("r1", "o1", 1, None, None, "2020-01-01", "2020-01-02 10:00:00"),
        ("r2", "o1", 5, None, "", "2020-01-01", "2020-01-03 10:00:00"),
        ("r3", "o2", 3, None, " ", "2020-01-01", None),
        ("r4", "o3", None, None, "ok", "2020-01-01", "2020-01-01 00:00:00")],
        "review_id string, order_id string, review_score int, review_comment_title string, "
        "review_comment_message string, review_creation_date string, "
        "review_answer_timestamp string")
    out = {r.order_id: r for r in C.clean_reviews(rev).collect()}
    assert out["o1"].review_id == "r2" and out["o1"].has_comment == 0
    assert out["o1"].review_comment_title == ""
    assert out["o2"].has_comment == 1
    assert out["o3"].is_negative == 0 and out["o3"].has_comment == 1


def test_orders_derived_columns(spark):
    orders = spark.createDataFrame([
        ("o1", "c1", "delivered", "2020-01-01 00:00:00", None, None, "2020-01-01 12:00:00",
         "2020-01-02 00:00:00"),
        ("o2", "c1", "delivered", "2020-01-02 12:00:00", None, None, "2020-01-02 00:00:00",
         "2020-01-01 00:00:00"),
        ("o3", "c2", None, "bad text", None, None, None, None)],
        "order_id string, customer_id string, order_status string, "
        "order_purchase_timestamp string, order_approved_at string, "
        "order_delivered_carrier_date string, order_delivered_customer_date string, "
        "order_estimated_delivery_date string")
    items = spark.createDataFrame([("o1",), ("o1",)], "order_id string")
    out = {r.order_id: r for r in C.clean_orders(orders, items).collect()}
    assert (out["o1"].delivery_time_days, out["o1"].delay_days, out["o1"].has_items) == (0, -1, 1)
    assert out["o2"].delivery_time_days is None and out["o2"].delay_days == 1
    assert out["o3"].is_delivered == 0 and out["o3"].order_yearmonth is None
    assert out["o3"].has_items == 0 and out["o1"].order_yearmonth == "2020-01"


def test_geolocation_box_edges_and_mode(spark):
    geo = spark.createDataFrame([
        (1, -33.7, -73.9, "São Paulo", "SP"), (1, 5.3, -28.8, "sao paulo", "SP"),
        (1, -10.0, -50.0, "Campinas", "SP"), (1, 6.0, -50.0, "x", "SP"),
        (None, 0.0, -40.0, "y", "RJ")],
        "geolocation_zip_code_prefix int, geolocation_lat double, geolocation_lng double, "
        "geolocation_city string, geolocation_state string")
    rows = C.clean_geolocation(geo).collect()
    assert len(rows) == 1
    r = rows[0]
    assert (r.geolocation_lat, r.geolocation_lng) == (-10.0, -50.0)
    assert r.geolocation_city == "sao paulo"


def test_master_grain_and_join(spark):
    from feria.registry import clean
    c = clean(spark, "/root/testdata/sf0.001")
    m = master(c)
    n_orders_with_items = c["orders"].where("has_items = 1").count()
    assert m.count() == n_orders_with_items
    assert m.select("order_id").distinct().count() == n_orders_with_items
    ipo = items_per_order(c["order_items"])
    assert ipo.count() == n_orders_with_items


def test_products_nan_sizes_are_missing(spark):
    prods = spark.createDataFrame([
        ("p1", "cama", float("nan"), 1.0, 1.0, 1.0), ("p2", "cama", 300.0, 1.0, 1.0, 1.0),
        ("p3", "cama", 500.0, 1.0, 1.0, 1.0)],
        "product_id string, product_category_name string, product_weight_g double, "
        "product_length_cm double, product_height_cm double, product_width_cm double")
    trans = spark.createDataFrame([], "product_category_name string, "
                                      "product_category_name_english string")
    out = {r.product_id: r.product_weight_g for r in C.clean_products(prods, trans).collect()}
    assert out == {"p1": 400.0, "p2": 300.0, "p3": 500.0}
