import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from feria.plans import warehouse as W


def test_customers_load_keeps_city_and_state(spark):
    c = spark.createDataFrame([("c1", "u1", 1000, "sao paulo", "SP")],
                              "customer_id string, customer_unique_id string, "
                              "customer_zip_code_prefix int, customer_city string, "
                              "customer_state string")
    r = W.project_to_star("dim_customers", c).first()
    assert (r.city, r.state, r.zip_code_prefix) == ("sao paulo", "SP", 1000)


def test_missing_required_column_raises(spark):
    c = spark.createDataFrame([("c1", 1000)], "customer_id string, customer_zip_code_prefix int")
    with pytest.raises(W.MissingColumnError):
        W.project_to_star("dim_customers", c)


def test_review_rejects_and_key_dedup(spark, tmp_dir):
    t = dt.datetime
    rev = spark.createDataFrame([
        ("r1", "o1", 0, 1, 0, "", "", t(2020, 1, 1), t(2020, 1, 1)),
        ("r2", "o2", 6, 0, 0, "", "", t(2020, 1, 1), t(2020, 1, 1)),
        ("r3", "o3", None, 0, 0, "", "", t(2020, 1, 1), t(2020, 1, 1)),
        ("r4", "o4", 4, 0, 0, "", "", t(2020, 1, 1), t(2020, 1, 2)),
        ("r4", "o5", 5, 0, 0, "", "", t(2020, 1, 1), t(2020, 1, 3)),
    ], "review_id string, order_id string, review_score int, is_negative int, "
       "has_comment int, review_comment_title string, review_comment_message string, "
       "review_creation_date timestamp_ntz, review_answer_timestamp timestamp_ntz")
    st = W.build_table("fact_reviews", rev)
    assert st.rejects.count() == 3
    rows = st.rows.collect()
    assert [(r.review_id, r.order_id) for r in rows] == [("r4", "o5")]   # newest answer first
    n, nbad, ndup = W.load_table(spark, "fact_reviews", rev, tmp_dir)
    assert (n, nbad, ndup) == (1, 3, 1)
    assert spark.read.parquet(f"{tmp_dir}/fact_reviews").count() == 1
    assert spark.read.parquet(f"{tmp_dir}/_rejects/fact_reviews").count() == 3


def test_default_only_when_column_absent(spark):
    items = spark.createDataFrame([("o1", 1, "p", "s", None, Decimal("1.00"), None)],
                                  "order_id string, order_item_id int, product_id string, "
                                  "seller_id string, shipping_limit_date timestamp_ntz, "
                                  "price decimal(10,2), freight_value decimal(10,2)")
    st = W.build_table("fact_order_items", items.withColumn("total_item_value", F.col("price")))
    assert st.rejects.count() == 1          # explicit NULL freight is not defaulted
    st2 = W.build_table("fact_order_items", items.drop("freight_value")
                        .withColumn("total_item_value", F.col("price")))
    assert st2.rows.first().freight_value == Decimal("0.00")


def test_full_star_load_sf0001(spark, tmp_dir):
    from feria.registry import clean
    status = W.load_star(spark, clean(spark, "/root/testdata/sf0.001"), tmp_dir)
    rows = {r.table: r for r in status.collect()}
    assert all(r.error is None for r in rows.values()), rows
    assert rows["fact_orders"].rows == spark.read.parquet(f"{tmp_dir}/fact_orders").count()
    pay = spark.read.parquet(f"{tmp_dir}/fact_payments")
    assert pay.select("payment_id").distinct().count() == pay.count()


def test_loaded_star_answers_like_lazy_star(spark, tmp_dir):
    """Q1-Q5 and the KPI row over the written (year-partitioned) star equal
    the same queries over the lazy plan."""
    from feria.plans import analytics as A
    from feria.plans import dashboard as D
    from feria.registry import clean, normalize_output, star
    sf = "/root/testdata/sf0.001"
    W.load_star(spark, clean(spark, sf), tmp_dir, partition_orders_by_year=True)
    loaded = W.read_star(spark, tmp_dir)
    lazy = star(spark, sf)
    for q in (A.q1_monthly_volume, A.q2_top_categories, A.q3_delivery_by_state,
              A.q4_incident_rates, A.q5_seller_quality, D.kpi_row, D.seller_scatter):
        a = sorted(map(tuple, normalize_output(q(loaded)).collect()), key=repr)
        b = sorted(map(tuple, normalize_output(q(lazy)).collect()), key=repr)
        assert a == b, q.__name__


PAYMENTS = ("order_id string, payment_sequential int, payment_type string, "
            "payment_installments int, payment_value decimal(12,2)")


def test_values_beyond_their_type_are_rejected(spark, tmp_dir):
    rows = [("o1", 1, "card", 1, Decimal("5.00")), ("o2", 70000, "card", 1, Decimal("5.00")),
            ("o3", 1, "card", 1, Decimal("123456789.00"))]
    df = spark.createDataFrame(rows, PAYMENTS)
    assert W.load_table(spark, "fact_payments", df, tmp_dir) == (1, 2, 0)
    reasons = {r.order_id: r.reason for r in spark.read.parquet(f"{tmp_dir}/_rejects/fact_payments").collect()}
    assert reasons["o2"].startswith("payment_sequential does not fit smallint")
    assert reasons["o3"].startswith("payment_value does not fit decimal(10,2)")
    # rejects of an earlier load do not outlive a clean one
    assert W.load_table(spark, "fact_payments", df.limit(1), tmp_dir) == (1, 0, 0)
    assert spark.read.parquet(f"{tmp_dir}/_rejects/fact_payments").count() == 0


def test_payment_key_depends_on_the_row_alone(spark):
    rows = [("o1", 1, "card", 1, Decimal("5.00"))] * 2 + [("o1", 2, "card", 1, Decimal("5.00"))]
    df = spark.createDataFrame(rows, PAYMENTS)
    a = sorted(r.payment_id for r in W.build_table("fact_payments", df).rows.collect())
    b = sorted(r.payment_id for r in W.build_table("fact_payments", df.repartition(3)).rows.collect())
    assert a == b and len(set(a)) == 3


def test_star_follows_its_input(spark, tmp_dir):
    """Doubling a driver table between two queries leaves no repeated key."""
    import os
    import shutil

    from feria.registry import QUERIES
    sf = os.path.join(tmp_dir, "sf")
    shutil.copytree("/root/testdata/sf0.001", sf)
    os.chmod(sf, 0o755)

    def duplicates():
        return {r["table"]: r["duplicates"] for r in QUERIES["star_key_duplicates"](spark, sf).collect()}
    assert set(duplicates().values()) == {0}
    supplier = spark.read.parquet("/root/testdata/sf0.001/supplier.parquet")
    supplier.union(supplier).write.parquet(os.path.join(sf, "twice"))
    os.chmod(os.path.join(sf, "supplier.parquet"), 0o644)
    os.replace(os.path.join(sf, "supplier.parquet"), os.path.join(sf, "once"))
    os.replace(os.path.join(sf, "twice"), os.path.join(sf, "supplier.parquet"))
    assert set(duplicates().values()) == {0}


def test_planning_runs_no_data_job(spark):
    """Building a query starts no job but those that read Parquet footers."""
    from feria.registry import QUERIES
    tracker = spark.sparkContext.statusTracker()
    for name in ("q1_monthly_volume", "q5_seller_quality", "clean_products", "describe_price"):
        spark.sparkContext.setJobGroup(name, name)
        QUERIES[name](spark, "/root/testdata/sf0.001")
        jobs = tracker.getJobIdsForGroup(name)
        assert len(jobs) <= 9, (name, len(jobs))  # at most one for each raw table
        assert all(len(tracker.getJobInfo(j).stageIds) == 1 for j in jobs), name
    spark.sparkContext.setJobGroup("", "")


def test_items_move_once(spark):
    """The rows are dealt by their key unsorted, and the first of a key is found
    where they lie, though the key's type changes."""
    from feria.registry import star
    plan = star(spark, "/root/testdata/sf0.001")["fact_order_items"]._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange ") == 1, plan
    assert "Sort" not in plan[plan.index("Exchange "):], plan


def test_a_key_beyond_its_type_is_rejected(spark):
    """Keys grouped by the type they came in, and the texts of several rules."""
    rows = [(1, 1, 7, 8, "5.00", "1.00"), (1, 1, 6, 8, "4.00", "1.00"), (1, 70000, 7, 8, "5.00", "1.00"), (1, 4464, 7, 8, "3.00", "1.00"), (None, 2, 7, 8, None, "1.00")]
    items = spark.createDataFrame(rows, "order_id long, order_item_id int, product_id long, seller_id long, price string, freight_value string").selectExpr(
        "* EXCEPT (price, freight_value)", "timestamp_ntz'2020-01-01' AS shipping_limit_date", "CAST(price AS decimal(10,2)) AS price",
        "CAST(freight_value AS decimal(10,2)) AS freight_value", "CAST(price AS decimal(10,2)) AS total_item_value")
    got = W.build_table("fact_order_items", items)
    assert dict(got.rows.dtypes)["order_item_id"] == "smallint"
    assert sorted((r.order_id, r.order_item_id, r.product_id) for r in got.rows.collect()) == [(1, 1, 6), (1, 4464, 7)]
    assert sorted(r.reason for r in got.rejects.collect()) == [
        "order_id is null; price is null", "order_item_id does not fit smallint; order_item_id is null"]
