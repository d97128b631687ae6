"""Facts bucketed by order: the same answers, no exchange on the order."""

import os
import re

import pytest

from feria.plans import analytics as A
from feria.plans import colocated as C
from feria.plans import dashboard as D
from feria.registry import SAMPLE_FILTER, normalize_output
from feria.registry import star as lazy

SF = "/root/testdata/sf0.001"
QUESTIONS = {"q1": A.q1_monthly_volume, "q2": A.q2_top_categories, "q3": A.q3_delivery_by_state, "q4": A.q4_incident_rates, "q5": A.q5_seller_quality,
             "kpi": D.kpi_row, "kpi_by_order": D.kpi_row_by_order, "kpi_filtered": lambda s: D.kpi_row(s, SAMPLE_FILTER), "monthly": D.monthly,
             "monthly_by_order": D.monthly_by_order, "incidents": lambda s: D.incident_split(s, SAMPLE_FILTER), "scores": D.score_distribution,
             "sellers": D.seller_scatter}
ON_ORDERS = ["q4", "q5", "kpi", "kpi_by_order", "kpi_filtered", "monthly", "monthly_by_order", "incidents", "scores", "sellers"]


@pytest.fixture(scope="module")
def path(spark, tmp_path_factory):
    out = str(tmp_path_factory.mktemp("colocated") / "star")
    C.write_colocated(spark, lazy(spark, SF), out, buckets=8)
    return out


@pytest.fixture()
def star(spark, path):
    return C.open_colocated(spark, path)


@pytest.mark.parametrize("name", QUESTIONS)
def test_same_answers(spark, star, name):
    want, got = (normalize_output(QUESTIONS[name](s)) for s in (lazy(spark, SF), star))
    assert got.columns == want.columns and sorted(map(tuple, got.collect()), key=repr) == sorted(map(tuple, want.collect()), key=repr)


@pytest.mark.parametrize("name", ON_ORDERS)
def test_joins_on_the_order_need_no_exchange(spark, star, name):
    """With broadcasts off, so that nothing but the buckets can spare one."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        plan = QUESTIONS[name](star)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert re.search(r"SelectedBucketsCount|Bucketed: true", plan)
    assert not re.search(r"Exchange hashpartitioning\((seller_id#\d+L?, )?order_id", plan), plan


def test_one_sorted_file_a_bucket(spark, star, path):
    for t in C.FACTS:
        assert len([f for f in os.listdir(os.path.join(path, t)) if f.endswith(".parquet")]) <= 8
    assert star["fact_orders"].where("NOT _customer").count() == 0


def test_another_session_opens_the_folder(spark, path):
    want = C.open_colocated(spark, path)["fact_orders"].count()
    C.close_colocated(spark, path)
    assert C.open_colocated(spark, path)["fact_orders"].count() == want


def test_orders_without_a_customer_stay_but_are_not_shown(spark, tmp_path):
    s = dict(lazy(spark, SF).items())
    s["dim_customers"] = s["dim_customers"].where("customer_id % 3 <> 0")
    out = C.write_colocated(spark, s, str(tmp_path / "star"), buckets=4)
    assert out["fact_orders"].count() == s["fact_orders"].count()
    assert D.kpi_row(out).collect() == D.kpi_row(s).collect() and A.q4_incident_rates(out).collect() == A.q4_incident_rates(s).collect()
    C.close_colocated(spark, str(tmp_path / "star"))
