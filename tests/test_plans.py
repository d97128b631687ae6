"""Plan checks: pushdown, top-k operator, no cartesian products."""

import pytest

SF = "/root/testdata/sf0.001"


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def star(spark):
    from feria.registry import star as build
    return build(spark, SF)


def test_topk_is_take_ordered(star):
    from feria.plans import analytics as A
    for q in (A.q2_top_categories(star), A.q5_seller_quality(star)):
        assert "TakeOrderedAndProject" in plan_of(q)


def test_delivered_filter_reaches_scan(spark, tmp_dir):
    from feria.plans import analytics as A
    from feria.plans.warehouse import load_star, read_star
    from feria.registry import clean
    load_star(spark, clean(spark, SF), tmp_dir)
    p = plan_of(A.q5_seller_quality(read_star(spark, tmp_dir)))
    assert "EqualTo(is_delivered,1)" in p
    assert "ReadSchema: struct<order_id:bigint,seller_id:bigint,price:decimal(10,2)>" in p


def test_no_cartesian_product_in_registered_queries(spark):
    from feria.registry import QUERIES
    for name in ("q1_monthly_volume", "q5_seller_quality", "kpi_row", "master",
                 "clean_products", "histogram_price_p99", "score_distribution"):
        assert "CartesianProduct" not in plan_of(QUERIES[name](spark, SF)), name


def test_nation_is_broadcast(spark):
    from feria.sources.bindings import raw_customers
    assert "BroadcastHashJoin" in plan_of(raw_customers(spark, SF))
