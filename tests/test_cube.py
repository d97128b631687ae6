"""The cube's answers against the scans, for many choices."""

import re

import pytest

from feria.plans import cube as C
from feria.plans import dashboard as D
from feria.registry import SAMPLE_FILTER, normalize_output
from feria.registry import star as build

SF = "/root/testdata/sf0.001"
PAIRS = {"kpi_row": (C.kpi_row, D.kpi_row), "kpi_row_by_order": (C.kpi_row_by_order, D.kpi_row_by_order), "monthly": (C.monthly, D.monthly),
         "monthly_by_order": (C.monthly_by_order, D.monthly_by_order), "scores": (C.score_distribution, D.score_distribution),
         "incidents": (C.incident_split, D.incident_split), "categories": (C.top_categories, D.top_categories)}
CHOICES = [D.Filters(), SAMPLE_FILTER, D.Filters(years=(1995, 1997)), D.Filters(states=("NB", "NC")), D.Filters(statuses=("canceled",)),
           D.Filters(years=(2050, 2051)), D.Filters(years=(1994, 1999), states=("NB",), statuses=("delivered", "shipped"))]


@pytest.fixture(scope="module")
def star(spark):
    return {k: v.cache() for k, v in build(spark, SF).items()}


@pytest.fixture(scope="module")
def path(spark, star, tmp_path_factory):
    out = str(tmp_path_factory.mktemp("cube"))
    C.write_cube(spark, C.build_cube(star, buckets=3), out)
    return out


@pytest.mark.parametrize("name", PAIRS)
def test_equals_the_scan(spark, star, path, name):
    cube = C.read_cube(spark, path)
    from_cube, from_facts = PAIRS[name]
    for flt in CHOICES:
        got, want = normalize_output(from_cube(cube, flt)), normalize_output(from_facts(star, flt))
        assert got.columns == want.columns and got.collect() == want.collect(), flt


def test_facts_are_unread(spark, path):
    cube = C.read_cube(spark, path)
    for name, (from_cube, _) in PAIRS.items():
        plan = from_cube(cube, SAMPLE_FILTER)._jdf.queryExecution().executedPlan().toString()
        places = re.findall(r"InMemoryFileIndex\([^)]*\)\[file:([^\]]*)", plan)
        assert places and all(p.startswith(path[:20]) for p in places), (name, places)


def test_a_buyer_of_many_cells_counts_once(spark, star, path):
    """Buyers that appear in several years and states."""
    cube = C.read_cube(spark, path)
    assert cube["buyers"].agg({"held": "count"}).first()[0] > 3
    cells = cube["buyers"].selectExpr("sum(bitmap_count(held)) AS n").first().n
    assert C.kpi_row(cube).first().unique_buyers < cells


def test_blocks_beyond_one_row(spark):
    """More buyers in a bucket than a row of bits holds."""
    orders = spark.range(100_000).selectExpr("id", "1996 AS order_year", "'NB' AS state", "'delivered' AS order_status",
                                             "concat('b', id % 70000) AS customer_unique_id")
    bits = C._buyer_bits(orders, buckets=1)
    assert bits.count() == 3
    assert bits.selectExpr("sum(bitmap_count(held)) AS n").first().n == 70_000


def test_payments_and_reviews_of_an_order_repeat_it(spark):
    """Orders with several, one or no payments and reviews, as the joins count them."""
    def table(rows, schema):
        return spark.createDataFrame(rows, schema)

    star = {
        "fact_orders": table([(1, 1, 1996, "canceled", 3, None, "1996-01", 0), (2, 1, 1996, "delivered", 5, 2, "1996-01", 1), (3, 2, 1996, "shipped", None, -1, None, 0),
                              (4, 9, 1996, "delivered", 1, 1, "1996-02", 1), (5, 2, None, "delivered", 1, 1, None, 1), (6, None, 1997, "delivered", 1, 1, "1997-01", 1)],
                             "order_id long, customer_id long, order_year int, order_status string, delivery_time_days int, delay_days int, order_yearmonth string, is_delivered int"),
        "dim_customers": table([(1, "x", "NB"), (2, "x", "NC"), (3, "y", None)], "customer_id long, customer_unique_id string, state string"),
        "fact_payments": table([(1, 10.5), (1, 2.25), (1, 2.25), (2, None), (7, 1.0), (None, 3.0)], "order_id long, payment_value double").selectExpr(
            "order_id", "CAST(payment_value AS decimal(10,2)) AS payment_value"),
        "fact_reviews": table([(1, 1, 1), (1, 1, 1), (1, 5, 0), (3, 2, 1), (3, None, None), (None, 4, 0)], "order_id long, review_score int, is_negative int"),
        "fact_order_items": table([(1, 1, 5.0), (1, 2, 7.0), (2, 1, None), (3, 3, 9.0)], "order_id long, product_id long, price double").selectExpr(
            "order_id", "product_id", "CAST(price AS decimal(10,2)) AS price"),
        "dim_products": table([(1, "a"), (2, "b"), (3, None)], "product_id long, category_name_en string"),
    }
    cube = C.build_cube(star, buckets=2)
    for name, (from_cube, from_facts) in PAIRS.items():
        for flt in [D.Filters(), D.Filters(states=("NB",)), D.Filters(statuses=("shipped",)), D.Filters(years=(2050, 2051))]:
            assert normalize_output(from_cube(cube, flt)).collect() == normalize_output(from_facts(star, flt)).collect(), (name, flt)


def test_the_star_is_read_once(spark, tmp_path):
    """No table of the cube cleans or joins the star anew: all but the items come from stored rows."""
    star = build(spark, SF)
    rows = C.write_rows(spark, star, str(tmp_path / "rows"))
    for name, df in C.build_cube(rows).items():
        plan = df._jdf.queryExecution().optimizedPlan().toString()
        assert name == "categories" or "o_orderkey" not in plan and "event_id" not in plan and "l_orderkey" not in plan, name
    bits = C.build_cube(rows)["buyers"]._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in bits[bits.index("bitmap_construct_agg"):bits.index("Window")], "a bitmap is shuffled"


def test_the_orders_are_summed_once(spark, tmp_path):
    """Six tables of the cube come from the stored cells, without a look at the orders."""
    rows = C.write_rows(spark, build(spark, SF), str(tmp_path / "rows"))
    built = C.build_cube(rows)
    for name in ("orders", "written", "by_order", "months", "months_by_order", "incidents"):
        plan = built[name]._jdf.queryExecution().optimizedPlan().toString()
        assert "written_n" in plan and "_payments" not in plan and "customer_unique_id" not in plan, name


def test_orders_of_the_categories_are_dealt_to_all_partitions(spark):
    """What is put together by its compressed size has groups beyond a task's memory."""
    plan = C.build_cube(build(spark, SF))["categories"]._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"hashpartitioning\(order_id#\d+L?, 4\), REPARTITION_BY_NUM", plan), plan
