"""The dashboard statements as SQL against their DataFrame forms."""

import pytest
from pyspark.sql import functions as F

from feria.plans import dashboard as D
from feria.plans import dashboard_sql as S
from feria.registry import SAMPLE_FILTER, normalize_output, star

SF = "/root/testdata/sf0.001"
FRAMES = {"kpi_row": D.kpi_row, "dash_q1_monthly": D.monthly, "dash_q2_categories": D.top_categories, "dash_q3_delivery": D.delivery_by_state,
          "dash_q4_incidents": D.incident_split, "score_distribution": D.score_distribution, "dash_q5_sellers": D.seller_scatter}


@pytest.fixture(scope="module")
def tables(spark):
    return {k: v.cache() for k, v in star(spark, SF).items()}


def rows(df):
    return df.columns, [tuple(r) for r in normalize_output(df).collect()]


CHOICES = [D.Filters(), SAMPLE_FILTER, D.Filters(years=(1995, 1995)), D.Filters(states=("NB",)), D.Filters(statuses=("delivered", "canceled")),
           D.Filters(states=("O'Brien", "') OR 1=1 --", '"')), D.Filters(years=(2050, 2051))]


@pytest.mark.parametrize("name", S.STATEMENTS)
def test_equals_the_frame(spark, tables, name):
    for flt in CHOICES:
        assert rows(S.run_statement(spark, tables, name, flt)) == rows(FRAMES[name](tables, flt)), flt


def test_quotes_in_choices_are_text(spark, tables):
    """A state that holds quotes and SQL is found as such, and changes nothing."""
    odd = "x'; DROP"
    c = tables["dim_customers"]
    one = c.agg(F.min("customer_id")).first()[0]
    mine = {**tables, "dim_customers": c.withColumn("state", F.when(F.col("customer_id") == one, odd).otherwise(F.col("state")))}
    flt = D.Filters(states=(odd,))
    assert rows(S.run_statement(spark, mine, "kpi_row", flt)) == rows(D.kpi_row(mine, flt))
    assert odd not in S.STATEMENTS["kpi_row"] and not [t for t in spark.catalog.listTables() if t.isTemporary]


def test_other_parameters(spark, tables):
    assert S.run_statement(spark, tables, "dash_q2_categories", top=3).count() == 3
    assert rows(S.run_statement(spark, tables, "dash_q5_sellers", least_orders=1)) == rows(D.seller_scatter(tables, min_orders=1))
    with pytest.raises(TypeError, match="least"):
        S.run_statement(spark, tables, "kpi_row", least=3)
