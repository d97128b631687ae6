"""Contract checks: entry() smoke, and every registered query against its
DuckDB statement on the smallest driver tables."""

import os
import sys

import pytest

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(__file__)), "tools"))

SF = "/root/testdata/sf0.001"


def test_entry_smoke(spark):
    import __spark_entry__ as e
    df = e.entry(spark)
    assert df.count() >= 0
    assert df.columns[0] == "seller_id"
    assert set(e.oracle_sql()) <= set(e.queries())


@pytest.fixture(scope="module")
def duck():
    from oracle_check import duck as make
    return make(SF)


def _names():
    from feria.registry import QUERIES
    return list(QUERIES)


@pytest.mark.parametrize("name", _names())
def test_query_matches_oracle(spark, duck, name):
    from oracle_check import compare
    from feria.registry import ORACLE, QUERIES
    if name not in ORACLE:
        assert QUERIES[name](spark, SF).count() >= 0
        return
    assert compare(spark, duck, name, QUERIES[name], ORACLE[name], SF) == "OK"
