"""Foreign keys of all edges in one aggregate, repeated rows by fingerprint."""

import random

from pyspark.sql import functions as F

from feria.operators import quality as Q


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_edges_of_all_kinds(spark):
    """Long, text and mixed number types, NULLs, empty sides, a popular orphan."""
    draw, edges, want = random.Random(3), [], {}
    for n, (ct, pt) in enumerate([("long", "long"), ("string", "string"), ("int", "long"), ("long", "int")]):
        child = [draw.choice([None, *range(20)]) for _ in range(300)] + [99] * 500
        parent = [draw.choice([None, *range(12)]) for _ in range(30)]
        c = spark.createDataFrame([(x,) for x in child], "k long").select(F.col("k").cast(ct))
        p = spark.createDataFrame([(x,) for x in parent], "id long").select(F.col("id").cast(pt))
        edges.append((c, f"c{n}", "k", p, f"p{n}", "id"))
        want[f"c{n}.k"] = (sum(x is None for x in child), sum(x is not None and x not in parent for x in child), len(child))
    none = spark.createDataFrame([], "k long")
    edges += [(none, "c_none", "k", edges[0][3], "p0", "id"), (edges[0][0], "c_all", "k", none, "p_none", "k")]
    want["c_none.k"] = (0, 0, 0)
    nulls, lost, rows = want["c0.k"]
    want["c_all.k"] = (nulls, rows - nulls, rows)
    for null_is_orphan in (True, False):
        got = {r.child: (r.orphans, r.rows) for r in Q.fk_report(edges, null_is_orphan).collect()}
        assert got == {k: (lost + (nulls if null_is_orphan else 0), rows) for k, (nulls, lost, rows) in want.items()}
    one = Q.fk_check(*edges[0]).first()
    assert (one.child, one.parent, one.orphans, one.rows) == ("c0.k", "p0.id", nulls + want["c0.k"][1], rows)


def test_one_exchange_for_all_edges(spark):
    c, p = spark.range(100).toDF("k"), spark.range(50).toDF("id")
    plan = plan_of(Q.fk_report([(c, f"c{n}", "k", p, "p", "id") for n in range(8)]))
    assert plan.count("Exchange hashpartitioning(_e#") == 2  # by (edge, key), then a row per edge
    assert "SortMergeJoin" not in plan


def brute(rows):
    return len(rows), len(rows) - len(set(rows))


def test_repeated_rows(spark):
    draw = random.Random(5)
    rows = [(draw.choice([None, 1, 2]), draw.choice([None, "", "a"]), draw.choice([None, 1.5, float("inf")])) for _ in range(200)]
    df = spark.createDataFrame(rows, "a long, b string, `c.d` double")
    assert tuple(Q.duplicate_count(df).first()) == brute(rows)
    assert tuple(Q.duplicate_count(df.limit(0)).first()) == (0, 0)
    few = spark.range(1000).withColumn("text", F.repeat(F.lit("x"), 50))
    assert tuple(Q.duplicate_count(few).first()) == (1000, 0)


def test_collisions_are_settled(spark):
    """NULLs are left out of a hash: rows that only differ in where they are
    share a fingerprint, and are no duplicates."""
    df = spark.createDataFrame([(1, None, 1), (None, 1, 1), (1, None, 1)], "a long, b long, c long")
    assert tuple(Q.duplicate_count(df).first()) == (3, 1)


def test_wide_columns_are_not_shuffled_to_count(spark):
    df = spark.range(1000).withColumn("text", F.repeat(F.col("id").cast("string"), 100))
    plan = plan_of(Q.repeated_rows(df))
    first = plan[: plan.index("xxhash64")]
    assert "Exchange hashpartitioning(_h1" in first and "Exchange hashpartitioning(c0" not in first
