import datetime as dt

from pyspark.sql import functions as F

from feria.operators.aggregates import first_max_by, mode_by
from feria.operators.dedup import By, first_per_key, insert_ignore, latest_per_key
from feria.operators import profile as P
from feria.operators import quality as Q


def test_mode_smallest_on_tie_and_null_group(spark):
    df = spark.createDataFrame([(1, "b"), (1, "a"), (1, "b"), (1, "a"), (2, None), (3, None),
                                (3, "z")], "k int, v string")
    assert dict(mode_by(df, ["k"], "v").collect()) == {1: "a", 2: None, 3: "z"}


def test_first_max_by_prefers_first_arrival(spark):
    df = spark.createDataFrame([(1, 2, "voucher", 10.0), (1, 1, "card", 10.0),
                                (2, 1, "boleto", 5.0), (2, 2, "card", 7.0)],
                               "o int, seq int, t string, v double")
    got = dict(df.groupBy("o").agg(first_max_by("t", "v", "seq")).collect())
    assert got == {1: "card", 2: "card"}


def test_exact_median(spark):
    df = spark.createDataFrame([(1,), (2,), (4,), (10,)], "x int")
    assert df.agg(F.median("x")).first()[0] == 3.0


def test_latest_per_key_nulls_last_ties_by_id(spark):
    t = dt.datetime
    df = spark.createDataFrame([
        ("r1", "o1", t(2020, 1, 1)), ("r2", "o1", t(2020, 1, 3)),
        ("r3", "o2", None), ("r4", "o2", t(2019, 1, 1)),
        ("r6", "o3", t(2020, 5, 5)), ("r5", "o3", t(2020, 5, 5)),
        ("r7", "o4", None)],
        "review_id string, order_id string, ts timestamp_ntz")
    got = dict((o, r) for r, o, _ in
               [tuple(x) for x in latest_per_key(df, "order_id", "ts", "review_id").collect()])
    assert got == {"o1": "r2", "o2": "r4", "o3": "r5", "o4": "r7"}


def test_first_per_key_full_row_tiebreak(spark):
    df = spark.createDataFrame([(1, 5, "b"), (1, 5, "a"), (2, 1, "x")], "k int, o int, v string")
    got = sorted(tuple(r) for r in first_per_key(df, ["k"], [By("o")]).collect())
    assert got == [(1, 5, "a"), (2, 1, "x")]


def test_first_per_key_takes_ascending_keys_back(spark):
    """A sort key is not moved a second time beside itself; NULLs, ties and counts stay."""
    df = spark.createDataFrame([(1, None, 5, "x"), (1, 2, 7, "y"), (1, 2, 6, "z"), (2, None, None, "b"), (2, None, None, "a"), (None, 3, 1, "c")],
                               "k int, o int, d int, v string")
    got = first_per_key(df, ["k"], [By("o"), By("d", desc=True)], counted="n")
    assert sorted(map(tuple, got.collect()), key=repr) == sorted([(1, 2, 7, "y", 3), (2, None, None, "a", 2), (None, 3, 1, "c", 1)], key=repr)
    assert first_per_key(df.select("k", "o"), ["k"], [By("o")]).columns == ["k", "o"]
    plan = first_per_key(df, ["k"], [By("o")])._jdf.queryExecution().optimizedPlan().toString()
    assert "_row, struct(d, d#" in plan and "struct(o, o#" not in plan


def test_insert_ignore_keeps_existing_and_first_arrival(spark):
    target = spark.createDataFrame([(1, "old")], "k int, v string")
    incoming = spark.createDataFrame([(1, "new"), (2, "b"), (2, "a"), (3, "c")],
                                     "k int, v string")
    fresh = insert_ignore(target, incoming, ["k"], [By("v")])
    assert sorted(tuple(r) for r in fresh.collect()) == [(2, "a"), (3, "c")]


def test_fk_orphans_null_key_is_orphan(spark):
    child = spark.createDataFrame([(1, "a"), (2, None), (3, "zz")], "id int, fk string")
    parent = spark.createDataFrame([("a",), ("b",)], "pk string")
    assert sorted(r.id for r in Q.fk_orphans(child, "fk", parent, "pk").collect()) == [2, 3]
    rep = Q.fk_check(child, "c", "fk", parent, "p", "pk").first()
    assert (rep.orphans, rep.rows, rep.orphan_pct) == (2, 3, 66.67)


def test_duplicate_count_nulls_equal(spark):
    df = spark.createDataFrame([(1,), (1,), (None,), (None,), (2,)], "k int")
    r = Q.duplicate_count(df, ["k"]).first()
    assert (r.rows, r.duplicates) == (5, 2)


def test_histogram_last_bin_closed_and_constant(spark):
    df = spark.createDataFrame([(0.0,), (5.0,), (10.0,), (10.0,)], "x double")
    h = [(r.bin, r["count"]) for r in P.histogram(df, "x", 2).collect()]
    assert h == [(0, 1), (1, 3)]
    c = spark.createDataFrame([(3.0,), (3.0,)], "x double")
    hc = [(r.bin, r["count"], r.bin_lo, r.bin_hi) for r in P.histogram(c, "x", 3).collect()]
    assert [x[1] for x in hc] == [0, 2, 0] and hc[0][2] == 2.5 and hc[-1][3] == 3.5


def test_describe_and_quantile_filter(spark):
    df = spark.createDataFrame([(1.0,), (2.0,), (4.0,), (10.0,)], "x double")
    d = P.describe(df, "x").first()
    assert (d["count"], d["mean"], d["min"], d["p50"], d["max"]) == (4, 4.25, 1.0, 3.0, 10.0)
    kept = P.quantile_filter(df, "x", 0.5)
    assert sorted(r.x for r in kept.collect()) == [1.0, 2.0]


def test_a_profile_makes_its_rows_once(spark):
    """Nulls, rows, distinct values and samples come from one pass, fractions as fixed-point text."""
    seen = spark.sparkContext.accumulator(0)

    def counted(batches):
        for b in batches:
            seen.add(b.num_rows)
            yield b

    df = spark.createDataFrame([(1, 2.5, None), (1, -0.25, None), (None, 10.0, None), (3, None, None)], "a int, b double, c string")
    got = [tuple(r) for r in P.profile_columns(df.mapInArrow(counted, df.schema), "t").collect()]
    assert got == [("t", 0, "a", "int", 1, 25.0, 2, 50.0, "1"), ("t", 1, "b", "double", 1, 25.0, 3, 75.0, "-0.250000000"),
                   ("t", 2, "c", "string", 4, 100.0, 0, 0.0, None)]
    assert seen.value == 4
    empty = P.profile_columns(df.where("a > 9"), "t").collect()
    assert [(r.column, r.nulls, r.null_pct, r.unique, r.unique_pct, r.sample_value) for r in empty] == [(c, 0, None, 0, None, None) for c in "abc"]


def test_profile_and_null_counts(spark):
    df = spark.createDataFrame([(1, None), (2, "a"), (2, "a")], "a int, b string")
    prof = {r.column: r for r in P.profile_columns(df, "t").collect()}
    assert prof["a"].unique == 2 and prof["b"].nulls == 1 and prof["b"].null_pct == 33.33
    assert prof["a"].sample_value == "1"


def test_hash_sample_repeatable_and_bounded(spark):
    df = spark.range(1000).withColumn("x", F.col("id") * 0.5)
    a = [r.id for r in P.hash_sample(df, 10, ["id", "x"]).collect()]
    b = [r.id for r in P.hash_sample(df, 10, ["id", "x"]).collect()]
    assert a == b and len(a) == 10


def test_value_counts_order(spark):
    df = spark.createDataFrame([("b",), ("a",), ("a",), ("b",), ("c",), (None,)], "v string")
    assert [tuple(r) for r in P.value_counts(df, "v", top=2).collect()] == [("a", 2), ("b", 2)]


def test_exact_percentile_equals_builtin(spark):
    import random
    from feria.operators.aggregates import exact_percentile, exact_percentiles, grouped_medians
    rnd = random.Random(7)
    rows = [(g, rnd.choice([float(rnd.randint(0, 9)), rnd.gauss(0, 50)]))
            for g, n in enumerate([1, 2, 3, 50, 3000]) for _ in range(n)] + [(9, None)]
    df = spark.createDataFrame(rows, "g int, v double")
    for q in (0.0, 0.25, 0.5, 0.99, 1.0):
        got = dict(exact_percentile(df, ["g"], "v", q).collect())
        exp = dict(df.groupBy("g").agg(F.percentile("v", F.lit(q))).collect())
        assert got == exp, q
        assert exact_percentile(df, [], "v", q).first()[0] == \
            df.agg(F.percentile("v", F.lit(q))).first()[0]
    several = exact_percentiles(df, ["g"], "v", [0.1, 0.5, 0.9], ["a", "b", "c"], buckets=4)
    for r in several.collect():
        own = df.where(F.col("g") == r.g)
        assert tuple(r)[1:] == tuple(own.agg(*[F.percentile("v", F.lit(q)) for q in (0.1, 0.5, 0.9)]).first())
    med = dict((r.g, r.v) for r in grouped_medians(df, ["g"], ["v"]).collect())
    assert med == dict(df.groupBy("g").agg(F.median("v")).collect())


def test_percentile_and_histogram_skip_nan(spark):
    from feria.operators.aggregates import exact_percentile, grouped_and_global_medians
    nan = float("nan")
    rows = [(1, float(i)) for i in range(1, 11)] + [(1, nan)] * 10 + [(2, nan), (3, None)]
    df = spark.createDataFrame(rows, "g int, v double")
    assert exact_percentile(df, [], "v", 0.5).first()[0] == 5.5
    assert exact_percentile(df.where("g > 1"), [], "v", 0.5).first()[0] is None
    assert exact_percentile(df.limit(0), [], "v", 0.5).first()[0] is None
    assert dict(exact_percentile(df, ["g"], "v", 0.5).collect()) == {1: 5.5, 2: None, 3: None}
    bins = P.histogram(df, "v", 3).collect()
    assert [r["count"] for r in bins] == [3, 3, 4] and (bins[0].bin_lo, bins[-1].bin_hi) == (1.0, 10.0)
    both = grouped_and_global_medians(df.select(F.col("g").cast("string").alias("g"), "v"), "g", ["v"])
    assert dict(both.collect()) == {"1": 5.5, "2": None, "3": None, None: 5.5}


def test_fk_check_null_key(spark):
    from feria.operators.quality import fk_check
    child = spark.createDataFrame([(1,), (None,), (9,), (9,)], "k int")
    parent = spark.createDataFrame([(1,), (1,)], "k int")
    assert tuple(fk_check(child, "c", "k", parent, "p", "k").first())[2:] == (3, 4, 75.0)
    assert tuple(fk_check(child, "c", "k", parent, "p", "k", null_is_orphan=False).first())[2:] == (2, 4, 50.0)


def test_the_clean_summary_reads_stored_tables(spark):
    """The master and its six tables are not cleaned once more for it."""
    from feria.registry import QUERIES
    plan = QUERIES["table_summary_clean"](spark, "/root/testdata/sf0.001")._jdf.queryExecution().optimizedPlan().toString()
    assert "l_orderkey" not in plan and "o_orderkey" not in plan and "event_id" not in plan
