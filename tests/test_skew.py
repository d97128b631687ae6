"""Operators on a hot key holding a third or more of all rows: results stay
exact (the plans spread such keys; here we check the answers)."""

import random

from pyspark.sql import Window
from pyspark.sql import functions as F

from feria.operators.aggregates import (exact_percentile, grouped_medians, grouped_modes,
                                        median_small_domain, mode_by)
from feria.operators.dedup import By, first_per_key


def skewed(spark, n=30000):
    rnd = random.Random(3)
    rows = []
    for i in range(n):
        k = 0 if i % 3 != 2 else rnd.randint(1, 500)      # key 0 holds two thirds
        rows.append((k, rnd.randint(0, 300), float(rnd.gauss(0, 10)), f"s{rnd.randint(0, 40)}"))
    return spark.createDataFrame(rows, "k int, d int, v double, s string")


def test_hot_key_medians_and_modes(spark):
    df = skewed(spark)
    exp_med = dict(df.groupBy("k").agg(F.median("v")).collect())
    assert dict(grouped_medians(df, ["k"], ["v"]).collect()) == exp_med
    assert dict(exact_percentile(df, ["k"], "v", 0.5).collect()) == exp_med
    exp_d = dict(df.groupBy("k").agg(F.median("d")).collect())
    assert dict(median_small_domain(df, ["k"], "d").collect()) == exp_d
    exp_mode = dict(df.groupBy("k").agg(F.mode("s", True)).collect())
    assert dict(mode_by(df, ["k"], "s").collect()) == exp_mode
    assert dict(grouped_modes(df, ["k"], ["s"]).collect()) == exp_mode


def test_hot_key_first_per_key(spark):
    df = skewed(spark)
    got = {r.k: (r.d, r.v) for r in first_per_key(df, ["k"], [By("d", desc=True), By("v")])
           .collect()}
    w = Window.partitionBy("k").orderBy(F.col("d").desc(), F.col("v"), F.col("s"))
    ranked = df.withColumn("rn", F.row_number().over(w)).where("rn = 1")
    assert got == {r.k: (r.d, r.v) for r in ranked.collect()}
