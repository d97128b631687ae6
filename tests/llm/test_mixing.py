import math

import pytest
from helpers import clashing, documents, table, words
from pyspark.sql import functions as F

from feria.llm import mixing


def brute_targets(sizes):
    """Shares by weight, stopped at CAP times the size, reshared until none is above."""
    order = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: mixing.WEIGHTS[i % 3] for i, s in enumerate(order)}
    total, fixed = sum(sizes.values()), {}
    while True:
        free = [s for s in order if s not in fixed]
        left = total - sum(fixed.values())
        share = {s: left * weight[s] / sum(weight[f] for f in free) for s in free}
        over = [s for s in free if share[s] > mixing.CAP * sizes[s]]
        if not over:
            return {**fixed, **share}
        fixed |= {s: mixing.CAP * sizes[s] for s in over}


def check(rows, taken):
    """rows: (doc_id, text, source); taken: rows of the report."""
    sizes = {}
    for _, t, s in rows:
        sizes[s] = sizes.get(s, 0) + len(words(t))
    want = brute_targets(sizes)
    assert len(taken) == len(rows)
    by_id = {i: (len(words(t)), s) for i, t, s in rows}
    got = dict.fromkeys(sizes, 0)
    for r in taken:
        size, source = by_id[r.doc_id]
        assert (r.size, r.source_size) == (size, sizes[source])
        assert r.target == pytest.approx(want[source], rel=1e-9, abs=1e-9)
        assert 0 <= r.taken <= mixing.CAP * size
        got[source] += r.taken
    for s in sizes:
        assert abs(got[s] - want[s]) <= 1


def test_driver_rows_and_reruns(spark):
    docs = table(spark, "documents")
    taken = mixing.mix_report(docs).collect()
    check([(r.doc_id, r.text, r.source) for r in docs.collect()], taken)
    again = mixing.mix_report(docs.repartition(5)).collect()
    assert sorted(map(tuple, taken)) == sorted(map(tuple, again))


def test_targets_over_many_ranges(spark):
    """More sources than one range holds, some stopped at the cap, one null."""
    sizes = {None: 40, "": 0, **{f"s{i:03d}": (i * 37 % 101) ** 3 for i in range(120)}}
    rows = spark.createDataFrame([(s, n, 1) for s, n in sizes.items()], "source string, size long, docs long")
    key = "spark.sql.adaptive.coalescePartitions.enabled"
    before = spark.conf.get(key)
    spark.conf.set(key, "false")
    try:
        got = {r.source: r.target for r in mixing.targets(rows).collect()}
        per = mixing._before(rows, [F.col("source").asc_nulls_last()], number="docs").collect()
        assert mixing.targets(rows.limit(0)).count() == 0
    finally:
        spark.conf.set(key, before)
    assert [r.source for r in sorted(per, key=lambda r: r.number)] == sorted(sizes, key=lambda s: (s is None, s or ""))
    want = brute_targets(sizes)
    assert got.keys() == want.keys()
    assert all(got[s] == pytest.approx(want[s], rel=1e-9, abs=1e-9) for s in want)


def test_rates_are_tilted_exponentially(spark):
    """Odds of a rate against the cap are log-linear in the size of a document."""
    sizes = spark.createDataFrame([("a", n, 1) for n in range(10, 400, 7)] + [("b", 50, 40)], "source string, size long, docs long")
    state = mixing.solve(sizes)
    rates = sizes.join(state, "source").select("source", "size", "docs", "target", mixing._rate().alias("rate")).collect()
    for s in ("a", "b"):
        own = [r for r in rates if r.source == s]
        assert sum(r.size * r.docs * r.rate for r in own) == pytest.approx(own[0].target, abs=0.02)
    odds = [(r.size, math.log(r.rate / (mixing.CAP - r.rate))) for r in rates if r.source == "a"]
    slopes = {round((y - math.log(1 / 2)) / x, 6) for x, y in odds}
    assert len(slopes) == 1


def test_edges(spark):
    rows = [(1, None, "z"), (2, "", "z"), (3, "one", "a"), (4, "a b c " * 50, None), (5, "x " * 30_000, "b"), (6, "x y", "b"),
            (7, "only words here", "c"), (8, "p q r s", "c")] + [(100 + i, "same size text", "a") for i in range(60)]
    docs = clashing(documents(spark, rows))
    check(rows, mixing.mix_report(docs).collect())
    mixed = mixing.mixed_corpus(docs)
    assert mixed.columns == docs.columns
    taken = {r.doc_id: r.taken for r in mixing.mix_report(docs).collect()}
    got = {}
    for r in mixed.collect():
        got[r.doc_id] = got.get(r.doc_id, 0) + len(words(r.text))
        assert r.n_chars == (None if r.text is None else len(r.text))
    assert {k: v for k, v in taken.items() if v} == {k: v for k, v in got.items() if v}
    assert mixing.mix_report(documents(spark, [])).count() == 0
    assert mixing.mixed_corpus(documents(spark, [])).count() == 0


def test_repeated_rows(spark):
    rows = [(1, "a b c d e", "s")] * 9 + [(2, "a b", "t")]
    docs = documents(spark, rows)
    out = mixing.mix_report(docs).groupBy("source_size").agg(F.sum("taken").alias("n"), F.count("*").alias("rows"), F.first("target").alias("t")).collect()
    assert sorted((r.source_size, r.rows) for r in out) == [(2, 1), (45, 9)]
    assert all(abs(r.n - r.t) <= 1 for r in out)


def test_reruns_agree_on_texts_of_one_id(spark):
    """Documents without a doc_id, or sharing one, of one size: the same texts
    are taken however the rows are dealt."""
    rows = [(None if i % 2 else 7, f"w{i} " * 5, "abc"[i % 3]) for i in range(90)]
    taken = [sorted(r.text for r in mixing.mixed_corpus(documents(spark, part).repartition(n)).collect())
             for n, part in ((1, rows), (4, rows[::-1]), (3, rows[45:] + rows[:45]))]
    assert taken[0] == taken[1] == taken[2] and len(set(taken[0])) < 90
