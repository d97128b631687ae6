"""The star load as one publication."""

import os

import pytest

from feria.plans import publish as P
from feria.plans.clean import clean_all
from feria.plans.warehouse import SOURCE, build_star
from feria.schemas import LOAD_ORDER
from feria.sources.bindings import raw_tables
from feria.sources.sinks import read_text, rename_path, write_text

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def clean(spark, tmp_path_factory):
    out = str(tmp_path_factory.mktemp("clean"))
    cleaned = clean_all(raw_tables(spark, SF))
    for name in set(SOURCE.values()):
        cleaned[name].write.parquet(os.path.join(out, name))
    return {name: spark.read.parquet(os.path.join(out, name)) for name in set(SOURCE.values())}


def counts(star):
    return {t: df.count() for t, df in star.items()}


def test_versions_are_whole_and_pinned(spark, tmp_dir, clean):
    with pytest.raises(P.NotPublishedError):
        P.read_published(spark, tmp_dir)
    first = P.publish_star(spark, clean, tmp_dir).collect()
    assert {r.version for r in first} == {1} and not any(r.reused or r.error for r in first)
    want = {t: df.count() for t, df in build_star(clean).items()}
    assert counts(P.read_published(spark, tmp_dir)) == want == {r.table: r.rows for r in first}
    half = {**clean, "orders": clean["orders"].limit(10)}
    second = P.publish_star(spark, half, tmp_dir, partition_orders_by_year=True).collect()
    assert {r.version for r in second} == {2}
    assert P.read_published(spark, tmp_dir)["fact_orders"].count() == 10
    assert counts(P.read_published(spark, tmp_dir, 1)) == want
    assert [m["version"] for m in P.versions(spark, tmp_dir)] == [1, 2]
    assert P.prune(spark, tmp_dir, keep=1) == [1]
    assert [m["version"] for m in P.versions(spark, tmp_dir)] == [2]
    with pytest.raises(P.NotPublishedError):
        P.read_published(spark, tmp_dir, 1)
    assert len(os.listdir(os.path.join(tmp_dir, "runs"))) == 1


def test_a_failing_table_keeps_the_load_back(spark, tmp_dir, clean):
    """Readers keep the old version; the rerun loads what failed, and only that."""
    P.publish_star(spark, clean, tmp_dir)
    bad = {**clean, "payments": clean["payments"].drop("payment_value")}
    run = P.new_run()
    status = {r.table: r for r in P.publish_star(spark, bad, tmp_dir, run).collect()}
    assert "payment_value" in status["fact_payments"].error
    assert all(r.error is None for t, r in status.items() if t != "fact_payments")
    assert all(r.version is None for r in status.values())
    assert P.unpublished_runs(spark, tmp_dir) == [run]
    assert P.published(spark, tmp_dir)["version"] == 1
    again = {r.table: r for r in P.publish_star(spark, clean, tmp_dir, run).collect()}
    assert {t for t, r in again.items() if not r.reused} == {"fact_payments"}
    assert {r.version for r in again.values()} == {2} and P.unpublished_runs(spark, tmp_dir) == []
    assert counts(P.read_published(spark, tmp_dir)) == counts(P.read_published(spark, tmp_dir, 1))
    third = P.publish_star(spark, clean, tmp_dir, run).collect()  # published: reported, not loaded
    assert all(r.reused and r.version == 2 for r in third) and len(P.versions(spark, tmp_dir)) == 2


def test_a_table_written_but_not_marked_is_loaded_again(spark, tmp_dir, clean):
    """A run that was cut off leaves rows without a mark."""
    run = P.new_run()
    clean["orders"].limit(3).write.parquet(os.path.join(tmp_dir, "runs", run, "fact_orders"))
    P.publish_star(spark, clean, tmp_dir, run)
    assert P.read_published(spark, tmp_dir)["fact_orders"].count() == build_star(clean)["fact_orders"].count()


def test_drafts_and_taken_numbers(spark, tmp_dir, clean):
    """A draft is no version, and a number that is taken is passed over."""
    write_text(spark, os.path.join(tmp_dir, "manifests", "_draft"), "{")
    with pytest.raises(P.NotPublishedError):
        P.published(spark, tmp_dir)
    for want in (1, 2):
        assert P._publish(spark, tmp_dir, f"run{want}", {}) == want
    a, b = os.path.join(tmp_dir, "a"), os.path.join(tmp_dir, "b")
    write_text(spark, a, "é")
    write_text(spark, b, "old")
    assert not rename_path(spark, a, b) and read_text(spark, b) == "old" and read_text(spark, a) == "é"


def test_verification_against_expected_counts(spark, tmp_dir, clean):
    P.publish_star(spark, clean, tmp_dir)
    real = counts(P.read_published(spark, tmp_dir))
    due = [(t, n + (5 if t == "fact_orders" else 0)) for t, n in real.items() if t != "dim_sellers"] + [("dim_dates", 7)]
    got = {r.table: (r.expected, r.loaded, r.missing) for r in P.verify_published(spark, tmp_dir, spark.createDataFrame(due, "table string, rows long")).collect()}
    assert got["fact_orders"] == (real["fact_orders"] + 5, real["fact_orders"], 5)
    assert got["dim_sellers"] == (None, real["dim_sellers"], None) and got["dim_dates"] == (7, None, None)
    assert all(v[2] == 0 for t, v in got.items() if t not in ("fact_orders", "dim_sellers", "dim_dates"))
    assert set(got) == {*LOAD_ORDER, "dim_dates"}


def test_refresh_goes_on_with_a_run(spark, tmp_dir, monkeypatch):
    from feria.plans import refresh as R
    raw = raw_tables(spark, SF)
    real, failing = P.load_table, {"fact_reviews"}

    def load(spark, table, *rest):
        if table in failing:
            raise OSError("disk")
        return real(spark, table, *rest)

    monkeypatch.setattr(P, "load_table", load)
    first = {r.table: r for r in R.refresh(spark, raw, tmp_dir).collect()}
    assert "disk" in first["fact_reviews"].error
    star = os.path.join(tmp_dir, "star")
    (run,) = P.unpublished_runs(spark, star)
    failing.clear()
    again = {r.table: r for r in R.refresh(spark, None, tmp_dir, run=run).collect()}
    assert {t for t, r in again.items() if not r.reused} == {"fact_reviews"} and {r.version for r in again.values()} == {1}
    assert P.read_published(spark, star)["fact_reviews"].count() > 0
