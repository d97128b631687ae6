import datetime as dt
import os

from feria.operators.dedup import By
from feria.sources.sinks import append_insert_ignore, export_csv
from feria.streaming.incremental import start_keyed_load

SCHEMA = "review_id string, order_id string, review_score int, answered timestamp_ntz"


def test_append_insert_ignore_file_target(spark, tmp_dir):
    t = dt.datetime
    target = os.path.join(tmp_dir, "reviews")
    b1 = spark.createDataFrame([("r1", "o1", 5, t(2020, 1, 1))], SCHEMA)
    assert append_insert_ignore(spark, b1, target, ["review_id"], [By("answered")]) == (1, 0)
    b2 = spark.createDataFrame([("r1", "o9", 1, t(2020, 1, 2)), ("r2", "o2", 4, t(2020, 1, 2))],
                               SCHEMA)
    assert append_insert_ignore(spark, b2, target, ["review_id"], [By("answered")]) == (1, 1)
    got = sorted((r.review_id, r.order_id) for r in spark.read.parquet(target).collect())
    assert got == [("r1", "o1"), ("r2", "o2")]


def test_streaming_keyed_load(spark, tmp_dir):
    t = dt.datetime
    src, target = os.path.join(tmp_dir, "in"), os.path.join(tmp_dir, "out")
    spark.createDataFrame([("r1", "o1", 5, t(2020, 1, 1)), ("r1", "o1", 3, t(2019, 1, 1))],
                          SCHEMA).write.parquet(os.path.join(src, "batch1"))
    q = start_keyed_load(spark, os.path.join(src, "*"), spark.createDataFrame([], SCHEMA).schema,
                         target, ["review_id"], [By("answered", desc=True)],
                         checkpoint=os.path.join(tmp_dir, "ckpt"))
    q.awaitTermination(120)
    spark.createDataFrame([("r1", "o7", 1, t(2021, 1, 1)), ("r2", "o2", 2, t(2021, 1, 1))],
                          SCHEMA).write.parquet(os.path.join(src, "batch2"))
    q = start_keyed_load(spark, os.path.join(src, "*"), spark.createDataFrame([], SCHEMA).schema,
                         target, ["review_id"], [By("answered", desc=True)],
                         checkpoint=os.path.join(tmp_dir, "ckpt"))
    q.awaitTermination(120)
    got = sorted((r.review_id, r.order_id, r.review_score)
                 for r in spark.read.parquet(target).collect())
    assert got == [("r1", "o1", 5), ("r2", "o2", 2)]


def test_export_csv_roundtrip(spark, tmp_dir):
    df = spark.createDataFrame([("a", 1), ("b", None)], "k string, v int")
    export_csv(df, os.path.join(tmp_dir, "x"))
    back = spark.read.option("header", True).csv(os.path.join(tmp_dir, "x"))
    assert back.count() == 2


def test_refresh_job_sf0001(spark, tmp_dir):
    from feria.plans.refresh import refresh
    from feria.sources.bindings import raw_tables
    csv_dir = os.path.join(tmp_dir, "csv")
    st = {r.table: r for r in refresh(spark, raw_tables(spark, "/root/testdata/sf0.001"),
                                      tmp_dir, csv_dir).collect()}
    assert all(r.error is None for r in st.values())
    assert os.path.exists(os.path.join(tmp_dir, "clean", "master"))
    assert len(os.listdir(csv_dir)) == 10
    back = spark.read.option("header", True).csv(os.path.join(csv_dir, "payments_summary"))
    assert back.count() == spark.read.parquet(
        os.path.join(tmp_dir, "clean", "payments_summary")).count()


def test_load_from_clean_dir_rebuilds_missing_products(spark, tmp_dir):
    from feria.plans.clean import clean_all
    from feria.plans.refresh import load_from_clean_dir
    from feria.plans.warehouse import write_clean
    from feria.sources.bindings import raw_tables
    raw = raw_tables(spark, "/root/testdata/sf0.001")
    cleaned = {k: v for k, v in clean_all(raw).items() if k != "products"}
    clean_dir = os.path.join(tmp_dir, "clean")
    write_clean(spark, cleaned, clean_dir)
    assert not os.path.exists(os.path.join(clean_dir, "products"))
    st = {r.table: r for r in load_from_clean_dir(spark, raw, clean_dir,
                                                  os.path.join(tmp_dir, "star")).collect()}
    assert st["dim_products"].error is None and st["dim_products"].rows > 0
    assert os.path.exists(os.path.join(clean_dir, "products"))
