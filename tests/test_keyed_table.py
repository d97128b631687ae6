"""Keyed appends that read only the buckets they hit, against plain Python."""

import os
import random

import pytest

from feria.operators.dedup import By
from feria.sources.keyed_table import ROW_BITS, KeyedTable

SCHEMA = "k long, j string, v long, _seq long"
ARRIVAL = [By("_seq"), By("v")]


def batch(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


def brute(table, rows):
    """The table (by key) after an append, and how many rows came in."""
    n = 0
    for k, j, v, _ in sorted(rows, key=lambda r: (r[3], r[2])):
        if (k, j) not in table:
            table[k, j] = v
            n += 1
    return n


def stored(t):
    return {(r.k, r.j): r.v for r in t.read().collect()}


@pytest.mark.parametrize("bits", [ROW_BITS, 4 * ROW_BITS])
def test_appends_equal_insert_ignore(spark, tmp_dir, bits):
    draw, want = random.Random(bits), {}
    t = KeyedTable(spark, os.path.join(tmp_dir, "t"), ["k", "j"], buckets=7, bits=bits)
    for n in (50, 0, 80, 3, 200):
        rows = [(draw.choice([None, draw.randint(0, 120)]), draw.choice(["a", "b", None]), draw.randint(0, 10**6), draw.randint(0, 9)) for _ in range(n)]
        got = t.append(batch(spark, rows), ARRIVAL)
        added = brute(want, rows)
        assert (got.appended, got.skipped) == (added, n - added)
        if want:
            assert stored(t) == want and t.read().count() == len(want)
            assert t.read().columns == ["k", "j", "v"]


def test_reads_grow_with_the_batch(spark, tmp_dir):
    """New keys read no bucket; a known key reads its own only."""
    path = os.path.join(tmp_dir, "t")
    t = KeyedTable(spark, path, ["k", "j"], buckets=32)
    t.append(batch(spark, [(i, "a", i, 0) for i in range(2000)]), ARRIVAL)
    new = t.append(batch(spark, [(i, "a", i, 0) for i in range(10_000, 10_003)]), ARRIVAL)
    assert (new.appended, new.buckets_read) == (3, 0) and new.buckets_hit <= 3
    one = t.append(batch(spark, [(5, "a", 0, 0), (10_010, "a", 1, 0)]), ARRIVAL)
    assert (one.appended, one.skipped, one.buckets_read) == (1, 1, 1)
    files = {len(t.keys_of(list(range(n))).inputFiles()) for n in (1, 32)}
    few, every = (t.keys_of(list(range(n)))._jdf.queryExecution().executedPlan() for n in (1, 32))
    assert "PartitionFilters: [" in few.toString() and files
    sizes = [sum(os.path.getsize(f.replace("file://", "")) for f in files_of(t, n)) for n in (1, 32)]
    assert sizes[0] * 10 < sizes[1]


def files_of(t, n):
    """The files that hold the rows of the first ``n`` buckets' keys."""
    from pyspark.sql import functions as F
    return [r[0] for r in t.keys_of(list(range(n))).select(F.input_file_name()).distinct().collect()]


def test_a_cut_off_append_is_repeated(spark, tmp_dir, monkeypatch):
    """Bits without rows: the rows come in with the next try."""
    t = KeyedTable(spark, os.path.join(tmp_dir, "t"), ["k", "j"], buckets=4)
    rows = [(i, "a", i, 0) for i in range(20)]
    t.append(batch(spark, rows[:10]), ARRIVAL)
    t._placed(batch(spark, rows).drop("_seq")).createOrReplaceTempView("cut_off")
    spark.sql("SELECT _bucket, _row, bitmap_construct_agg(_bit) AS held FROM cut_off GROUP BY 1, 2").write.mode("append").partitionBy("_bucket").parquet(t._filters)
    spark.catalog.dropTempView("cut_off")
    got = t.append(batch(spark, rows), ARRIVAL)
    assert (got.appended, got.skipped) == (10, 10) and t.read().count() == 20
    assert t.append(batch(spark, rows), ARRIVAL).appended == 0


def test_settings_of_an_existing_table_stay(spark, tmp_dir):
    path = os.path.join(tmp_dir, "t")
    KeyedTable(spark, path, ["k"], buckets=3, bits=ROW_BITS)
    t = KeyedTable(spark, path, ["k"], buckets=99)
    assert (t.buckets, t.bits) == (3, ROW_BITS)
    with pytest.raises(ValueError, match="key"):
        KeyedTable(spark, path, ["j"])
    with pytest.raises(ValueError, match="multiple"):
        KeyedTable(spark, os.path.join(tmp_dir, "u"), ["k"], bits=7)


def test_streams_append_to_it(spark, tmp_dir):
    from feria.streaming.incremental import start_keyed_load
    src, target = os.path.join(tmp_dir, "in"), os.path.join(tmp_dir, "out")
    for n, rows in enumerate([[(1, "a", 5, 0), (1, "a", 3, 1)], [(1, "a", 9, 0), (2, "a", 2, 0)]]):
        batch(spark, rows).write.parquet(os.path.join(src, f"batch{n}"))
        start_keyed_load(spark, os.path.join(src, "*"), batch(spark, []).schema, target, ["k", "j"], ARRIVAL,
                         checkpoint=os.path.join(tmp_dir, "ckpt"), buckets=4).awaitTermination(120)
    assert stored(KeyedTable(spark, target, ["k", "j"])) == {(1, "a"): 5, (2, "a"): 2}


def test_a_batch_is_computed_once(spark, tmp_dir):
    """What the batch is made from is read in one go, also to count it, and what
    is new needs no copy where nothing is known."""
    seen = spark.sparkContext.accumulator(0)

    def rows(batches):
        for b in batches:
            seen.add(b.num_rows)
            yield b

    t = KeyedTable(spark, os.path.join(tmp_dir, "t"), ["k", "j"], buckets=4)
    made = batch(spark, [(i % 50, "a", i, i) for i in range(100)]).mapInArrow(rows, SCHEMA)
    got = t.append(made, ARRIVAL)
    assert (got.appended, got.skipped, seen.value) == (50, 50, 100)
    more = t.append(batch(spark, [(i, "a", i, i) for i in range(40, 60)]), ARRIVAL)
    assert (more.appended, more.skipped) == (10, 10)
    for n in range(4):
        assert sum(f.endswith(".parquet") for f in os.listdir(os.path.join(t._rows, f"_bucket={n}"))) <= 2  # one an append
