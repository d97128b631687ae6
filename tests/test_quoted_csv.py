"""The parallel reader of CSV files with quoted line breaks, against Spark's own."""

import csv
import os
import random

import pytest

from feria.sources import readers
from feria.sources.quoted_csv import quoted_records
from feria.schemas import RAW

NAMES = RAW["reviews"].names


def write(path, rows, end="\n", bom=False):
    with open(path, "w", encoding="utf-8-sig" if bom else "utf-8", newline="") as f:
        out = csv.writer(f, lineterminator=end)
        out.writerow(NAMES)
        out.writerows(rows)


def spark_rows(spark, path):
    df = (spark.read.option("header", True).option("escape", '"').option("multiLine", True).schema(RAW["reviews"]).csv(path))
    return sorted(map(tuple, df.collect()), key=repr)


def small_splits(spark, size):
    spark.conf.set("spark.sql.files.maxPartitionBytes", str(size))
    spark.conf.set("spark.sql.files.openCostInBytes", "0")


@pytest.fixture(autouse=True)
def default_splits(spark):
    yield
    spark.conf.unset("spark.sql.files.maxPartitionBytes")
    spark.conf.unset("spark.sql.files.openCostInBytes")


TEXTS = ["", "plain", 'say "hi"', "two\nlines", '"', '""\n""', 'a "quoted\n\nbreak", and more', "\n", "é\n中", ",,\n,", "x" * 50, "y\n" * 20]


def random_rows(n, seed):
    draw = random.Random(seed)
    return [(f"r{i}", f"o{i}", draw.randint(1, 5), draw.choice(TEXTS), draw.choice(TEXTS) + draw.choice(TEXTS),
             "2018-01-01 00:00:00", "") for i in range(n)]


@pytest.mark.parametrize("size", [16, 61, 200, 10_000])
@pytest.mark.parametrize("bom", [False, True])
def test_every_split_edge(spark, tmp_dir, size, bom):
    """Splits end inside quotes, between doubled quotes, in the header."""
    path = os.path.join(tmp_dir, "reviews.csv")
    write(path, random_rows(60, size), bom=bom)
    small_splits(spark, size)
    df = readers.read_csv(spark, path, "reviews")
    assert sorted(map(tuple, df.collect()), key=repr) == spark_rows(spark, path)
    if size < 1000:
        assert quoted_records(spark, path).rdd.getNumPartitions() > 3  # more than one task


def test_line_ends_and_several_files(spark, tmp_dir):
    for k, end in enumerate(["\n", "\r\n"]):
        write(os.path.join(tmp_dir, f"{k}.csv"), random_rows(30, k), end)
    small_splits(spark, 100)
    got = readers.read_csv(spark, tmp_dir, "reviews")
    want = spark_rows(spark, os.path.join(tmp_dir, "0.csv")) + spark_rows(spark, os.path.join(tmp_dir, "1.csv"))
    assert sorted(map(tuple, got.collect()), key=repr) == sorted(want, key=repr)


def test_record_over_many_splits(spark, tmp_dir):
    path = os.path.join(tmp_dir, "reviews.csv")
    write(path, [("r1", "o1", 5, "", "line\n" * 400, "", ""), ("r2", "o2", 1, "", "z", "", "")])
    small_splits(spark, 64)
    assert sorted(map(tuple, readers.read_csv(spark, path, "reviews").collect()), key=repr) == spark_rows(spark, path)


def test_empty_files_rejects_and_open_quotes(spark, tmp_dir):
    path = os.path.join(tmp_dir, "reviews.csv")
    write(path, [])
    assert readers.read_csv(spark, path, "reviews").count() == 0
    write(path, [("r1", "o1", "five", "", "a\nb", "", ""), ("r2", "o2", 1, "", "z", "", ""), ("r3", "o3"), ("r4", "o4", 2, "", "", "", "", "x")])
    assert [r.review_id for r in readers.read_csv(spark, path, "reviews").collect()] == ["r2"]
    rejects = sorted(r.record for r in readers.read_csv_rejects(spark, path, "reviews").collect())
    assert rejects == ['r1,o1,five,,"a\nb",,', "r3,o3", "r4,o4,2,,,,,x"]
    with open(path, "a") as f:
        f.write('r5,o5,1,,"never closed\n')
    with pytest.raises(ValueError, match="inside quotes"):
        quoted_records(spark, path)
