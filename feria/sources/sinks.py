"""Sinks: Parquet tables, CSV exports and keyed appends."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from feria.operators.dedup import By, insert_ignore


def write_parquet(df: DataFrame, path: str, partition_by: list[str] | None = None,
                  mode: str = "overwrite") -> None:
    w = df.write.mode(mode)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)


def export_csv(df: DataFrame, path: str) -> None:
    """CSV export with a header. Parquet stays the format between stages
    (it keeps types and the difference between NULL and empty text); CSV is
    only for hand-off."""
    (df.write.mode("overwrite").option("header", True).option("escape", '"')
     .option("emptyValue", "").option("ignoreLeadingWhiteSpace", False)
     .option("ignoreTrailingWhiteSpace", False).csv(path))


def _at(spark: SparkSession, path: str):
    """The cluster file system of ``path`` and the path (not the driver's disk)."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def path_exists(spark: SparkSession, path: str) -> bool:
    fs, p = _at(spark, path)
    return fs.exists(p)


def list_names(spark: SparkSession, path: str) -> list[str]:
    """The names in a folder; none if it does not exist."""
    fs, p = _at(spark, path)
    return [s.getPath().getName() for s in fs.listStatus(p)] if fs.exists(p) else []


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """A small file; one of the same name is replaced."""
    fs, p = _at(spark, path)
    out = fs.create(p, True)
    try:
        out.write(bytearray(text.encode()))
    finally:
        out.close()


def read_text(spark: SparkSession, path: str) -> str:
    fs, p = _at(spark, path)
    held = fs.open(p)
    try:
        return bytes(spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toByteArray(held)).decode()
    finally:
        held.close()


def rename_path(spark: SparkSession, source: str, target: str) -> bool:
    """Whether ``source`` became ``target``; an existing target stays."""
    fs, p = _at(spark, source)
    to = _at(spark, target)[1]
    return not fs.exists(to) and fs.rename(p, to)


def append_insert_ignore(spark: SparkSession, incoming: DataFrame, target_path: str,
                         keys: list[str], arrival: list[By]) -> tuple[int, int]:
    """Append ``incoming`` to the Parquet table at ``target_path`` with
    ``INSERT ... ON CONFLICT DO NOTHING`` semantics: existing keys are never
    replaced, duplicates inside the batch keep their first arrival.
    Returns (appended, skipped)."""
    target = spark.read.parquet(target_path) if path_exists(spark, target_path) else None
    fresh = insert_ignore(target, incoming, keys, arrival)
    # Materialise the batch result before appending: the anti-join reads
    # the same folder the append writes into. Each run has a folder of its own.
    stage = f"{target_path.rstrip('/')}_incoming_{uuid.uuid4().hex}"
    fresh.write.parquet(stage)
    staged = spark.read.schema(fresh.schema).parquet(stage)
    n = staged.count()
    staged.write.mode("append").parquet(target_path)
    remove_path(spark, stage)
    return n, incoming.count() - n


def remove_path(spark: SparkSession, path: str) -> None:
    """Delete a folder or file on the cluster file system."""
    fs, p = _at(spark, path)
    fs.delete(p, True)
