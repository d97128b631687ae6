"""Raw file readers with explicit schemas (no inference)."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from feria.schemas import MULTILINE_TABLES, RAW
from feria.sources.quoted_csv import quoted_records
from feria.sources.sinks import path_exists

# Default raw file name of each table; pass ``files=`` to read_raw_dir when
# the export uses other names.
RAW_FILES = {t: f"{t}.csv" for t in RAW}


# Holds the text of a row that does not fit the schema, NULL in good rows.
CORRUPT = "_corrupt_record"


def _reader(spark: SparkSession):
    return (spark.read.option("header", True).option("escape", '"')
            .option("mode", "PERMISSIVE").option("encoding", "UTF-8"))


def check_header(spark: SparkSession, path: str, table: str) -> None:
    """Raise unless the file's header has the declared columns in order."""
    found = [c.lstrip("\ufeff") for c in _reader(spark).csv(path).columns]
    if found != RAW[table].names:
        raise ValueError(f"{table}: the header of {path} is {found}, not {RAW[table].names}")


def read_csv_checked(spark: SparkSession, path: str, table: str) -> DataFrame:
    """One raw CSV with its declared schema and the corrupt-record column.

    The header has to match the schema. A row whose fields do not fit, are too
    few or too many, keeps its text in ``_corrupt_record``; a UTF-8 byte-order
    mark is dropped by the reader. Quoted fields hold line breaks in the reviews
    file only; its records are put together first (``quoted_records``), so that
    all files are read by many tasks.
    """
    check_header(spark, path, table)
    schema = StructType([*RAW[table].fields, StructField(CORRUPT, StringType())])
    if table in MULTILINE_TABLES:
        options = {"escape": '"', "mode": "PERMISSIVE", "multiLine": "true", "columnNameOfCorruptRecord": CORRUPT}
        ddl = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema)
        return quoted_records(spark, path).select(F.from_csv("record", ddl, options).alias("r")).select("r.*")
    return (_reader(spark).schema(schema).option("columnNameOfCorruptRecord", CORRUPT)
            .csv(path))


def read_csv(spark: SparkSession, path: str, table: str) -> DataFrame:
    """The good rows of :func:`read_csv_checked`, in the declared columns."""
    df = read_csv_checked(spark, path, table)
    return df.where(F.col(CORRUPT).isNull()).select(*RAW[table].names)


def read_csv_rejects(spark: SparkSession, path: str, table: str) -> DataFrame:
    """(table, record) of the rows that do not fit."""
    df = read_csv_checked(spark, path, table)
    # Spark parses no field for a query on the record column alone: name them.
    parsed = F.to_json(F.struct(*RAW[table].names)).isNotNull()
    return df.where(F.col(CORRUPT).isNotNull()).select(
        F.lit(table).alias("table"), F.when(parsed, F.col(CORRUPT)).alias("record"))


def read_raw_dir(spark: SparkSession, raw_dir: str,
                 files: dict[str, str] | None = None) -> dict[str, DataFrame]:
    """All raw tables found in ``raw_dir`` (absent files are skipped);
    ``files`` maps table -> file name, defaulting to ``<table>.csv``."""
    out = {}
    for table, fname in {**RAW_FILES, **(files or {})}.items():
        p = os.path.join(raw_dir, fname)
        if path_exists(spark, p):
            out[table] = read_csv(spark, p, table)
    return out


def read_raw_rejects(spark: SparkSession, raw_dir: str,
                     files: dict[str, str] | None = None) -> DataFrame:
    """(table, record): the rows of all raw files that do not fit."""
    out = spark.createDataFrame([], "table string, record string")
    for table, fname in {**RAW_FILES, **(files or {})}.items():
        p = os.path.join(raw_dir, fname)
        if path_exists(spark, p):
            out = out.unionByName(read_csv_rejects(spark, p, table))
    return out
