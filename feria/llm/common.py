"""Helpers shared by the corpus operators."""

from __future__ import annotations

import ctypes
import os
import tempfile
import uuid

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: A word is a run of anything but blank and \t \n \v \f \r (Java regex).
WORD = r"[^\x20\x09-\x0D]+"


def shared_dir(spark: SparkSession) -> str:
    """The folder in ``spark.checkpoint.dir``, which every executor can reach.

    Only a local session may leave it unset (tests); on a cluster a
    machine-local folder would lose data with its machine, so that raises.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    return os.path.join(tempfile.gettempdir(), "feria-shared")


def saved(df: DataFrame, tag: str) -> DataFrame:
    """Write ``df`` as Parquet to the shared folder and read it back: the
    lineage ends there, and a lost executor costs no recomputation."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/llm-{tag}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def text_bytes(docs: DataFrame) -> int:
    """The UTF-8 bytes of all texts of ``docs``, by one pass over that column."""
    return docs.agg(F.sum(F.octet_length("text").cast("long"))).first()[0] or 0


def packed(df: DataFrame, *extra: Column, name: str = "row") -> DataFrame:
    """All columns of ``df`` in one struct, beside ``extra``: no column of the
    input can clash with a working column."""
    return df.select(F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias(name), *extra)


def doc_columns(docs: DataFrame, *names: str) -> DataFrame:
    return docs.select(*[F.col(f"`{n}`") for n in names])


#: A side of at most so many rows, each of a few numbers, is broadcast.
BROADCAST_ROWS = 500_000
#: The numbers that the arrays of such a side may hold in all.
BROADCAST_NUMBERS = 5_000_000


def small(df: DataFrame, numbers: Column | None = None) -> DataFrame:
    """``df`` with a broadcast hint if it is small; beyond, Spark shuffles.
    ``numbers`` is how many a row holds where it has an array."""
    some = df.select((F.lit(0) if numbers is None else numbers).cast("long").alias("numbers")).limit(BROADCAST_ROWS + 1)
    rows, held = some.agg(F.count("*"), F.coalesce(F.sum("numbers"), F.lit(0))).first()
    return F.broadcast(df) if rows <= BROADCAST_ROWS and held <= BROADCAST_NUMBERS else df


def lean() -> None:
    """In a Python worker: give freed memory back to the system. Workers live
    on between tasks, and what they keep is taken from the next operator's."""
    pa.set_memory_pool(pa.system_memory_pool())
    ctypes.CDLL(None).malloc_trim(0)
