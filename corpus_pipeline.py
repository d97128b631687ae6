"""The corpus pipeline: quality rules, line dedup, SimHash near-dedup, mixing
to target weights, BPE encoding and decoding.

Each stage is (spark, docs, sf_dir) -> DataFrame; all but the last keep the
columns of ``documents``. Between stages the rows are written as Parquet.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from feria.llm import bpe, line_dedup, mixing, quality, simhash
from feria.llm.common import saved
from feria.llm.queries import bpe_path


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the base measures or the line frequency reject go."""
    return quality.kept_documents(docs)


def line_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines that repeat an earlier one go; documents stay, maybe empty."""
    return line_dedup.deduped(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays, the least doc_id."""
    return simhash.one_of_each(docs, shingle=4, bits=4)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as its source's target asks; see ``mixing``."""
    return mixing.mixed_corpus(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, source, ids, n_tokens and the digests of ids and decoded text."""
    return bpe.encode(spark, docs.select("doc_id", "source", "text"), bpe_path(), digests=True)


STAGES = [
    ("quality rules", quality_rules),
    ("line dedup", line_dedup_stage),
    ("SimHash near-dedup", near_dedup),
    ("mixing", mix),
    ("BPE encoding and decoding", encode),
]
#: No stage but the line dedup can be written in SQL; the tests hold the
#: pipeline against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages in order over the whole of ``documents``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = saved(stage(spark, docs, sf_dir), "pipeline-" + name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
