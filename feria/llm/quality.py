"""Quality rules: measures of a single text, and lines frequent on their host.

Normalised lines (A-Z lower-cased, digits as 0, blanks run together) are
hashed, and a line's distinct documents counted on each host (``source``).
Lines in more than ``LINE_DOCS`` and more than ``LINE_SHARE`` of the host's
distinct documents count as boilerplate and are removed; a document left with
less than ``KEEP_SHARE`` of its words is rejected.

Documents are told apart by their content: exact copies of a page on one host
count once. Near copies are documents of their own; telling them is left to the
near-duplicate operators.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from feria.llm.common import lean, saved, small, word_count

MIN_WORDS = 50
#: At most so many percent of the words may lie in repeated 3-word windows.
MAX_REPEAT_PERCENT = 50
LINE_DOCS = 20
LINE_SHARE = 0.1
KEEP_SHARE = 0.3
#: Parts that the lines of one (host, line) are dealt to.
SALTS = 32
#: Rows that a task measures at one time.
ROWS = 1000

BLANKS = b" \t\n\x0b\x0c\r"
SYMBOLS = b"#*$%&|<>"
CONTINUATION = bytes(range(0x80, 0xC0))
PLAIN = bytes(48 if 48 <= c < 58 else c + 32 if 65 <= c < 91 else c for c in range(256))


def repeat_words(words: list[bytes], window: int = 3) -> int:
    """Words in windows that occur twice or more in the text."""
    n = len(words) - window + 1
    if n < 2:
        return 0
    ids = np.fromiter(map(hash, words), np.int64, len(words)).view(np.uint64)
    key = ids[:n].copy()
    for i in range(1, window):
        key = key * np.uint64(0x9E3779B97F4A7C15) + ids[i: i + n]
    _, back, counts = np.unique(key, return_inverse=True, return_counts=True)
    again = counts[back] > 1
    inside = np.zeros(len(words), bool)
    for i in range(window):
        inside[i: i + n] |= again
    return int(inside.sum())


def measures(text: bytes) -> tuple:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, and of each
    line with a word the normalised hash and the number of words."""
    words = text.split()
    seen, again, hashes, sizes = set(), 0, [], []
    for line in text.split(b"\n"):
        if inside := line.split():
            again += line in seen
            seen.add(line)
            hashes.append(xxhash.xxh64_intdigest(b" ".join(inside).translate(PLAIN)) - (1 << 63))
            sizes.append(len(inside))
    return (len(words), len(text.translate(None, BLANKS + CONTINUATION)), len(text) - len(text.translate(None, SYMBOLS)),
            again, repeat_words(words), hashes, sizes)


MEASURES = ("n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long,"
            " lines array<long>, sizes array<int>")


def _measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    kinds = [*[pa.int64()] * 5, pa.list_(pa.int64()), pa.list_(pa.int32())]
    for batch in itertools.chain.from_iterable((b.slice(at, ROWS) for at in range(0, b.num_rows, ROWS)) for b in batches):
        lean()
        rows = [measures(t.as_py() or b"") for t in batch.column("text").cast(pa.binary())]
        new = [pa.array([r[i] for r in rows], kind) for i, kind in enumerate(kinds)]
        names = ["doc_id", "host", "k1", "k2"]
        yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in names), *new], [*names, *(m.split()[0] for m in MEASURES.split(", "))])
    lean()


def _keys() -> dict[str, Column]:
    """The content of a document: its host, never null, and 128 bits of its text."""
    return {"host": F.when(F.col("source").isNull(), F.lit("")).otherwise(F.concat(F.lit("="), F.col("source").cast("string"))),
            "k1": F.xxhash64("text"), "k2": F.xxhash64(F.lit("content"), F.col("text"))}


def _base_failed() -> Column:
    return (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))


def _measured(docs: DataFrame) -> DataFrame:
    light = docs.select("doc_id", "source", "text").withColumns(_keys()).select("doc_id", "host", "k1", "k2", "text")
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in light.schema if f.name != "text")
    return saved(light.mapInArrow(_measure, f"{schema}, {MEASURES}"), "quality-docs")


def frequent_lines(contents: DataFrame) -> DataFrame:
    """host, line of the lines frequent on their host, of the distinct
    ``contents`` (host, k1, k2, lines)."""
    docs = contents.groupBy("host").agg(F.count("*").alias("docs"))
    seen = contents.select("host", F.explode(F.array_distinct("lines")).alias("line")).groupBy("host", "line").agg(F.count("*").alias("seen"))
    often = seen.where(F.col("seen") > LINE_DOCS).join(docs, "host").where(F.col("seen") > LINE_SHARE * F.col("docs"))
    return saved(often.select("host", "line"), "quality-lines")


def depleted(measured: DataFrame) -> DataFrame:
    """host, k1, k2 of the contents that lose too much with the frequent lines."""
    contents = saved(measured.groupBy("host", "k1", "k2").agg(*[F.first(c).alias(c) for c in ("n_words", "lines", "sizes")]), "quality-contents")
    # A line that most pages of a large host share is one key: salted on both sides.
    frequent = frequent_lines(contents).withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    each = contents.select("host", "k1", "k2", "n_words", F.explode(F.arrays_zip("lines", "sizes")).alias("at"))
    each = each.select("host", "k1", "k2", "n_words", F.col("at.lines").alias("line"), F.col("at.sizes").alias("size"),
                       F.pmod("k1", F.lit(SALTS)).cast("int").alias("salt"))
    lost = each.join(frequent, ["host", "line", "salt"], "left_semi").groupBy("host", "k1", "k2").agg(
        F.first("n_words").alias("n_words"), F.sum("size").alias("lost"))
    left = F.col("n_words") - F.col("lost")
    return saved(lost.where(left < KEEP_SHARE * F.col("n_words")).select("host", "k1", "k2", "lost"), "quality-depleted")


def judge(docs: DataFrame) -> DataFrame:
    """doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
    base_failed and kept of every row of ``docs`` (doc_id, source, text).

    A null text has no words; a null source is a host of its own; repeated rows
    are judged alike; other columns are ignored; an empty table gives no rows.
    """
    measured = _measured(docs)
    lost = depleted(measured)
    judged = measured.drop("lines", "sizes").join(lost, ["host", "k1", "k2"], "left").withColumn("base_failed", _base_failed())
    return judged.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed",
                         (~F.col("base_failed") & F.col("lost").isNull()).alias("kept"))


def kept_documents(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that :func:`judge` keeps, unchanged, with all their
    columns; nulls, empty texts, repeated rows and empty tables as there."""
    measured = _measured(docs)
    rejected = measured.where(_base_failed() & (F.col("n_words") >= MIN_WORDS)).select("host", "k1", "k2").union(
        depleted(measured).drop("lost"))
    rejected = saved(rejected.distinct(), "quality-rejected")
    keys = _keys()
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), *[v.alias(k) for k, v in keys.items()],
                       word_count(F.col("text")).alias("n_words")).where(F.col("n_words") >= MIN_WORDS)
    return rows.join(small(rejected), list(keys), "left_anti").select("row.*")
