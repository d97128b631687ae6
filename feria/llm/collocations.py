"""Phrase collocations by stripes: of each prefix, a counter of next words.

A stripe is a prefix of up to four words with the words that follow it and how
often. Each task makes the stripes of its texts; merged elementwise, their
entries are the phrases and their counts. A cut's parts and the prefix of a
phrase are themselves entries, of shorter stripes; what contains a phrase with
one word more is an entry of its own stripe, or of the stripe of its prefix
behind one more word. So extensions, totals and the most frequent longer phrase
are all read from the merged stripes.

The stripes are made from the shortest prefix on. A phrase is only counted where
the two phrases it has without its last and its first word are frequent. Those
sets go to the tasks as bits of their hashes, at most ``MAX_BITS``: another
phrase on the same bit is counted in vain, and none is missed. Counts are exact
whatever the bits. The stripes themselves are shuffled. Those of a prefix with
more than one in ``HEAVY`` of all words, fewer than ``HEAVY`` of them, are cut by
next word into ``SLOTS`` parts first, so that no task merges a whole one.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from feria.llm.common import doc_columns, saved
from feria.llm.words import byte_classes, chunks, split

WORDS = 5
LEAST = 100
TOP = 2000
#: A phrase goes if a longer one around it has this share of its count.
SHARE_PERCENT = 100
#: Bits that a task is sent for the frequent phrases of one length.
BITS_EACH, MAX_BITS = 16, 1 << 30
#: Bytes of text that a task works on at one time (a document is never split).
CHUNK_BYTES = 8 << 20
#: Parts that a language's ranking is cut into before the last one.
PARTS = 64
#: A prefix is heavy from this part of all words on; and the parts of its stripe.
HEAVY, SLOTS = 1000, 256

CLASSES = byte_classes(b" \t", b".,;:!?\n\x0b\x0c\r")
MIX = np.uint64(0x9E3779B97F4A7C15)
STRIPE = "lang string, prefix string, slot int, next string, n array<int>"
#: The bits that a row of Spark's bitmap functions holds.
ROW_BITS = 32768


def _hashes(words: list[bytes]) -> np.ndarray:
    return np.fromiter(map(xxhash.xxh64_intdigest, words), np.uint64, len(words))


def _fold(key: np.ndarray, word: np.ndarray) -> np.ndarray:
    """The hash of a phrase from that of the phrase without its last word."""
    return ((key ^ (key >> np.uint64(29))) * MIX) ^ word


def _bit(key: np.ndarray, bits: int) -> np.ndarray:
    """The bit of a phrase's hash; ``bits`` is a power of two."""
    return ((key * MIX) >> np.uint64(65 - bits.bit_length())).astype(np.int64)


def stripes(texts: pa.Array, langs: pa.Array, size: int, known: tuple[np.ndarray, int, np.ndarray] | None) -> pa.RecordBatch:
    """The stripes of the prefixes of ``size`` - 1 words in ``texts``, next words
    joined by a blank. ``known``: the bits of the frequent phrases of that
    length, how many bits, and the hashes of the heavy ones."""
    words = split(texts, CLASSES, lower=True)
    coded = langs.dictionary_encode()
    lang = np.repeat(coded.indices.to_numpy(), np.diff(words.ends)).astype(np.int64)
    codes, n = words.codes.astype(np.int64), len(words.codes)
    at = np.flatnonzero(words.piece[: max(0, n - size + 1)] == words.piece[size - 1:])
    hashed = _hashes(words.distinct.to_pylist())
    if known is not None:
        frequent, bits, heavy = known
        ends = max(0, n - size + 2)
        hash_at = _hashes([x.encode() for x in coded.dictionary.to_pylist()])[lang[:ends]]
        for i in range(size - 1):
            hash_at = _fold(hash_at, hashed[codes[i: i + ends]])
        bit = _bit(hash_at, bits)
        alive = (frequent[bit >> 3] >> (bit & 7).astype(np.uint8)) & 1
        at = at[(alive[at] & alive[at + 1]).astype(bool)]
    many = max(1, len(words.distinct))
    key = lang[at]
    for i in range(size):  # numbered anew at each word, so that the key fits
        key = np.unique(key, return_inverse=True)[1] * many + codes[at + i]
    phrases, first, counts = np.unique(key, return_index=True, return_counts=True)
    following = phrases % many
    prefix = np.cumsum(np.diff(phrases // many, prepend=-1) > 0) - 1
    wide = np.ones(len(phrases), bool) if known is None else np.isin(hash_at[at[first]], heavy)
    slot = np.where(wide, (hashed[following] % np.uint64(SLOTS)).astype(np.int64), 0)
    order = np.argsort(prefix * SLOTS + slot, kind="stable")
    prefix, slot, following, first, counts = prefix[order], slot[order], following[order], first[order], counts[order]
    starts = np.flatnonzero((np.diff(prefix, prepend=-1) != 0) | (np.diff(slot, prepend=-1) != 0))
    begin = at[first[starts]]

    def joined(each: np.ndarray, cuts: np.ndarray) -> pa.Array:
        lists = pa.ListArray.from_arrays(pa.array(cuts, pa.int32()), words.distinct.take(pa.array(each, pa.int64())))
        return pc.binary_join(lists, pa.scalar(b" ", pa.binary())).cast(pa.string())

    cuts = np.append(starts, len(phrases))
    before = codes[(begin[:, None] + np.arange(size - 1)).ravel()]
    return pa.RecordBatch.from_arrays(
        [coded.dictionary.take(pa.array(lang[begin])).cast(pa.string()), joined(before, np.arange(len(begin) + 1) * (size - 1)),
         pa.array(slot[starts], pa.int32()), joined(following, cuts),
         pa.ListArray.from_arrays(pa.array(cuts, pa.int32()), pa.array(counts, pa.int32()))],
        ["lang", "prefix", "slot", "next", "n"])


def merged(docs: DataFrame, size: int, known=None) -> DataFrame:
    """lang, prefix, next, n: the merged stripes of (lang, text), entry by entry."""
    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        told = known and known.value
        told = told and (np.frombuffer(told[0], np.uint8), told[1], np.array(told[2], np.uint64))
        for batch in chunks(batches, "text", CHUNK_BYTES):
            yield stripes(batch.column("text"), batch.column("lang"), size, told)

    dealt = docs.mapInArrow(make, STRIPE).repartition("lang", "prefix", "slot")
    entries = dealt.select("lang", "prefix", "slot", F.inline(F.arrays_zip(F.split("next", " ").alias("next"), "n")))
    return entries.groupBy("lang", "prefix", "slot", "next").agg(F.sum("n").alias("n")).drop("slot")


def _phrase() -> Column:
    return F.when(F.col("prefix") == "", F.col("next")).otherwise(F.concat_ws(" ", "prefix", "next"))


def _hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The hash of each row's phrase; a batch holds phrases of one length."""
    for batch in batches:
        lists = pc.split_pattern(batch.column("phrase").cast(pa.binary()), b" ")
        sizes = lists.value_lengths().to_numpy()
        key = _hashes([x.encode() for x in batch.column("lang").to_pylist()])
        if len(key):
            word = _hashes(lists.flatten().to_pylist()).reshape(len(key), sizes[0])
            for i in range(sizes[0]):
                key = _fold(key, word[:, i])
        yield pa.RecordBatch.from_arrays([pa.array(key.view(np.int64)), batch.column("a")], ["key", "a"])


def _known(phrases: DataFrame, totals: DataFrame, count: int) -> tuple[bytes, int, list[int]]:
    """Of the ``count`` frequent ``phrases`` of one length: the bits of their
    hashes, how many bits, and the hashes of the heavy ones."""
    bits = min(MAX_BITS, max(ROW_BITS, 1 << (BITS_EACH * count - 1).bit_length()))
    hashed = saved(phrases.select("lang", "phrase", "a").mapInArrow(_hashed, "key long, a long"), "phrases-hashes")

    def places(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            bit = _bit(batch.column("key").to_numpy().view(np.uint64), bits)
            yield pa.RecordBatch.from_arrays([pa.array(bit // ROW_BITS), pa.array(bit % ROW_BITS)], ["row", "bit"])

    rows = hashed.mapInArrow(places, "row long, bit long").groupBy("row").agg(F.bitmap_construct_agg("bit").alias("held"))
    out = bytearray(bits // 8)
    for r in rows.toLocalIterator():
        out[r.row * ROW_BITS // 8: (r.row + 1) * ROW_BITS // 8] = r.held
    whole = totals.agg(F.sum("n")).first()[0] or 0
    heavy = hashed.where(F.col("a") > whole // HEAVY).select("key").collect()  # at most HEAVY, as whole counts each once
    return bytes(out), bits, [r.key & (1 << 64) - 1 for r in heavy]


def phrase_counts(docs: DataFrame, words: int = WORDS, least: int = LEAST) -> tuple[DataFrame, DataFrame]:
    """(lang, phrase, words, a) of the phrases of up to ``words`` words that
    occur ``least`` times or more, and (lang, n), all word occurrences."""
    spark = docs.sparkSession
    light = docs.select(F.coalesce(F.col("lang").cast("string"), F.lit("und")).alias("lang"), "text")
    single = saved(merged(light, 1), "phrases-words")
    totals = saved(single.groupBy("lang").agg(F.sum("n").alias("n")), "phrases-totals")
    found, held = [], None
    for size in range(1, words + 1):
        if size > 1:
            known = spark.sparkContext.broadcast(_known(found[-1], totals, held))
            single = merged(light, size, known)
        kept = single.where(F.col("n") >= least).select("lang", _phrase().alias("phrase"), F.lit(size).alias("words"), F.col("n").alias("a"))
        found.append(saved(kept, f"phrases-{size}"))
        held = found[-1].count()
        if size > 1:
            known.destroy()
        if not held:
            break
    out = found[0]
    for more in found[1:]:
        out = out.union(more)
    return out, totals


def collocations(docs: DataFrame, words: int = WORDS, least: int = LEAST, share: int = SHARE_PERCENT, top: int = TOP) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score: the ``top`` phrases of each lang.

    ``docs`` is (lang, text); a null lang is ``und``, a null text has no words,
    repeated rows count, other columns are ignored, an empty table gives no rows.
    A phrase scores 1000 a n / (l r), rounded down, at its lowest cut (the first
    of equals). It is left out if a longer frequent phrase around it has
    ``share`` percent of its count. Ties are ranked by count, then by bytes.
    """
    counts, totals = phrase_counts(doc_columns(docs, "lang", "text"), words, least)
    return ranked(counts, totals, share, top)


def ranked(counts: DataFrame, totals: DataFrame, share: int, top: int) -> DataFrame:
    """The result from the counts and totals of :func:`phrase_counts`."""
    parts = F.split("phrase", " ")
    long = counts.where("words > 1").withColumn("cut", F.explode(F.sequence(F.lit(1), F.col("words") - 1)))
    cuts = long.select("lang", "phrase", "words", "a", "cut", F.array_join(F.slice(parts, F.lit(1), F.col("cut")), " ").alias("first"),
                       F.array_join(F.slice(parts, F.col("cut") + 1, F.col("words") - F.col("cut")), " ").alias("rest"))
    cuts = saved(cuts, "phrases-cuts")
    part = counts.select("lang", "phrase", "a")
    both = cuts.join(part.toDF("lang", "first", "l"), ["lang", "first"]).join(part.toDF("lang", "rest", "r"), ["lang", "rest"]).join(totals, "lang")
    exact = {c: F.col(c).cast("decimal(19,0)") for c in ("a", "l", "r", "n")}
    over, under = (exact["a"] * F.lit(1000).cast("decimal(4,0)")) * exact["n"], exact["l"] * exact["r"]
    scored = both.select("lang", "phrase", "a", "n", "l", "r", "cut", over.alias("over"), under.alias("under")).withColumn("score", F.expr("over div under"))
    lowest = scored.groupBy("lang", "phrase", "a", "n").agg(F.min(F.struct("score", "cut", "l", "r")).alias("low"))
    around = cuts.where("cut = words - 1").select("lang", F.col("first").alias("phrase"), "a").union(
        cuts.where("cut = 1").select("lang", F.col("rest").alias("phrase"), "a"))
    around = around.groupBy("lang", "phrase").agg(F.max("a").alias("longer"))
    left = lowest.join(around, ["lang", "phrase"], "left").where(
        F.col("longer").isNull() | (100 * F.col("longer") < share * F.col("a")))
    told = left.select("lang", "phrase", "a", "low.l", "low.r", "n", "low.score")
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    # The best of each part first, so that no task sorts all phrases of a lang.
    told = told.withColumn("part", F.pmod(F.hash("phrase"), F.lit(PARTS)))
    told = told.withColumn("rank", F.row_number().over(Window.partitionBy("lang", "part").orderBy(*order))).where(F.col("rank") <= top)
    told = told.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("long")).where(F.col("rank") <= top)
    return told.select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
