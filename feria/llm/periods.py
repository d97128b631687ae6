"""Periodic runs of words, by enumeration of maximal pairs.

A run of period q from word s to word e is the pair (s, s + q): the suffixes
that start there agree in e - s - q words, at least q, and in no word more, and
the words before them differ. So runs are the maximal pairs whose distance is at
most what they have in common; of those with one start and end, the least
distance is the smallest period, the others are its multiples.

The suffixes of a text are sorted by doubling. The tree of LCP intervals is
walked from the bottom: two neighbouring intervals join at the length l that
they have in common, and the positions of the smaller look up those of the
larger at most l away whose left word is another. Each interval holds its
positions in order, all and by left word; a stretch of one left word is
stepped over in one search, so the work is that of the pairs reported and of
the moves from smaller to larger. Only intervals of at least half the least
length are walked, and texts where no such window repeats are not sorted.
"""

from __future__ import annotations

from bisect import bisect_left, insort
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import ArrayType, LongType, StringType, StructField, StructType

from feria.llm.common import doc_columns
from feria.llm.words import chunks, joined, split

#: The least words of a run.
LEAST = 12
#: Bytes of text that a task works on at one time (a document is never split).
CHUNK_BYTES = 4 << 20

RUN = StructType([StructField(c, LongType()) for c in ("start", "length", "period")])
NEW = [StructField("n_words", LongType()), StructField("runs", ArrayType(RUN)), StructField("collapsed", StringType())]
MIX = np.uint64(0x9E3779B97F4A7C15)


def repeated_windows(codes: np.ndarray, text: np.ndarray, window: int) -> np.ndarray:
    """The texts in which a window of words may occur twice (none is missed)."""
    n = len(codes) - window + 1
    if n < 2:
        return np.zeros(0, np.int64)
    key = text[:n].astype(np.uint64)
    for i in range(window):
        key = (key ^ (key >> np.uint64(29))) * MIX + codes[i: i + n].astype(np.uint64)
    at = np.flatnonzero(text[:n] == text[window - 1:])
    order = at[np.argsort(key[at])]
    same = key[order[1:]] == key[order[:-1]]
    return np.unique(text[order[1:][same]])


def suffixes(words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The suffixes in order, and how many words each has in common with the
    next. Every text in ``words`` ends with a number that occurs once."""
    _, inverse, counts = np.unique(words, return_inverse=True, return_counts=True)
    rank = (np.cumsum(counts) - counts)[inverse]
    levels, step, size = [rank.astype(np.int32)], 1, len(words)
    while True:
        at = np.flatnonzero(np.bincount(rank, minlength=size)[rank] > 1)
        if not len(at):
            break
        key = rank[at] * size + rank[at + step]
        order = np.argsort(key, kind="stable")
        key, old, place = key[order], rank[at][order], np.arange(len(at))
        changed = np.concatenate([[True], key[1:] != key[:-1]])
        began = np.concatenate([[True], old[1:] != old[:-1]])
        rank = rank.copy()
        rank[at[order]] = old + np.maximum.accumulate(np.where(changed, place, 0)) - np.maximum.accumulate(np.where(began, place, 0))
        levels.append(rank.astype(np.int32))
        step *= 2
    order = np.argsort(rank)
    common = np.zeros(size - 1, np.int64)
    for k in reversed(range(len(levels))):
        level = levels[k]
        common += (level[order[:-1] + common] == level[order[1:] + common]).astype(np.int64) << k
    return order, common


class Interval:
    """Positions of an LCP interval, in order, and of each left word."""

    __slots__ = ("at", "by")

    def __init__(self, position: int, left: int):
        self.at, self.by = [position], {left: [position]}


def join(a: Interval, b: Interval, common: int, left: list[int], least: int, found: dict[tuple[int, int], int]) -> Interval:
    """The interval of both; ``found``: the least period by (start, length)."""
    if len(a.at) < len(b.at):
        a, b = b, a
    at, n = a.at, len(a.at)
    for i in b.at:
        own = left[i]
        same = a.by.get(own, ())
        x = bisect_left(at, i - common)
        while x < n and at[x] <= i + common:
            j = at[x]
            if left[j] == own:  # over the stretch of positions with this left word
                y = bisect_left(same, j)
                low, high = 1, min(n - x, len(same) - y)
                while low < high:
                    middle = (low + high) // 2
                    if at[x + middle] == same[y + middle]:
                        low = middle + 1
                    else:
                        high = middle
                x += low
                continue
            x += 1
            period = abs(i - j)
            if period + common >= least:
                key = min(i, j), period + common
                if period < found.get(key, period + 1):
                    found[key] = period
    for i in b.at:
        insort(at, i)
        insort(a.by.setdefault(left[i], []), i)
    return a


def maximal_pairs(words: np.ndarray, least: int) -> dict[tuple[int, int], int]:
    """(start, length) -> period of the runs in ``words`` (see :func:`suffixes`)."""
    order, common = suffixes(words)
    left = np.concatenate([[-1], words[:-1]]).tolist()
    window = (least + 1) // 2
    found: dict[tuple[int, int], int] = {}
    linked = np.concatenate([[False], common >= window, [False]])
    firsts = np.flatnonzero(~linked[:-1] & linked[1:])
    lasts = np.flatnonzero(linked[:-1] & ~linked[1:])
    for a, b in zip(firsts.tolist(), lasts.tolist()):
        part, shared = order[a: b + 1].tolist(), common[a: b].tolist()
        stack, open_at = [Interval(part[0], left[part[0]])], []
        for position, length in zip(part[1:], shared):
            while open_at and open_at[-1] > length:
                last = stack.pop()
                stack[-1] = join(stack[-1], last, open_at.pop(), left, least, found)
            stack.append(Interval(position, left[position]))
            open_at.append(length)
        while open_at:
            last = stack.pop()
            stack[-1] = join(stack[-1], last, open_at.pop(), left, least, found)
    return found


def runs_of(texts: pa.Array, least: int = LEAST) -> tuple[np.ndarray, list[np.ndarray], pa.Array]:
    """Of each text: how many words, its runs (rows of start, length, period, by
    start, then period), and the words outside a run's repeats."""
    words = split(texts)
    sizes = np.diff(words.ends)
    text = np.repeat(np.arange(len(texts)), sizes)
    runs = [np.zeros((0, 3), np.int64)] * len(texts)
    drop = np.zeros(len(words.codes) + 1, np.int64)
    which = repeated_windows(words.codes, text, (least + 1) // 2)
    if len(which):
        chosen = np.zeros(len(texts), bool)
        chosen[which] = True
        picked = chosen[text]
        base = np.insert(words.codes[picked].astype(np.int64) + text[picked] * len(words.distinct),
                         np.cumsum(sizes[which]), -1 - np.arange(len(which)))
        begins = np.cumsum(sizes[which] + 1) - sizes[which] - 1
        found = maximal_pairs(base, least)
        rows = np.array([(s, n, q) for (s, n), q in found.items()], np.int64).reshape(-1, 3)
        rows = rows[np.lexsort((rows[:, 2], rows[:, 0]))]
        owner = np.searchsorted(begins, rows[:, 0], "right") - 1
        rows[:, 0] -= begins[owner]
        cuts = np.searchsorted(owner, np.arange(len(which) + 1))
        for k, i in enumerate(which.tolist()):
            runs[i] = rows[cuts[k]: cuts[k + 1]]
        at = words.ends[which[owner]] + rows[:, 0]
        np.add.at(drop, at + rows[:, 2], 1)
        np.add.at(drop, at + rows[:, 1], -1)
    return sizes, runs, joined(words, np.cumsum(drop)[:-1] == 0)


def find_runs(docs: DataFrame, least: int = LEAST) -> DataFrame:
    """The columns of ``docs`` but text, and n_words, runs (array of start,
    length and period, counted in words from 0, by start, then period) and
    collapsed (the words that lie in no run after its first period, joined by
    one blank).

    A run is a stretch of words with smallest period q, at least ``least`` and 2 q
    words long, that neither neighbour extends. A null or empty text has no
    words and no runs; a text of any length is worked on whole, in memory that
    grows with it; repeated rows stay; an empty table gives no rows; input
    columns named like a new one raise.
    """
    if clash := {c.lower() for c in docs.columns if c != "text"} & {f.name for f in NEW}:
        raise ValueError(f"the input has columns named like results: {sorted(clash)}")
    rest = [f for f in docs.schema.fields if f.name != "text"]
    out = StructType([*rest, *NEW])
    schema = to_arrow_schema(out)
    plain = docs.toDF(*[f"c{i}" for i in range(len(docs.columns))])
    text = f"c{docs.columns.index('text')}"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chunks(batches, text, CHUNK_BYTES):
            sizes, runs, left = runs_of(batch.column(text), least)
            flat = np.concatenate(runs)
            each = pa.StructArray.from_arrays([pa.array(flat[:, i]) for i in range(3)], [f.name for f in RUN])
            lists = pa.ListArray.from_arrays(pa.array(np.cumsum([0, *map(len, runs)]), pa.int32()), each)
            columns = [c for c, name in zip(batch.columns, batch.schema.names) if name != text]
            yield from pa.table([*columns, pa.array(sizes, pa.int64()), lists.cast(schema.field("runs").type), left.cast(pa.string())], schema).to_batches()

    return plain.mapInArrow(run, out)


def planted(docs: DataFrame) -> DataFrame:
    """doc_id, text: every tenth document, by the CRC-32 of its doc_id, made
    periodic from a word on; texts of a null doc_id stay."""
    docs = doc_columns(docs, "doc_id", "text")
    crc = F.crc32(F.col("doc_id").cast("string"))
    hit = (crc % 10 == 0) & F.col("text").isNotNull()
    words = F.when(hit, F.regexp_extract_all("text", F.lit(r"([^\x20\x09-\x0D]+)"), F.lit(1)))
    told = docs.select("doc_id", "text", F.floor(crc / 10).cast("long").alias("g"), words.alias("words")).withColumn("n", F.size("words"))
    size = F.greatest(F.col("n"), F.lit(1))
    told = told.withColumns({"a": (F.col("g") % size).cast("int"), "times": (3 + F.col("g") % 8).cast("int")})
    told = told.withColumn("p", 1 + F.floor((F.col("n") - F.col("a")) / F.col("times")).cast("int"))
    tail = F.slice(F.flatten(F.array_repeat(F.slice("words", F.col("a") + 1, F.col("p")), F.col("times"))), F.lit(1), F.col("n") - F.col("a"))
    text = F.array_join(F.concat(F.slice("words", F.lit(1), F.col("a")), tail), " ")
    return told.select("doc_id", F.when(F.col("n") > 0, text).otherwise(F.col("text")).alias("text"))


def run_report(docs: DataFrame, least: int = LEAST) -> DataFrame:
    """doc_id, n_runs, the longest run (start, length, period, exponent_milli;
    of equals the first, then of the least period; nulls without a run), and
    runs_sha256 and collapsed_sha256, digests of all runs and of what is left.
    See :func:`find_runs` for nulls and empty texts."""
    found = find_runs(doc_columns(docs, "doc_id", "text"), least)
    best = F.array_max(F.transform("runs", lambda r: F.struct(r["length"].alias("length"), (-r["start"]).alias("start"), (-r["period"]).alias("period"))))
    told = found.withColumn("best", best)
    line: Column = F.transform("runs", lambda r: F.concat_ws(",", r["start"].cast("string"), r["length"].cast("string"), r["period"].cast("string")))
    every = F.array_join(F.transform(line, lambda x: F.concat(x, F.lit("\n"))), "")
    return told.select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), (-F.col("best.start")).alias("start"), F.col("best.length").alias("length"),
        (-F.col("best.period")).alias("period"), F.expr("(1000 * best.length) div (-best.period)").alias("exponent_milli"),
        F.sha2(every, 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"))
