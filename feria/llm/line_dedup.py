"""Line dedup by an edit-distance join over segments, in DataFrame functions only.

Lines are compared trimmed, with A-Z lower-cased. A line is removed where an
earlier one (by doc_id, then place) is equal, and everywhere if a different
line that first occurs earlier is within ``EDITS`` edits.

Of distinct lines within ``t`` edits, one keeps at least one of its ``t + 1``
even segments. The segments of each line are its index entries, with its length
and the segment's number; a line probes, for each length up to ``t`` below its
own, the substrings that a segment can have become: of those at the segment's
start plus ``o``, the ``i``-th segment only where ``|o| <= i`` and
``|o - (difference of lengths)| <= t - i``.

An entry also carries a check of what is left beside its segment. Where one
edit at most can be there, one half of that part is intact: the first as seen
from the part's start, or the second as seen from its end. Pairs without that
are dropped inside the join, so that many lines with a common segment do not
become as many pairs. The pairs left are verified with
the banded edit distance of Spark.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from feria.llm.common import packed, saved, small

EDITS = 1
#: Shorter lines, in code points, are compared for equality only.
LEAST_LENGTH = 16
#: Bits of the hash of a half.
BITS = 31
BLANKS = " \t\n\x0b\x0c\r"
#: Where a line stands: the order of occurrences.
AT = ["none", "doc_id", "content", "place"]
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def _content(text: Column) -> Column:
    return F.xxhash64(text)


def _plain(line: Column) -> Column:
    """A line as it is compared. ``translate`` looks every letter up, so ASCII
    lines, where it is the same, are lower-cased at once."""
    low = F.when(F.length(line) == F.octet_length(line), F.lower(line)).otherwise(F.translate(line, UPPER, LOWER))
    return F.btrim(low, F.lit(BLANKS))


def lines(docs: DataFrame) -> DataFrame:
    """none, doc_id, content, place, line: every line that is not blank, as it
    is compared; (none, doc_id, content, place) orders the occurrences."""
    each = docs.select(F.col("doc_id").isNull().alias("none"), "doc_id", _content(F.col("text")).alias("content"),
                       F.posexplode(F.transform(F.split("text", "\n"), _plain)).alias("place", "line"))  # in the array: a filter on _plain would run it again
    return each.where("line <> ''")


def hashed(rows: DataFrame) -> DataFrame:
    return rows.withColumns({"h1": F.xxhash64("line"), "h2": F.xxhash64(F.lit("line"), F.col("line"))})


def _check(start: Column, end: Column, size: Column) -> Column:
    """Short hashes of two halves of the line between two places, one seen from
    the start, one from the end; the part has ``size`` characters in the indexed
    line."""
    half = F.shiftright(size, 1)
    rest = size - half
    mask = F.lit((1 << BITS) - 1).cast("long")
    first = F.xxhash64(F.substring("line", start + 1, half)).bitwiseAND(mask)
    second = F.xxhash64(F.substring("line", end - rest + 1, rest)).bitwiseAND(mask)
    return first.bitwiseOR(F.shiftleft(second, BITS))


def _near(a: Column, b: Column) -> Column:
    """Whether the checks have a half in common."""
    differ = a.bitwiseXOR(b)
    mask = (1 << BITS) - 1
    return (differ.bitwiseAND(F.lit(mask).cast("long")) == 0) | (differ.bitwiseAND(F.lit(mask << BITS).cast("long")) == 0)


def _segmented(rows: DataFrame, edits: int) -> DataFrame:
    """``rows`` with start and seg (size) of each segment of lines that are up to
    ``edits`` shorter than ``size``. They are columns, as the entries ask for them
    many times: written out in each, they make Spark's generated method so long
    that the JVM does not compile it, and every line is interpreted."""
    count = edits + 1
    for shorter in range(count):
        length = F.col("size") - shorter
        rows = rows.withColumns({f"base{shorter}": F.floor(length / count).cast("int"), f"rest{shorter}": F.pmod(length, F.lit(count))})
    places = {}
    for shorter in range(count):
        base, rest = F.col(f"base{shorter}"), F.col(f"rest{shorter}")
        for i in range(count):
            places[f"start{shorter}_{i}"] = base * i + F.greatest(F.lit(0), rest - (count - i))
            places[f"seg{shorter}_{i}"] = base + (rest >= count - i).cast("int")
    return rows.withColumns(places)


def _entries(edits: int) -> list[tuple[Column, Column, bool]]:
    """(key, check, whether it is an index entry): the entries of a line of
    ``size`` characters, its segments told by :func:`_segmented`."""
    out = []
    full = F.col("size")
    for shorter in range(edits + 1):
        length = full - shorter
        for i in range(edits + 1):
            start, size = F.col(f"start{shorter}_{i}"), F.col(f"seg{shorter}_{i}")
            for o in range(max(-i, shorter - (edits - i)), min(i, shorter + edits - i) + 1):
                key = F.xxhash64(length, F.lit(i), F.substring("line", start + o + 1, size))
                if edits - i == 1:  # one edit at most to the right
                    check = _check(start + o + size, full, length - start - size)
                elif i == 1:  # to the left
                    check = _check(F.lit(0), start + o, start)
                else:
                    check = F.lit(0).cast("long")
                out.append((key, check, shorter == 0 and o == 0))
    return out


def near_lines(each: DataFrame, edits: int, least: int) -> DataFrame:
    """h1, h2 of the lines that a different line that occurs earlier is within
    ``edits`` of; ``each`` has all lines with their entries (k0, c0, ...)."""
    kinds = [index for _, _, index in _entries(edits)]
    distinct = each.where(F.col("size") >= least).groupBy("h1").agg(
        *[F.max(f"{c}{i}").alias(f"{c}{i}") for i in range(len(kinds)) for c in "kc"])
    entries = distinct.select("h1", F.explode(F.array(*[
        F.struct(F.col(f"k{i}").alias("key"), F.col(f"c{i}").alias("check"), F.lit(index).alias("index")) for i, index in enumerate(kinds)])).alias("e"))
    index = entries.where("e.index").select(F.col("h1").alias("a"), F.col("e.check").alias("ca"), F.col("e.key").alias("key"))
    probe = entries.select(F.col("h1").alias("b"), F.col("e.check").alias("cb"), F.col("e.key").alias("key2"))
    met = index.join(probe, (F.col("key") == F.col("key2")) & (F.col("a") != F.col("b")) & _near(F.col("ca"), F.col("cb")))
    pairs = saved(met.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "lines-pairs")
    asked = saved(pairs.select(F.explode(F.array("a", "b")).alias("h1")).distinct(), "lines-asked")
    # Two lines of one h1 are two rows here, each checked by its own text.
    told = each.join(small(asked), "h1", "left_semi").groupBy("h1", "h2").agg(F.min(F.struct(*AT)).alias("first"), F.first("line").alias("line"))
    told = saved(told, "lines-told")

    def side(name: str) -> DataFrame:
        return told.select(F.col("h1").alias(name), F.struct("h1", "h2").alias(f"key_{name}"), F.col("first").alias(f"first_{name}"), F.col("line").alias(f"line_{name}"))

    both = pairs.join(side("a"), "a").join(side("b"), "b").where(F.levenshtein("line_a", "line_b", edits) >= 0)
    later = F.when(F.col("first_a") > F.col("first_b"), F.col("key_a")).otherwise(F.col("key_b"))
    return saved(both.select(later.alias("later")).select("later.*").distinct(), "lines-near")


def with_entries(each: DataFrame, edits: int, least: int) -> DataFrame:
    """``each`` with the size of the line, and its entries k0, c0, k1, c1, ...;
    null for lines shorter than ``least``."""
    sized = each.withColumn("size", F.length("line"))  # counted once: each substring asks for it
    entries = [F.when(F.col("size") >= least, e[n]).alias(f"{c}{i}") for i, e in enumerate(_entries(edits)) for n, c in enumerate("kc")]
    return _segmented(sized, edits).select(*sized.columns, *entries)


def removals(docs: DataFrame, edits: int = EDITS, least: int = LEAST_LENGTH) -> DataFrame:
    """Of each document (none, doc_id, content) of ``docs`` that loses lines:
    exact and near (how many) and places (which, from 0)."""
    each = saved(with_entries(hashed(lines(docs)), edits, least), "lines-each")
    near = near_lines(each, edits, least).withColumn("near", F.lit(True))
    each = each.select(*AT, "h1", "h2")
    firsts = each.groupBy("h1", "h2").agg(F.min(F.struct(*AT)).alias("first"), F.count("*").alias("n"))
    marks = firsts.join(near, ["h1", "h2"], "left").where("n > 1 OR near")
    marks = saved(marks.select("h1", "h2", "first", F.coalesce("near", F.lit(False)).alias("near")), "lines-marks")
    later = F.struct(*AT) != F.col("first")
    gone = each.join(marks, ["h1", "h2"]).where(later | F.col("near"))
    gone = gone.groupBy("none", "doc_id", "content").agg(
        F.count_if(later).alias("exact"), F.count_if(~later).alias("near"), F.array_sort(F.collect_list("place")).alias("places"))
    return saved(gone, "lines-gone")


def _joined(rows: DataFrame, gone: DataFrame) -> DataFrame:
    """``rows`` (none, id, content, ...) with what they lose."""
    told = gone.select(F.col("none").alias("g0"), F.col("doc_id").alias("g1"), F.col("content").alias("g2"), "exact", "near", "places")
    return rows.join(told, F.expr("none = g0 AND id <=> g1 AND content = g2"), "left")


def line_report(docs: DataFrame, edits: int = EDITS) -> DataFrame:
    """doc_id, n_lines (that are not blank), n_exact and n_near (removed as equal
    to an earlier line, or near a different one), and removed (their places).

    A null text has no lines; blank lines are never removed; ties are broken by
    the order of occurrences, null doc_ids last; rows that repeat doc_id and
    text are one document, and treated alike; other columns are ignored; an
    empty table gives no rows.
    """
    docs = docs.select("doc_id", "text")
    gone = removals(docs, edits)
    full = F.filter(F.split(F.coalesce("text", F.lit("")), "\n"), lambda x: F.ltrim(x, F.lit(BLANKS)) != "")
    rows = docs.select(F.col("doc_id").isNull().alias("none"), F.col("doc_id").alias("id"), _content(F.col("text")).alias("content"),
                       F.size(full).cast("long").alias("n_lines"))
    zero = F.lit(0)
    return _joined(rows, gone).select(
        F.col("id").alias("doc_id"), "n_lines", F.coalesce("exact", zero).alias("n_exact"), F.coalesce("near", zero).alias("n_near"),
        F.coalesce("places", F.array().cast("array<int>")).alias("removed"))


def deduped(docs: DataFrame, edits: int = EDITS) -> DataFrame:
    """``docs`` without the removed lines; n_chars, where it exists, follows.
    A document that loses every line stays, with an empty text; see
    :func:`line_report` for the rest."""
    gone = removals(docs.select("doc_id", "text"), edits)
    rows = packed(docs, F.col("doc_id").isNull().alias("none"), F.col("doc_id").alias("id"), _content(F.col("text")).alias("content"))
    out = _joined(rows, small(gone, F.size("places"))).select("row", "places", F.when(F.col("places").isNotNull(), F.split("row.text", "\n")).alias("lines"))
    left = F.array_except(F.sequence(F.lit(0), F.size("lines") - 1), "places")  # by a set: linear in the lines
    text = F.array_join(F.transform(left, lambda i: F.get("lines", i)), "\n")
    out = out.select("row", "places", F.when(F.col("places").isNull(), F.col("row.text")).otherwise(text).alias("text"))
    new = {"text": F.col("text")}
    if "n_chars" in docs.columns:
        new["n_chars"] = F.when(F.col("places").isNull(), F.col("row.n_chars")).otherwise(F.length("text").cast(docs.schema["n_chars"].dataType))
    return out.select(*[new.get(c, F.col(f"row.`{c}`")).alias(c) for c in docs.columns])
