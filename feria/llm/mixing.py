"""Mixing sources to target weights by entropy balancing.

Every document starts at rate 1. Within a source the rates nearest to that in
relative entropy, between 0 and ``CAP`` and with the source's target as their
token total, are ``CAP * sigmoid(c + lambda * size)``: the odds of a document
are tilted exponentially by its size. ``lambda`` solves the convex dual of
the source; Newton steps, kept inside a bracket, solve all duals at once, each
step one aggregate over the table of distinct (source, size).

Rates become whole copies by error diffusion over the sizes of a source, so
that its tokens miss the target by at most one document, and one partial copy
in each source takes up what is left.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from feria.llm.common import packed, saved, word_count

#: The most copies of a document.
CAP = 3
#: Weights of the sources by code point, repeating.
WEIGHTS = (5.0, 2.0, 1.0)
#: Documents of one source and size are dealt over so many hash buckets.
BUCKETS = 256
MAX_STEPS = 80
#: Newton steps between two looks at the gap.
STEPS = 4
START = math.log(1 / (CAP - 1))  # the odds of rate 1


def _before(rows: DataFrame, order: list, **sums: str) -> DataFrame:
    """``rows`` with the sum of a column over all rows before it in ``order``, for
    each ``name=column`` of ``sums``. The rows are sorted in ranges, each in a task
    of its own; only one row a range is sorted as a whole."""
    ranged = saved(rows.repartitionByRange(*order).withColumn("range", F.spark_partition_id()), "mixing-ranges")
    ahead = Window.orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    starts = ranged.groupBy("range").agg(*[F.sum(c).alias(n) for n, c in sums.items()])
    starts = starts.select("range", *[F.coalesce(F.sum(n).over(ahead), F.lit(0)).alias(f"{n}_ahead") for n in sums])
    here = Window.partitionBy("range").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    ranged = ranged.join(starts, "range")
    return ranged.withColumns({n: F.coalesce(F.sum(c).over(here), F.lit(0)) + F.col(f"{n}_ahead") for n, c in sums.items()}).select(*rows.columns, *sums)


def targets(sizes: DataFrame) -> DataFrame:
    """source, source_size, target from (source, size, docs): shares by weight
    of 100 % of all words, stopped at ``CAP`` times the source's size, the
    excess reshared by weight until none is above.

    One row per source, numbered in code point order, null last. With the
    sources in order of ``most / weight``, the unit share left when the first k
    of them have stopped is greatest at the right k."""
    per = sizes.groupBy("source").agg(F.sum(F.col("size") * F.col("docs")).alias("source_size"))
    per = _before(per.withColumn("one", F.lit(1).cast("long")), [F.col("source").asc_nulls_last()], number="one")
    weight = F.element_at(F.array(*map(F.lit, WEIGHTS)), (F.col("number") % len(WEIGHTS) + 1).cast("int"))
    per = per.select("source", "source_size", weight.alias("weight"), (F.col("source_size") * float(CAP)).alias("most"))
    per = per.withColumn("share", F.col("most") / F.col("weight"))
    per = saved(_before(per, [F.col("share"), F.col("source").asc_nulls_last()], stopped="most", passed="weight"), "mixing-sources")
    whole = per.agg(F.sum("source_size").alias("words"), F.sum("weight").alias("weights")).first()
    unit = (whole.words - F.col("stopped")) / (whole.weights - F.col("passed")) if whole.words is not None else F.lit(0.0)
    level = per.agg(F.coalesce(F.max(unit), F.lit(0.0)).alias("level")).first().level
    return per.select("source", "source_size", F.least(F.col("most"), F.lit(level) * F.col("weight")).alias("target"))


def _rate():
    return CAP / (1 + F.exp(-(F.lit(START) + F.col("tilt") * F.col("size") / F.col("scale"))))


def solve(sizes: DataFrame) -> DataFrame:
    """source, source_size, target, scale, tilt: the dual solution of every
    source, ``sizes`` being (source, size, docs)."""
    words = F.col("size") * F.col("docs")
    scale = sizes.groupBy("source").agg(F.sum(F.col("size") * words).alias("squares"))
    none = F.lit(None).cast("double")
    state = saved(targets(sizes).join(scale.withColumnRenamed("source", "s2"), F.expr("source <=> s2"))
                  .select("source", "source_size", "target",
                          F.greatest(F.lit(1.0), F.coalesce(F.try_divide(F.col("squares"), F.col("source_size")), F.lit(1.0))).alias("scale"),
                          F.lit(0.0).alias("tilt"), none.alias("low"), none.alias("high"), none.alias("miss")), "mixing-dual")
    for _ in range(MAX_STEPS // STEPS):
        for _ in range(STEPS):
            state = _step(sizes, state)
        state = saved(state, "mixing-dual")
        if not state.where(F.abs("miss") > F.greatest(F.lit(0.01), F.col("target") * 1e-9)).limit(1).count():
            return state
    raise ArithmeticError(f"the dual did not converge in {MAX_STEPS} steps")


def _step(sizes: DataFrame, state: DataFrame) -> DataFrame:
    """One Newton step of every source's dual; ``miss`` is the gap before it."""
    words = F.col("size") * F.col("docs") * F.col("rate")
    kept = ["source_size", "target", "scale", "tilt", "low", "high"]
    at = (sizes.withColumnRenamed("source", "s2").join(state.drop("miss"), F.expr("source <=> s2"))
          .withColumn("rate", _rate()).groupBy("source")
          .agg(F.sum(words).alias("got"), F.sum(words * F.col("size") / F.col("scale") * (1 - F.col("rate") / CAP)).alias("slope"),
               *[F.first(c).alias(c) for c in kept]).withColumn("miss", F.col("got") - F.col("target")))
    at = (at.withColumn("low", F.when(F.col("miss") < 0, F.col("tilt")).otherwise(F.col("low")))
          .withColumn("high", F.when(F.col("miss") > 0, F.col("tilt")).otherwise(F.col("high"))))
    newton = F.col("tilt") - F.try_divide(F.col("miss"), F.col("slope"))
    inside = (newton > F.coalesce("low", F.lit(-math.inf))) & (newton < F.coalesce("high", F.lit(math.inf)))
    wider = F.col("tilt") - F.signum("miss") * (1 + F.abs("tilt"))
    near = F.abs(newton - F.col("tilt")) <= 4 * (1 + F.abs("tilt"))
    halved = F.coalesce((F.col("low") + F.col("high")) / 2, wider)
    done = F.abs("miss") <= F.greatest(F.lit(0.01), F.col("target") * 1e-9)
    step = F.when(done, F.col("tilt")).when(inside & near, newton).otherwise(halved)
    return at.select("source", "source_size", "target", "scale", step.alias("tilt"), "low", "high", "miss")


def plan(buckets: DataFrame) -> DataFrame:
    """source, size, bucket, source_size, target, base, extra, at, cut: in this
    bucket every document gets ``base`` copies, the first ``extra`` one more,
    and the ``at``-th (if any) ``cut`` words more or fewer. ``buckets`` is
    (source, size, bucket, docs), saved."""
    sizes = saved(buckets.groupBy("source", "size").agg(F.sum("docs").alias("docs")), "mixing-sizes")
    state = solve(sizes).drop("low", "high", "miss").withColumnRenamed("source", "s2")
    cells = sizes.join(state, F.expr("source <=> s2")).drop("s2")
    # Rates within rounding of a whole number are that number.
    rate = F.when(F.abs(_rate() - F.round(_rate())) < 1e-9, F.round(_rate())).otherwise(_rate())
    cells = cells.withColumn("rate", rate).withColumn("base", F.floor("rate"))
    so_far = Window.partitionBy("source").orderBy(F.col("size").desc())
    due = F.sum(F.col("docs") * (F.col("rate") - F.col("base"))).over(so_far.rowsBetween(Window.unboundedPreceding, 0))
    cells = cells.withColumn("due", F.floor(due + 0.5))
    cells = cells.withColumn("extra", F.col("due") - F.coalesce(F.lag("due").over(so_far), F.lit(0)))
    cells = saved(cells.select("source", "size", "docs", "source_size", "target", "base", "extra"), "mixing-cells")
    # What whole copies leave of the target goes to the document with most room.
    last = F.col("base") + (F.col("extra") == F.col("docs")).cast("long")
    first = F.col("base") + (F.col("extra") > 0).cast("long")
    rest = cells.groupBy("source").agg(
        (F.round(F.first("target")) - F.sum(F.col("size") * (F.col("base") * F.col("docs") + F.col("extra")))).cast("long").alias("rest"),
        F.max(F.struct(((CAP - last) * F.col("size")).alias("room"), "size", F.col("docs").alias("rank"))).alias("up"),
        F.max(F.struct((first * F.col("size")).alias("room"), "size", F.lit(1).cast("long").alias("rank"))).alias("down"))
    to = F.when(F.col("rest") > 0, F.col("up")).otherwise(F.col("down"))
    rest = rest.select(F.col("source").alias("s2"), to["size"].alias("size2"), to["rank"].alias("rank"),
                       (F.signum("rest") * F.least(F.abs("rest"), to["room"])).cast("long").alias("cut"))
    cells = cells.join(rest, F.expr("source <=> s2 AND size = size2"), "left").drop("s2", "size2", "docs")
    before = Window.partitionBy("source", "size").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    deal = buckets.withColumn("before", F.coalesce(F.sum("docs").over(before), F.lit(0)))
    deal = deal.withColumnsRenamed({"source": "s2", "size": "size2"}).join(cells, F.expr("source <=> s2 AND size = size2"))
    at = F.col("rank") - F.col("before")
    return deal.select("source", "size", "bucket", "source_size", "target", "base",
                       F.greatest(F.lit(0), F.least(F.col("docs"), F.col("extra") - F.col("before"))).alias("extra"),
                       F.when(at.between(1, F.col("docs")) & (F.col("cut") != 0), at).alias("at"), "cut")


def mix(docs: DataFrame, size, ties: tuple = ()) -> DataFrame:
    """row (all columns of ``docs``), size, source_size, target, copies, cut:
    how often the mix takes each document whole, and how many words (maybe
    below zero) it takes beside. ``size`` is the column of a document's words.

    ``docs`` needs doc_id and source. A null source is a source of its own, the
    last; documents without words take no words; ties within a source and size
    fall to the lower hash of doc_id, then the lower doc_id, then ``ties``
    (columns over ``row``); rows alike in all are interchangeable. Reruns agree. An empty table gives no
    rows. ``cut`` is not zero in one document of a source at most.
    """
    # A key that is never null joins and windows on one partitioning.
    key = F.when(F.col("source").isNull(), F.lit("")).otherwise(F.concat(F.lit("="), F.col("source").cast("string")))
    bucket = F.pmod(F.xxhash64("doc_id"), F.lit(BUCKETS))
    rows = packed(docs, F.col("source").alias("source"), key.alias("key"), size.alias("size"), bucket.alias("bucket"))
    buckets = saved(rows.groupBy("source", "size", "bucket").agg(F.count("*").alias("docs")), "mixing-buckets")
    deal = plan(buckets).withColumn("key", F.when(F.col("source").isNull(), F.lit("")).otherwise(F.concat(F.lit("="), F.col("source").cast("string")))).drop("source")
    deal = saved(deal, "mixing-plan")
    order = Window.partitionBy("key", "size", "bucket").orderBy(F.xxhash64("row.doc_id"), "row.doc_id", *ties)
    dealt = rows.drop("source").withColumn("n", F.row_number().over(order)).join(deal, ["key", "size", "bucket"])
    copies = F.col("base") + (F.col("n") <= F.col("extra")).cast("long")
    return dealt.select("row", "size", "source_size", "target", copies.alias("copies"),
                        F.when(F.col("n") == F.col("at"), F.col("cut")).otherwise(0).alias("cut"))


def mix_report(docs: DataFrame) -> DataFrame:
    """doc_id, size, source_size, target, taken (words, repeats counted) of
    every document, by :func:`mix`; a null text has no words."""
    sized = saved(docs.select("doc_id", "source", word_count(F.col("text")).alias("size")), "mixing-docs")
    return mix(sized, F.col("size")).select(
        "row.doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies") + F.col("cut")).alias("taken"))


def mixed_corpus(docs: DataFrame) -> DataFrame:
    """The mix itself, with the columns of ``docs``: a row for each whole copy,
    and one with the first words, joined by a blank, for a partial copy
    (n_chars follows the text, where the column exists). Documents of one size
    and doc_id, or none, are told apart by their texts. A null or empty text is
    taken as often as its source's rate says and stays as it is; an empty table
    gives no rows; other columns stay."""
    taken = F.col("size") * F.col("copies") + F.col("cut")
    same = (F.xxhash64("row.text"), F.xxhash64(F.lit("text"), F.col("row.text")))
    dealt = mix(docs, word_count(F.col("text")), same).select(
        "row", F.when(F.col("size") == 0, F.col("copies")).otherwise(F.try_divide(taken - taken % F.col("size"), F.col("size")).cast("long")).alias("whole"),
        F.when(F.col("size") == 0, 0).otherwise(F.coalesce(F.try_mod(taken, F.col("size")), F.lit(0))).cast("int").alias("part"))
    kinds = F.concat(F.array_repeat(F.lit(0), F.col("whole").cast("int")),
                     F.when(F.col("part") > 0, F.array("part")).otherwise(F.array().cast("array<int>")))
    out = dealt.withColumn("first", F.explode(kinds))
    words = F.filter(F.split(F.col("row.text"), r"[\x20\x09-\x0D]+"), lambda w: w != "")
    text = F.when(F.col("first") == 0, F.col("row.text")).otherwise(F.array_join(F.slice(words, 1, F.greatest(F.col("first"), F.lit(1))), " "))
    out = out.withColumn("text", text)
    new = {"text": F.col("text")}
    if "n_chars" in docs.columns:
        kind = docs.schema["n_chars"].dataType
        new["n_chars"] = F.when(F.col("first") == 0, F.col("row.n_chars")).otherwise(F.length("text").cast(kind))
    return out.select(*[new.get(c, F.col(f"row.`{c}`")).alias(c) for c in docs.columns])
