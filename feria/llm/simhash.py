"""Near-duplicate documents by SimHash, joined over pivot distance tables.

A fingerprint's table row holds its Hamming distances to reference
fingerprints. Distances are 1-Lipschitz, so two fingerprints within ``r`` bits
differ by at most ``r`` in every coordinate.

* One reference is zero and 64 are the single bits, in ``r + 2`` groups, one
  for each segment of the 64 bits. Relative to the zero reference the distances
  of a group spell out its segment: ``d(x, bit) - d(x, 0) = 1 - 2 * x[bit]``.
  ``r`` differing bits leave two groups untouched at least, so a pair to be
  linked agrees in all relative distances of some two groups: those coordinates
  are the join's keys (taken from the bits, as they mean the same).
* The other references are spread over the space. Pairs that meet under a key
  are discarded if their largest coordinate difference exceeds ``r``, and the
  survivors are verified bit by bit.

Only distinct fingerprints are joined; copies follow their fingerprint. Keys
with many fingerprints are dealt into chunks, each pair of chunks its own unit
of work, and a unit gives a spanning forest of its links and not all of them.
"""

from __future__ import annotations

import functools
import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feria.llm.common import lean, packed, saved, small
from feria.llm.components import connected

SEED = 42
#: Fingerprints of one key that a unit of work takes from each side.
CHUNK = 2048
#: References beside the structured ones.
PIVOTS = np.random.default_rng(SEED).integers(0, 1 << 64, 16, np.uint64)


def fingerprint(text: bytes | None, shingle: int) -> int:
    """SimHash of the text's ``shingle``-word shingles, repeats included."""
    words = (text or b"").lower().split()
    if not words:
        return 0
    if len(words) < shingle:
        grams = iter([b" ".join(words)])
    else:
        grams = map(b" ".join, zip(*(itertools.islice(words, i, None) for i in range(shingle))))
    digest = functools.partial(xxhash.xxh64_intdigest, seed=SEED)
    counts, n = np.zeros(64, np.int64), 0
    while len(part := np.fromiter(map(digest, itertools.islice(grams, 1 << 16)), np.uint64)):
        bits = np.unpackbits(part.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        counts += bits.sum(axis=0, dtype=np.int64)
        n += len(part)
    return int(np.packbits(2 * counts > n, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, shingle: int, column: str = "text") -> DataFrame:
    """All columns but ``column`` of ``docs``, and fp (the bits as a long)."""
    rest = [c for c in docs.columns if c != column]
    schema = docs.select(*rest).withColumn("fp", F.lit(0).cast("long")).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lean()
            texts = batch.column(column).cast(pa.binary())
            fps = np.fromiter((fingerprint(t.as_py(), shingle) for t in texts), np.uint64, len(texts))
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in rest), pa.array(fps.view(np.int64))], [*rest, "fp"])
        lean()

    return docs.mapInArrow(run, schema)


def segments(bits: int) -> list[tuple[int, int]]:
    """(first bit, width) of the ``bits + 2`` segments of a fingerprint."""
    edges = [round(i * 64 / (bits + 2)) for i in range(bits + 3)]
    return [(a, b - a) for a, b in zip(edges, edges[1:])]


def _links(fps: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """A spanning forest of the links among distinct fingerprints."""
    rows = np.bitwise_count(fps[:, None] ^ PIVOTS[None, :]).astype(np.int8)
    left, heads, tails = np.arange(len(fps)), [], []
    front: list[int] = []
    while len(left):
        if not front:
            front, left = [int(left[0])], left[1:]
            continue
        at = front.pop()
        near = left[np.abs(rows[left] - rows[at]).max(axis=1, initial=0) <= bits]
        near = near[np.bitwise_count(fps[near] ^ fps[at]) <= bits]
        if len(near):
            heads.append(np.full(len(near), fps[at]))
            tails.append(fps[near])
            front.extend(near.tolist())
            left = np.setdiff1d(left, near, assume_unique=True)
    none = np.zeros(0, np.uint64)
    return np.concatenate([none, *heads]), np.concatenate([none, *tails])


def pivot_edges(reps: DataFrame, bits: int) -> DataFrame:
    """u, v: a forest of the pairs of the distinct fingerprints ``reps`` (fp)
    with at most ``bits`` differing bits, one for each key they share."""
    parts = segments(bits)
    width = max(w for _, w in parts)

    def segment(at: int, w: int):
        return F.shiftrightunsigned("fp", at).bitwiseAND(F.lit((1 << w) - 1).cast("long"))

    pairs = itertools.combinations(parts, 2)
    keys = [F.lit(i << 2 * width).cast("long") + F.shiftleft(segment(*x), width) + segment(*y) for i, (x, y) in enumerate(pairs)]
    keyed = reps.select("fp", F.explode(F.array(*keys)).alias("key"))
    crowd = saved(keyed.groupBy("key").count().where("count > 1"), "simhash-keys")
    chunks = F.ceil(F.col("count") / CHUNK).cast("int")
    mine = F.pmod(F.xxhash64("fp"), F.col("chunks")).cast("int")
    units = (keyed.join(crowd, "key").withColumn("chunks", chunks).withColumn("mine", mine)
             .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)))
             .select("key", F.least("mine", "other").alias("a"), F.greatest("mine", "other").alias("b"), "fp"))
    units = units.repartition("key", "a", "b").sortWithinPartitions("key", "a", "b")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: pa.Table | None = None
        for batch in itertools.chain(batches, [None]):
            if batch is not None:
                now = pa.Table.from_batches([batch])
                held = now if held is None else pa.concat_tables([held, now])
            if held is None or not held.num_rows:
                continue
            unit = np.stack([held.column(c).to_numpy() for c in ("key", "a", "b")])
            starts = np.flatnonzero(np.concatenate([[True], (unit[:, 1:] != unit[:, :-1]).any(axis=0)]))
            whole = held.num_rows if batch is None else starts[-1]  # the last may go on
            if not whole:
                continue
            fps = held.column("fp").to_numpy().view(np.uint64)
            ends = np.append(starts[1:], held.num_rows)
            found = [_links(fps[s:e], bits) for s, e in zip(starts, ends) if e <= whole and e - s > 1]
            held = held.slice(whole)
            if found:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate([f[i] for f in found]).view(np.int64)) for i in (0, 1)], ["u", "v"])

    return units.mapInArrow(run, "u long, v long")


def components(fps: DataFrame, bits: int) -> DataFrame:
    """fp, root, component_id: of each distinct fp in ``fps`` (doc_id, fp), the
    component's own fingerprint and the least doc_id that links reach."""
    reps = saved(fps.groupBy("fp").agg(F.min("doc_id").alias("first")), "simhash-reps")
    roots = connected(pivot_edges(reps.select("fp"), bits))
    rooted = reps.join(roots.withColumnRenamed("node", "fp"), "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    rooted = saved(rooted, "simhash-roots")
    least = saved(rooted.groupBy("root").agg(F.min("first").alias("component_id")), "simhash-least")
    return saved(rooted.join(least, "root").select("fp", "root", "component_id"), "simhash-components")


def near_duplicates(docs: DataFrame, shingle: int = 4, bits: int = 4) -> DataFrame:
    """doc_id, fingerprint (16 hex digits), component_id of every row.

    Words are lower-cased in A-Z only. A text of fewer words than a shingle is
    one shingle, a null text or one without words has fingerprint zero, which
    links like any other. Copies and repeated rows share their fingerprint and
    so their component; a null doc_id is never a component's id unless no
    member has another. Other columns are ignored; an empty table gives no rows.
    """
    fps = saved(fingerprints(docs.select("doc_id", "text"), shingle), "simhash-fps")
    found = fps.join(components(fps, bits), "fp")
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def one_of_each(docs: DataFrame, shingle: int = 4, bits: int = 4) -> DataFrame:
    """``docs`` with one row of each component: that of the least doc_id, null
    last, then of the least content hash (one of its rows where both repeat)."""
    content = {"k1": F.xxhash64("text"), "k2": F.xxhash64(F.lit("content"), F.col("text"))}
    fps = saved(fingerprints(docs.select("doc_id", "text", *[v.alias(k) for k, v in content.items()]), shingle), "simhash-fps")
    at = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "k1", "k2")
    least = fps.join(components(fps, bits).select("fp", "root"), "fp").groupBy("root").agg(F.min(at).alias("at"))
    kept = saved(least.select(F.col("at.doc_id").alias("doc_id"), "at.k1", "at.k2"), "simhash-kept")
    same = F.expr("id <=> other AND k1 = o1 AND k2 = o2")
    other = [F.col(c).alias(o) for c, o in (("doc_id", "other"), ("k1", "o1"), ("k2", "o2"))]
    ids = saved(fps.select(*other).groupBy("other", "o1", "o2").agg(F.count("*").alias("n")), "simhash-ids")
    found = kept.select(F.col("doc_id").alias("id"), "k1", "k2")
    gone = saved(ids.join(found, same, "left_anti").drop("n"), "simhash-gone")
    again = saved(ids.where("n > 1").drop("n"), "simhash-again")
    keys = {k: F.xxhash64(*x) for k, x in {"k1": (F.col("row.text"),), "k2": (F.lit("content"), F.col("row.text"))}.items()}
    rows = packed(docs, F.col("doc_id").alias("id")).withColumns(keys).join(small(gone), same, "left_anti")
    again = small(again)
    once = rows.join(again, same, "left_anti")
    first = rows.join(again, same, "left_semi").dropDuplicates(["id", "k1", "k2"])
    return once.unionByName(first).select("row.*")
