"""Near-duplicate vectors by an exact metric range join.

Cosine at or above a threshold is an angle at or below ``eps``. Pivots, a
sample of a label's vectors that grows with their number, cut the label into
cells: a vector's home is the cell of its nearest pivot. A label of few vectors
is one cell. A vector within ``eps`` of a member of cell ``i`` is, by the
triangle inequality,

* at most ``2 * eps`` farther from pivot ``i`` than from its own pivot,
* at most ``eps`` farther from pivot ``i`` than the cell's farthest member, and
  at most ``eps`` nearer than its nearest one,

and it lies within the threshold's chord of the plane between the two pivots.
Only to cells that pass all of these it is replicated. Every partner of a
vector is then in its home cell, which is joined alone: links are counted at
home, where each occurs once. Cells are cut into blocks of bounded size (some
of its own vectors against some of all its vectors), which hand over counts and
a spanning forest, never all pairs.

Equal vectors of one label are compared once.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feria.llm.common import saved
from feria.llm.components import connected

#: One vector in so many of a label is a pivot, told by its hash.
CELL = 4096
#: The numbers that the pivots of all labels may hold, about: beyond, cells are
#: larger. Pivots decide on replication only, never on a link.
PIVOT_NUMBERS = 1 << 21
#: Angles that a task holds at a time.
ANGLES = 1 << 21
#: Vectors of a block: of the cell's own, and of all that the cell holds.
OWN, ALL = 1024, 4096
#: Slack, far above rounding, for what decides replication but never a link.
SLACK = 1e-6


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    """The lists of a column as rows, in double precision, zeros to the right."""
    out = np.zeros((len(column), width))
    sizes = column.value_lengths().to_numpy()
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(float)
    at = np.cumsum(sizes) - sizes
    out[np.repeat(np.arange(len(column)), sizes), np.arange(len(flat)) - np.repeat(at, sizes)] = flat
    return out


def _unit(rows: np.ndarray) -> np.ndarray:
    rows = rows / np.abs(rows).max(axis=1, keepdims=True)  # no square under- or overflows
    return rows / np.linalg.norm(rows, axis=1, keepdims=True)


def _cells(units: np.ndarray, pivots: np.ndarray, eps: float, chord: float) -> tuple[np.ndarray, list[np.ndarray], list[np.ndarray]]:
    """Of each vector its home cell, the cells it is replicated to (its home
    too) and its angle to the pivot of each."""
    width = max(units.shape[1], pivots.shape[1])
    units, pivots = (np.pad(x, ((0, 0), (0, width - x.shape[1]))) for x in (units, pivots))
    homes, cells, angles = [np.zeros(0, int)], [], []
    step = max(1, ANGLES // len(pivots))
    for at in range(0, len(units), step):
        angle = np.arccos(np.clip(units[at : at + step] @ pivots.T, -1, 1))
        own = angle.argmin(axis=1)
        apart = np.maximum(np.sqrt(np.maximum(0, 2 - 2 * pivots[own] @ pivots.T)), 1e-12)
        gap = np.cos(angle.min(axis=1))[:, None] - np.cos(angle)
        near = (angle <= angle.min(axis=1)[:, None] + 2 * eps + SLACK) & (gap <= chord * apart + SLACK)
        near[np.arange(len(own)), own] = True
        homes.append(own)
        cells += [np.flatnonzero(row) for row in near]
        angles += [row[kept] for row, kept in zip(angle, near)]
    return np.concatenate(homes), cells, angles


def _pivots(reps: DataFrame) -> dict[object, np.ndarray]:
    """The pivots of each label that has more than one, as unit rows."""
    numbers = reps.agg(F.sum(F.size("v"))).first()[0] or 0
    cell = max(CELL, math.ceil(numbers / PIVOT_NUMBERS))
    told = F.pmod(F.xxhash64("k1", "k2", F.lit("pivot")), F.lit(cell)) == 0
    rows: dict[object, list] = {}
    for row in reps.where(told).orderBy("k1", "k2").select("label", "v").collect():
        rows.setdefault(row.label, []).append(row.v)
    out = {}
    for label, vectors in rows.items():
        if len(vectors) > 1:
            width = max(map(len, vectors))
            out[label] = _unit(np.array([[*v, *[0.0] * (width - len(v))] for v in vectors], float))
    return out


def usable(vector: str, label: str):
    """Whether a vector may link: no null, no component null or not finite,
    some component not zero."""
    fine = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce(F.col(label).isNotNull() & fine & F.exists(vector, lambda x: x != 0), F.lit(False))


def range_join(vectors: DataFrame, threshold: float = 0.98) -> DataFrame:
    """vec_id, n_links (other rows linked directly), component_id (least vec_id
    that links reach, its own included) and kept (vec_id = component_id).

    ``vectors`` has vec_id, embedding and label; rows link when their labels are
    equal and not null, their vectors as long as each other, and the cosine in
    double precision is at least ``threshold`` (over 0). A vector that is null,
    empty, zero, or has a component null or not finite links with nothing.
    Repeated rows link with each other; a null vec_id is a component's id only
    if no member has another. Other columns are ignored; an empty table gives
    no rows.
    """
    spark = vectors.sparkSession
    eps, chord = math.acos(threshold), math.sqrt(2 - 2 * threshold)
    rows = vectors.select("vec_id", "embedding", "label", usable("embedding", "label").alias("ok"))
    keys = {"k1": F.xxhash64("label", "embedding"), "k2": F.xxhash64(F.lit("vector"), F.col("embedding"), F.col("label"))}
    rows = rows.withColumns(keys)
    light = saved(rows.select("vec_id", "ok", "k1", "k2"), "metric-rows")
    reps = rows.where("ok").groupBy("k1", "k2").agg(F.first("embedding").alias("v"), F.first("label").alias("label"),
                                                    F.count("*").alias("n"), F.min("vec_id").alias("first"))
    reps = saved(reps.withColumn("rid", F.monotonically_increasing_id()), "metric-reps")

    pivots = spark.sparkContext.broadcast(_pivots(reps))

    def home(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            sizes = batch.column("v").value_lengths().to_numpy()
            own = np.zeros(batch.num_rows, np.int32)
            cells, angles = [np.zeros(1, int)] * batch.num_rows, [np.zeros(1)] * batch.num_rows
            rows: dict[object, list[int]] = {}
            for i, label in enumerate(batch.column("label").to_pylist()):
                if label in pivots.value:
                    rows.setdefault(label, []).append(i)
            for label, at in rows.items():
                vectors = batch.column("v").take(pa.array(at))
                own[at], near, far = _cells(_unit(_matrix(vectors, int(sizes[at].max()))), pivots.value[label], eps, chord)
                for i, c, a in zip(at, near, far):
                    cells[i], angles[i] = c, a
            ends = np.concatenate([[0], np.cumsum([len(c) for c in cells])])
            lists = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.concatenate(cells), pa.int32()))
            yield pa.RecordBatch.from_arrays(
                [batch.column("rid"), batch.column("label"), pa.array(sizes, pa.int32()), batch.column("n"), batch.column("v"), pa.array(own, pa.int32()),
                 lists, pa.ListArray.from_arrays(lists.offsets, pa.array(np.concatenate(angles)))],
                ["rid", "label", "size", "n", "v", "own", "cells", "angles"])

    label = reps.schema["label"].dataType.simpleString()
    vector = reps.schema["v"].dataType.simpleString()
    placed = saved(reps.select("rid", "label", "n", "v").mapInArrow(
        home, f"rid long, label {label}, size int, n long, v {vector}, own int, cells array<int>, angles array<double>"), "metric-placed")
    cell = ["label", "size", "cell"]
    each = placed.select("rid", "label", "size", "n", "v", "own", F.explode(F.arrays_zip("cells", "angles")).alias("at"))
    each = each.select("rid", "label", "size", "n", "v", F.col("at.cells").alias("cell"), F.col("at.angles").alias("angle"),
                       (F.col("own") == F.col("at.cells")).alias("own"))
    reach = saved(each.where("own").groupBy(*cell).agg(F.min("angle").alias("low"), F.max("angle").alias("high")), "metric-reach")
    each = each.join(reach, cell).where(F.col("angle").between(F.col("low") - eps - SLACK, F.col("high") + eps + SLACK))
    crowd = saved(each.groupBy(*cell).agg(
        F.ceil(F.count_if("own") / OWN).cast("int").alias("owns"), F.ceil(F.count("*") / ALL).cast("int").alias("alls"), F.count("*").alias("held"))
        .where("held > 1").drop("held"), "metric-cells")
    each = each.join(crowd, cell)
    spread = F.xxhash64("rid")
    own = (each.where("own").withColumn("x", F.pmod(spread, F.col("owns")).cast("int"))
           .withColumn("y", F.explode(F.sequence(F.lit(0), F.col("alls") - 1))))
    other = (each.withColumn("y", F.pmod(spread, F.col("alls")).cast("int"))
             .withColumn("x", F.explode(F.sequence(F.lit(0), F.col("owns") - 1))).withColumn("own", F.lit(False)))
    blocks = own.select(*cell, "x", "y", "own", "rid", "n", "v").unionByName(other.select(*cell, "x", "y", "own", "rid", "n", "v"))

    def join(rows: pa.Table) -> pa.Table:
        own = rows.column("own").to_numpy()
        rid, n = (rows.column(c).to_numpy() for c in ("rid", "n"))
        raw = _matrix(rows.column("v").combine_chunks(), len(rows.column("v")[0]))
        units = _unit(raw)
        link = units[own] @ units[~own].T >= threshold
        same = rid[own][:, None] == rid[~own][None, :]
        links = ((link & ~same) * n[~own][None, :]).sum(axis=1)
        link |= same
        a, b = rid[own].copy(), rid[~own].copy()
        while True:  # the least vector that each reaches in this block
            x = np.minimum(a, np.where(link, b[None, :], np.iinfo(np.int64).max).min(axis=1, initial=np.iinfo(np.int64).max))
            y = np.minimum(b, np.where(link, x[:, None], np.iinfo(np.int64).max).min(axis=0, initial=np.iinfo(np.int64).max))
            if (x == a).all() and (y == b).all():
                break
            a, b = x, y
        out = [np.concatenate(p) for p in ((rid[own], rid[~own]), (a, b), (links, np.zeros(len(b), np.int64)))]
        some = (out[0] != out[1]) | (out[2] > 0)
        return pa.table([pa.array(c[some], pa.int64()) for c in out], ["rid", "root", "links"])

    found = saved(blocks.groupBy(*cell, "x", "y").applyInArrow(join, "rid long, root long, links long"), "metric-found")
    links = saved(found.groupBy("rid").agg(F.sum("links").alias("links")), "metric-links")
    roots = connected(found.where("rid <> root").select("rid", "root").distinct()).withColumnRenamed("node", "rid")
    full = reps.select("rid", "k1", "k2", "n", "first").join(roots, "rid", "left").join(links, "rid", "left")
    full = saved(full.withColumn("root", F.coalesce("root", "rid")), "metric-full")
    least = saved(full.groupBy("root").agg(F.min("first").alias("least")), "metric-least")
    told = saved(full.join(least, "root").select("k1", "k2", F.lit(True).alias("ok"), (F.col("n") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"), "least"), "metric-told")
    # Null and zero vectors are few keys of many rows: each gets keys of its own.
    light = light.withColumns({"k1": F.when(F.col("ok"), F.col("k1")).otherwise(F.xxhash64("vec_id"))})
    out = light.join(told, ["k1", "k2", "ok"], "left")
    component = F.when(F.col("ok"), F.col("least")).otherwise(F.col("vec_id"))
    return out.select("vec_id", F.coalesce("n_links", F.lit(0)).alias("n_links"), component.alias("component_id"),
                      F.col("vec_id").eqNullSafe(component).alias("kept"))
