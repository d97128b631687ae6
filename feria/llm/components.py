"""Connected components of a graph given as an edge table."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feria.llm.common import saved

#: The most edges that a task holds for its forest at one time.
FOREST_EDGES = 1 << 20


def _forest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of each run of edges, every node with the least node it reaches in it."""
    def solved(parts: list[pa.RecordBatch]) -> pa.RecordBatch:
        both = pa.Table.from_batches(parts)
        a, b = (both.column(c).to_numpy() for c in ("u", "v"))
        nodes, ids = np.unique(np.concatenate([a, b]), return_inverse=True)
        x, y = ids[: len(a)], ids[len(a):]
        root = np.arange(len(nodes))
        while True:  # least neighbour, then halve the paths
            before = root.copy()
            least = np.minimum(root[x], root[y])
            np.minimum.at(root, root[x], least)
            np.minimum.at(root, root[y], least)
            root = root[root]
            if (root == before).all():
                break
        moved = root != np.arange(len(nodes))
        return pa.RecordBatch.from_arrays([pa.array(nodes[moved]), pa.array(nodes[root[moved]])], ["u", "v"])

    parts, held = [], 0
    for batch in batches:
        if batch.num_rows:
            parts.append(batch)
            held += batch.num_rows
        if held >= FOREST_EDGES:
            yield solved(parts)
            parts, held = [], 0
    if parts:
        yield solved(parts)


def connected(edges: DataFrame) -> DataFrame:
    """node, root (the least node of its component) for every node but the
    roots, of ``edges``, a table of two non-null long columns.

    Each task first replaces its edges by a forest; rounds of large stars and
    small stars (every node hands its neighbours to the least of them) then run
    until all components are stars. Each round is written to the shared folder.
    A node with many neighbours is only ever a key of combinable minima and of
    joins with one row on the other side.
    """
    a, b = (F.col(f"`{c}`") for c in edges.columns)
    edges = edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).where("u <> v")
    edges = saved(edges.mapInArrow(_forest, "u long, v long").distinct(), "edges")
    while not _stars(edges):
        both = edges.union(edges.select("v", "u"))
        least = saved(both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m")), "edges")
        edges = saved(both.join(least, "u").where("v > u AND v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct(), "edges")
        least = saved(edges.groupBy("u").agg(F.min("v").alias("m")), "edges")
        handed = edges.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        edges = saved(handed.union(least).distinct(), "edges")
    return edges.toDF("node", "root")


def _stars(edges: DataFrame) -> bool:
    """Whether every node has one edge down, to a node that has none."""
    if edges.groupBy("u").count().where("count > 1").limit(1).count():
        return False
    return not edges.join(edges.select(F.col("u").alias("v")), "v", "left_semi").limit(1).count()
