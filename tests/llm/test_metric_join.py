import numpy as np
import pytest
from helpers import table
from pyspark.sql import functions as F

from feria.llm import metric_join

SCHEMA = "vec_id long, embedding array<float>, label int"


def brute(rows, threshold=0.98):
    def fine(v, label):
        return label is not None and v and all(x is not None and np.isfinite(x) for x in v) and any(v)
    units = {k: np.array(v, float) / np.linalg.norm(np.array(v, float)) if fine(v, label) else None for k, (_, v, label) in enumerate(rows)}
    link = {k: [j for j in units if j != k and units[k] is not None and units[j] is not None and rows[k][2] == rows[j][2]
                and len(units[k]) == len(units[j]) and units[k] @ units[j] >= threshold] for k in units}
    out = []
    for k, (i, _, _) in enumerate(rows):
        seen, todo = {k}, [k]
        while todo:
            for j in link[todo.pop()]:
                if j not in seen:
                    seen.add(j)
                    todo.append(j)
        ids = [rows[j][0] for j in seen if rows[j][0] is not None]
        least = min(ids) if ids else None
        out.append((i, len(link[k]), least, i == least))
    return sorted(out, key=str)


def got(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def test_driver_rows(spark):
    vectors = table(spark, "embeddings")
    assert got(metric_join.range_join(vectors)) == brute([(r.vec_id, r.embedding, r.label) for r in vectors.collect()])


@pytest.mark.parametrize("cell, numbers, angles", [(8, 1 << 21, 1 << 21), (8, 200, 64), (4096, 1 << 21, 1 << 21)])
def test_clusters_in_small_blocks(spark, monkeypatch, cell, numbers, angles):
    """Chains and dense groups cut into many cells and blocks lose no link,
    with many pivots, with few as they are bounded, and without any."""
    monkeypatch.setattr(metric_join, "CELL", cell)
    monkeypatch.setattr(metric_join, "PIVOT_NUMBERS", numbers)
    monkeypatch.setattr(metric_join, "ANGLES", angles)
    monkeypatch.setattr(metric_join, "OWN", 16)
    monkeypatch.setattr(metric_join, "ALL", 32)
    rng = np.random.default_rng(5)
    rows = []
    for c in range(12):
        centre = rng.normal(size=8)
        for _ in range(40):
            rows.append((len(rows), (centre + rng.normal(size=8) * rng.choice([0.02, 0.1, 0.2])).astype(np.float32).tolist(), c % 2))
    angle = np.linspace(0, 3, 60)  # neighbours link, ends do not
    rows += [(len(rows) + i, [float(np.float32(np.cos(a))), float(np.float32(np.sin(a)))], 0) for i, a in enumerate(angle)]
    df = spark.createDataFrame(rows, SCHEMA)
    assert got(metric_join.range_join(df)) == brute(rows)


def test_edges(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(1, None, 0), (2, [], 0), (3, [0.0, 0.0], 0), (4, [1.0, nan], 0), (5, [1.0, inf], 0), (6, [1.0, None], 0), (7, [1.0, 0.0], None),
            (8, [1.0, 0.0], 0), (9, [2.0, 0.0], 0), (9, [2.0, 0.0], 0), (None, [1.0, 0.0], 0), (None, [1.0, 0.0], 1), (10, [1.0, 0.0, 0.0], 0),
            (11, [1e-30, 0.0], 0), (12, [3e38, 0.0], 0), (13, [-1.0, 0.0], 0), (14, [1.0, 0.0], 2)]
    df = spark.createDataFrame(rows, SCHEMA).withColumns({c: F.lit(1) for c in ["n", "v", "rid", "cell", "own", "kept"]})
    want = [(i, n, c, i == c) for i, n, c, _ in brute(rows)]
    assert got(metric_join.range_join(df)) == sorted(want, key=str)
    assert metric_join.range_join(spark.createDataFrame([], SCHEMA)).count() == 0
    none = spark.createDataFrame([(1, None, 0)], SCHEMA)
    assert got(metric_join.range_join(none)) == [(1, 0, 1, True)]


def test_pivots_grow_with_the_vectors_of_a_label(spark, monkeypatch):
    monkeypatch.setattr(metric_join, "CELL", 16)
    rng = np.random.default_rng(6)
    rows = [(rng.normal(size=4).tolist(), label) for label, n in [(0, 2000), (1, 500), (2, 3)] for _ in range(n)]
    reps = spark.createDataFrame(rows, "v array<double>, label int").withColumns({"k1": F.xxhash64("v"), "k2": F.lit(0)})
    found = {label: len(rows) for label, rows in metric_join._pivots(reps).items()}
    assert 90 <= found[0] <= 160 and 16 <= found[1] <= 48 and 2 not in found
    monkeypatch.setattr(metric_join, "PIVOT_NUMBERS", 200)
    assert sum(len(rows) for rows in metric_join._pivots(reps).values()) <= 100
