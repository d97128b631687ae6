import random

from feria.llm.components import connected


def test_chains_stars_and_rings(spark):
    rng = random.Random(3)
    chain = [(i, i + 1) for i in range(0, 400)]
    star = [(1000, i) for i in range(1001, 1500)]
    ring = [(2000 + i, 2000 + (i + 1) % 50) for i in range(50)]
    loops = [(3000, 3000), (3001, 3002), (3002, 3001), (3001, 3002)]
    edges = chain + star + ring + loops
    rng.shuffle(edges)
    names = {n: rng.randrange(-1 << 62, 1 << 62) for e in edges for n in e}
    df = spark.createDataFrame([(names[a], names[b]) for a, b in edges], "x long, y long").repartition(7)
    got = {r.node: r.root for r in connected(df).collect()}
    for group in (range(0, 401), range(1000, 1500), range(2000, 2050), (3001, 3002), (3000,)):
        least = min(names[n] for n in group)
        assert {got.get(names[n], names[n]) for n in group} == {least}


def test_no_edges(spark):
    assert connected(spark.createDataFrame([], "x long, y long")).count() == 0
