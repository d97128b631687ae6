import numpy as np
import xxhash
from helpers import clashing, documents, table, words
from hypothesis import given, settings
from hypothesis import strategies as st

from feria.llm import simhash


def brute_fingerprint(text, size=4):
    w = words("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))
    grams = [" ".join(w[i: i + size]) for i in range(len(w) - size + 1)] or ([" ".join(w)] if w else [])
    digests = [xxhash.xxh64_intdigest(g.encode(), seed=42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(d >> b & 1 for d in digests) > len(digests))


def brute(rows, bits=4):
    """doc_id -> (fingerprint, component) by comparing all pairs."""
    prints = [(i, brute_fingerprint(t)) for i, t in rows]
    root = {}

    def find(x):
        while root.setdefault(x, x) != x:
            x = root[x]
        return x

    for i, (_, a) in enumerate(prints):
        for _, b in prints[:i]:
            if (a ^ b).bit_count() <= bits:
                root[find(a)] = find(b)
    least = {}
    for i, f in prints:
        if i is not None:
            least[find(f)] = min(i, least.get(find(f), i))
    return sorted(((i, f"{f:016x}", least.get(find(f))) for i, f in prints), key=str)


def test_driver_rows(spark):
    docs = table(spark, "documents")
    got = sorted((tuple(r) for r in simhash.near_duplicates(docs).collect()), key=str)
    assert got == brute([(r.doc_id, r.text) for r in docs.collect()])


def test_edges(spark):
    rows = [(1, None), (2, ""), (3, " \t\n"), (4, "One two"), (5, "one TWO"), (5, "one TWO"), (None, "one two"),
            (6, "É à b c d"), (7, "é à b c d"), (8, "word " * 70_000), (9, "word " * 4)]
    docs = clashing(documents(spark, [(i, t, "s") for i, t in rows]))
    got = sorted((tuple(r) for r in simhash.near_duplicates(docs).collect()), key=str)
    assert got == brute(rows)
    kept = simhash.one_of_each(docs)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.collect()) == sorted({c for _, _, c in brute(rows)})


def test_shared_and_null_ids_with_different_texts(spark):
    """One row of each component stays, whatever the ids."""
    own = {c: " ".join(f"{c}{i}" for i in range(60)) for c in "abcdef"}
    rows = [(None, own["a"]), (None, own["b"]), (None, own["b"]), (None, own["c"]), (5, own["d"]), (5, own["e"]), (5, own["e"]),
            (7, own["d"]), (None, own["e"]), (None, None), (8, own["f"]), (9, own["f"])]
    docs = documents(spark, [(i, t, "s") for i, t in rows])
    kept = sorted(((r.doc_id, r.text) for r in simhash.one_of_each(docs).collect()), key=str)
    assert kept == sorted([(None, own["a"]), (None, own["b"]), (None, own["c"]), (5, own["d"]), (5, own["e"]), (None, None), (8, own["f"])], key=str)


def test_empty(spark):
    none = documents(spark, [])
    assert simhash.near_duplicates(none).count() == 0
    assert simhash.one_of_each(none).count() == 0


def test_no_pair_is_missed(spark):
    """Planted fingerprints at 0 to 6 bits from each other, many in one key."""
    rng = np.random.default_rng(1)
    base = rng.integers(0, 1 << 63, 40, np.uint64)
    fps = set(base.tolist())
    for f in base.tolist():
        for n in range(1, 7):
            fps.add(f ^ sum(1 << int(b) for b in rng.choice(63, n, replace=False)))
    hot = int(base[0])
    fps |= {hot ^ (1 << a) ^ (1 << b) for a in range(40, 63) for b in range(a)}
    fps = sorted(fps)
    reps = spark.createDataFrame([(f - (1 << 64) if f >> 63 else f,) for f in fps], "fp long")
    from feria.llm.components import connected
    old, simhash.CHUNK = simhash.CHUNK, 64  # many chunks for the crowded keys
    try:
        edges = simhash.pivot_edges(reps, 4)
        roots = {r.node: r.root for r in connected(edges).collect()}
    finally:
        simhash.CHUNK = old
    v = np.array(fps, np.uint64)
    label = np.arange(len(v))
    while True:
        new = np.array([label[np.bitwise_count(v ^ x) <= 4].min() for x in v])
        if (new == label).all():
            break
        label = new
    ours = [roots.get(int(np.int64(np.uint64(f))), int(np.int64(np.uint64(f)))) for f in fps]
    assert len(set(ours)) == len(set(label.tolist()))
    assert len(set(zip(ours, label.tolist()))) == len(set(ours))


@settings(max_examples=60, deadline=None)
@given(st.text(alphabet="aB \t\né", max_size=40))
def test_fingerprint(text):
    assert simhash.fingerprint(text.encode(), 4) == brute_fingerprint(text)
