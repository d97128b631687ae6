import hashlib
import zlib

import pyarrow as pa
import pytest
from helpers import clashing, documents, table, words
from hypothesis import given, settings
from hypothesis import strategies as st

from feria.llm import periods
from feria.llm.queries import QUERIES


def brute(ws, least=12):
    """(start, length, period) of each run: for every period, the longest
    stretches that keep it; of one stretch, the least period."""
    found = {}
    n = len(ws)
    for q in range(1, n // 2 + 1):
        s = 0
        while s + q < n:
            e = s
            while e + q < n and ws[e] == ws[e + q]:
                e += 1
            if e > s and e + q - s >= max(least, 2 * q):
                found.setdefault((s, e + q - s), q)
            s = e + 1
    return sorted(((s, k, q) for (s, k), q in found.items()), key=lambda r: (r[0], r[2]))


def collapsed(ws, runs):
    gone = {i for s, k, q in runs for i in range(s + q, s + k)}
    return " ".join(w for i, w in enumerate(ws) if i not in gone)


def planted(doc_id, ws):
    h = 1 if doc_id is None else zlib.crc32(str(doc_id).encode())
    n, g = len(ws), h // 10
    if h % 10 or not n:
        return ws
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return [ws[i] if i < a else ws[a + (i - a) % p] for i in range(n)]


def report(doc_id, text):
    ws = planted(doc_id, words(text))
    runs = brute(ws)
    best = min(runs, key=lambda r: (-r[1], r[0], r[2]), default=None)
    four = (None,) * 4 if best is None else (*best, 1000 * best[1] // best[2])
    sha = [hashlib.sha256(t.encode()).hexdigest() for t in ("".join(f"{s},{k},{q}\n" for s, k, q in runs), collapsed(ws, runs))]
    return doc_id, len(runs), *four, *sha


def test_driver_rows(spark):
    texts = {r.doc_id: r.text for r in table(spark, "documents").collect()}
    short = {i: t for i, t in texts.items() if len(words(t)) < 700}
    assert len(short) > 150
    got = {r.doc_id: tuple(r) for r in QUERIES["op11_periodic_runs"](spark, "/root/testdata/sf0.001").collect()}
    assert len(got) == len(texts)
    for i, t in short.items():
        assert got[i] == report(i, t)
    assert sum(r[1] > 0 for r in got.values()) > 20


ONE = "one two three four five six seven eight"
TEXTS = ["", None, " \n", "a " * 11, "a " * 12, ONE, f"{ONE} {ONE}", f"{ONE} {ONE} one", f"x {ONE}\t{ONE}\n{ONE} y", "a b " * 6 + "a a " * 9,
         "a " * 12 + "b " * 12, "é   " * 9, ("a " * 6 + "b ") * 5, ("a b a c " * 4 + "z ") * 3, "k " * 700]


def test_edges(spark):
    rows = [(i, t, "s") for i, t in enumerate(TEXTS)] + [(None, "a " * 20, None)] * 2 + [(7, ONE, "s")] * 2
    docs = documents(spark, rows).repartition(3)
    got = periods.run_report(periods.planted(docs)).collect()
    assert sorted(map(tuple, got), key=str) == sorted((report(i, t) for i, t, _ in rows), key=str)
    whole = periods.find_runs(docs.select("doc_id", "text", "n_chars")).collect()
    assert whole[0].__fields__ == ["doc_id", "n_chars", "n_words", "runs", "collapsed"]
    plain = {(r.doc_id, r.n_chars): r for r in whole}
    for i, t, _ in rows:
        r, ws = plain[i, None if t is None else len(t)], words(t)
        assert (r.n_words, [tuple(x) for x in r.runs], r.collapsed) == (len(ws), brute(ws), collapsed(ws, brute(ws)))
    assert periods.run_report(periods.planted(documents(spark, []))).count() == 0


def test_names_of_other_columns(spark):
    docs = documents(spark, [(1, "a " * 20, "s")])
    assert periods.run_report(periods.planted(clashing(docs))).first().n_runs == 1
    assert periods.find_runs(clashing(docs)).first().collapsed == "a"
    with pytest.raises(ValueError, match="runs"):
        periods.find_runs(docs.withColumnRenamed("lang", "runs"))


SMALL = st.lists(st.sampled_from("ab"), max_size=60)
PERIODIC = st.builds(lambda head, block, n, tail: head + (block * n)[:80] + tail, SMALL, st.lists(st.sampled_from("abc"), min_size=1, max_size=12),
                     st.integers(2, 30), SMALL)


@settings(max_examples=400, deadline=None)
@given(st.lists(st.one_of(SMALL, PERIODIC), min_size=1, max_size=5), st.integers(1, 14))
def test_pairs_are_the_runs(texts, least):
    sizes, runs, left = periods.runs_of(pa.array([" ".join(t) for t in texts]), least)
    for t, n, r, x in zip(texts, sizes, runs, left.to_pylist()):
        assert n == len(t) and [tuple(k) for k in r.tolist()] == brute(t, least)
        assert x.decode() == collapsed(t, brute(t, least))


def test_long_texts():
    """A word 100,000 times, a long period, and a phrase with many left words."""
    phrase = "and the same eight words come once again now"
    many = " ".join(f"w{i} {phrase}" for i in range(20_000))
    block = " ".join(f"v{i}" for i in range(30_000))
    sizes, runs, left = periods.runs_of(pa.array(["a " * 100_000, many, f"{block} {block} {block}"]))
    assert [r.tolist() for r in runs] == [[[0, 100_000, 1]], [], [[0, 90_000, 30_000]]]
    assert [len(x) for x in left.to_pylist()] == [1, len(many), len(block)]
