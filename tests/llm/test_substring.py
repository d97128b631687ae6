from collections import Counter

import pytest
from helpers import documents, table, words

from feria.llm import substring


def brute(rows, size):
    each = [(i, words(t)) for i, t in rows]
    counts = Counter(tuple(w[k: k + size]) for _, w in each for k in range(len(w) - size + 1))
    out = []
    for i, w in each:
        gone = {k + j for k in range(len(w) - size + 1) if counts[tuple(w[k: k + size])] > 1 for j in range(size)}
        out.append((i, len(w), len(gone), " ".join(x for k, x in enumerate(w) if k not in gone)))
    return sorted(out, key=str)


def got(df):
    return sorted((tuple(r) for r in df.select("doc_id", "n_words", "n_removed", "kept").collect()), key=str)


def test_driver_rows(spark):
    docs = table(spark, "documents").select("doc_id", "text")
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    assert got(substring.remove_repeats(spark, docs, 35)) == brute(rows, 35)


@pytest.mark.parametrize("bits", [6, 33])
def test_overestimates_are_taken_back(spark, bits, monkeypatch):
    """With 64 counters every window is estimated repeated; the result is the same."""
    monkeypatch.setattr(substring, "WIDTH_BITS", bits)
    monkeypatch.setattr(substring, "WORD_COUNTERS", 0)
    monkeypatch.setattr(substring, "PIECE_WORDS", 100)
    rows = [(i, " ".join(f"w{i}n{k}" for k in range(30))) for i in range(40)]
    rows += [(100, "a b c d e f g h"), (101, "x a b c d e f y"), (102, "r " * 20), (103, "p q r s p q r s")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    if bits < 32:
        spark.conf.set("spark.sql.shuffle.partitions", "2")
    try:
        assert got(substring.remove_repeats(spark, docs, 4)) == brute(rows, 4)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")


def test_many_ranges(spark, monkeypatch):
    """More ranges than a piece has windows: most hold nothing of it."""
    monkeypatch.setattr(substring, "RANGE_WORDS", 1)
    monkeypatch.setattr(substring, "PIECE_WORDS", 50)
    rows = [(i, f"s{i} " + "a b c d e f " * (i % 3) + " ".join(f"w{i % 7}n{k}" for k in range(12))) for i in range(30)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    assert got(substring.remove_repeats(spark, docs, 4)) == brute(rows, 4)


def test_sketch_grows_with_the_text():
    assert substring.sketch_shape(0, 8) == (33, 4)
    for size in (10**9, 10**12, 10**14):
        bits, shift = substring.sketch_shape(size, 200)
        words = size / 6
        assert 2**bits >= 16 * words and bits - shift <= 32 and words / 2**shift <= 2 * substring.RANGE_WORDS


def test_edges(spark):
    rows = [(1, None), (2, ""), (3, " \n"), (4, "a b c"), (5, "a b c d é"), (6, "x a b c d"), (None, "long " * 50_000), (7, "k l m n"), (7, "k l m n")]
    docs = documents(spark, [(i, t, "s") for i, t in rows])
    out = substring.remove_repeats(spark, docs, 4)
    assert got(out) == brute(rows, 4)
    assert out.columns == ["doc_id", "lang", "source", "n_chars", "n_words", "n_removed", "kept"]
    assert substring.remove_repeats(spark, documents(spark, []), 4).count() == 0
