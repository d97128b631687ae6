import re
from collections import Counter, defaultdict

import pytest
from helpers import clashing, documents, table

from feria.llm import collocations as C

SCHEMA = "doc_id long, lang string, text string"


def brute(rows, words=5, least=100, share=100, top=2000):
    counts, out = defaultdict(Counter), []
    for lang, text in rows:
        low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", low):
            ws = re.findall(r"[^\x20\x09]+", piece)
            for k in range(1, words + 1):
                counts["und" if lang is None else lang].update(tuple(ws[i: i + k]) for i in range(len(ws) - k + 1))
    for lang, f in counts.items():
        n = sum(c for p, c in f.items() if len(p) == 1)
        held = [p for p, c in f.items() if len(p) > 1 and c >= least]
        told = []
        for p in held:
            around = [q for q in held if len(q) > len(p) and any(q[i: i + len(p)] == p for i in range(len(q))) and 100 * f[q] >= share * f[p]]
            if around:
                continue
            score, k = min((1000 * f[p] * n // (f[p[:k]] * f[p[k:]]), k) for k in range(1, len(p)))
            told.append((-score, -f[p], " ".join(p).encode(), f[p[:k]], f[p[k:]]))
        for rank, (s, a, p, l, r) in enumerate(sorted(told)[:top], 1):
            out.append((lang, rank, p.decode(), -a, l, r, n, -s))
    return sorted(out)


def got(df):
    return sorted(tuple(r) for r in df.collect())


@pytest.mark.parametrize("least", [3, 20])
def test_driver_rows(spark, least):
    docs = table(spark, "documents")
    rows = [(r.lang, r.text) for r in docs.collect()]
    found = got(C.collocations(docs, least=least))
    assert len(found) > 100
    assert found == brute(rows, least=least)


def test_bits_lose_nothing(spark, monkeypatch):
    """With far too few bits, small chunks and another share, the same rows."""
    monkeypatch.setattr(C, "MAX_BITS", C.ROW_BITS)
    monkeypatch.setattr(C, "BITS_EACH", 1)
    monkeypatch.setattr(C, "CHUNK_BYTES", 5000)
    monkeypatch.setattr(C, "HEAVY", 100_000)
    monkeypatch.setattr(C, "SLOTS", 3)
    docs = table(spark, "documents")
    rows = [(r.lang, r.text) for r in docs.collect()]
    assert got(C.collocations(docs, words=4, least=5, share=60, top=50)) == brute(rows, words=4, least=5, share=60, top=50)


TEXTS = [("en", "New York. New York, new york\tcity new\nyork"), ("en", None), ("en", ""), (None, "a b c a b c a b c"), ("und", "A b c"),
         ("fr", "é à é à é à!é à;ÉÀ"), ("fr", "x" * 9000 + " " + "y z " * 3000), ("de", "a a a a a a a a"), ("es", " .,;\x0b\x0c")]


@pytest.mark.parametrize("least", [1, 2, 4])
def test_edges(spark, least):
    rows = TEXTS + TEXTS[:1] * 2
    docs = spark.createDataFrame([(None, lang, t) for lang, t in rows], SCHEMA).repartition(3)
    assert got(C.collocations(docs, least=least)) == brute(rows, least=least)
    assert got(C.collocations(clashing(docs), least=least)) == brute(rows, least=least)
    assert C.collocations(documents(spark, []), least=least).count() == 0


def test_products_beyond_64_bits(spark):
    """Counts that come merged already: 1000 a n passes 2^63."""
    big = 5 * 10**14
    counts = spark.createDataFrame([("en", "a", 1, big), ("en", "b", 1, 3 * big), ("en", "a b", 2, big - 7)], "lang string, phrase string, words int, a long")
    totals = spark.createDataFrame([("en", 10 * big)], "lang string, n long")
    (row,) = C.ranked(counts, totals, 100, 10).collect()
    assert row.score == 1000 * (big - 7) * 10 * big // (3 * big * big)
