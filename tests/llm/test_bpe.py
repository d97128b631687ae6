import hashlib

import numpy as np
import pytest
from helpers import documents, table
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from feria.llm import bpe
from feria.llm.queries import bpe_path


@pytest.fixture(scope="module")
def library():
    t = Tokenizer.from_file(bpe_path())
    t.no_truncation()
    t.no_padding()
    return t


def brute(library, text):
    ids = library.encode(text or "", add_special_tokens=False).ids
    decoded = library.decode(ids, skip_special_tokens=False)
    return len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256(decoded.encode()).hexdigest()


def check(spark, library, docs, texts):
    encoded = bpe.encode(spark, docs, bpe_path())
    got = bpe.encode(spark, docs, bpe_path(), digests=True).collect()
    assert len(got) == len(texts)
    for r in got:
        assert (r.n_tokens, r.ids_sha256, r.decoded_sha256) == brute(library, texts[r.doc_id])
    for r in bpe.decode(spark, encoded, bpe_path()).collect():
        ids = library.encode(texts[r.doc_id] or "", add_special_tokens=False).ids
        assert r.ids == ids and r.decoded == library.decode(ids, skip_special_tokens=False)


def test_driver_rows(spark, library):
    docs = table(spark, "documents").select("doc_id", "text")
    check(spark, library, docs, {r.doc_id: r.text for r in docs.collect()})


TEXTS = ["", None, " \t\n", "a<|endoftext|>b  <|startoftext|> x", "I'm it's don't 'S 123 4é é ́ x̧́ ​ z İ ΟΔΟΣ ΣΑΣ ǅ ﬁ \x1c\x85q",
         "\U0001f600 中文 ok\r\n\tno", "x" * 30_000, "word " * 40_000, "Ạ̊̀ 각 한"]


def test_edges(spark, library, monkeypatch):
    monkeypatch.setattr(bpe, "CHUNK_BYTES", 1000)
    texts = dict(enumerate(TEXTS))
    docs = documents(spark, [(i, t, "s") for i, t in texts.items()]).repartition(3)
    docs.cache()
    check(spark, library, docs, texts)
    twice = docs.union(docs)
    assert bpe.encode(spark, twice, bpe_path()).count() == 2 * len(texts)
    assert bpe.encode(spark, docs, bpe_path()).columns == ["doc_id", "lang", "source", "n_chars", "ids"]
    docs.unpersist()
    none = documents(spark, [])
    assert bpe.encode(spark, none, bpe_path(), digests=True).count() == 0


def test_many_buckets_and_short_tables(spark, library, monkeypatch):
    """Buckets grow with the text, and a table that starts anew loses no word."""
    monkeypatch.setattr(bpe, "BUCKET_BYTES", 100)
    monkeypatch.setattr(bpe, "MAX_BUCKETS", 40)
    monkeypatch.setattr(bpe, "TABLE_WORDS", 3)
    monkeypatch.setattr(bpe, "CHUNK_BYTES", 500)
    texts = {i: " ".join(f"word{j * i % 50} common {j}" for j in range(40)) for i in range(20)}
    docs = documents(spark, [(i, t, "s") for i, t in texts.items()]).repartition(3).cache()
    check(spark, library, docs, texts)
    docs.unpersist()


def test_decode_skips_unknown_ids(spark, library):
    df = spark.createDataFrame([(1, [320, 10**6, -1, 321]), (2, []), (3, None)], "doc_id long, ids array<int>")
    got = {r.doc_id: r.decoded for r in bpe.decode(spark, df, bpe_path()).collect()}
    assert got == {1: library.decode([320, 321], skip_special_tokens=False), 2: "", 3: ""}


@settings(max_examples=200, deadline=None)
@given(st.text(alphabet=st.characters(exclude_categories=["Cs"]), max_size=60))
def test_a_text_is_its_words(text):
    """The ground of the method: ids of a text are the ids of its words in order."""
    library = Tokenizer.from_file(bpe_path())
    whole = library.encode(text, add_special_tokens=False).ids
    each = [i for w in text.encode().split() for i in library.encode(w.decode(), add_special_tokens=False).ids]
    assert whole == each
