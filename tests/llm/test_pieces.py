import hashlib

import numpy as np
import pyarrow as pa
import pytest
import sentencepiece
from helpers import documents, table
from hypothesis import given, settings
from hypothesis import strategies as st

from feria.llm import pieces
from feria.llm.queries import QUERIES, pieces_path

LIBRARY = sentencepiece.SentencePieceProcessor(model_file=pieces_path())
MODEL = pieces.read_model(pieces_path())
ENCODER, DECODER = pieces.Encoder(MODEL), pieces.Decoder(MODEL)


def brute(text):
    return LIBRARY.encode(text or "", add_bos=True, add_eos=True)


def digests(ids):
    return len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256(LIBRARY.decode(ids).encode()).hexdigest()


def test_driver_rows(spark):
    texts = {r.doc_id: r.text for r in table(spark, "documents").collect()}
    got = QUERIES["op13_sentencepiece"](spark, "/root/testdata/sf0.001").collect()
    assert len(got) == len(texts)
    for r in got:
        assert (r.n_tokens, r.ids_sha256, r.decoded_sha256) == digests(brute(texts[r.doc_id]))


TEXTS = ["", None, " ", "  a  b ", "a\nb\r\n\tc", "é中\U0001f600 ́", "<s>a</s><0x0A><unk>", "a▁b▁", "a\x00b", " " * 77 + "x", "\u2028 \x85",
         "x" * 30_000, "ab" * 20_000 + " " * 999, "word " * 40_000, "\U0010ffff" * 50]


def test_edges(spark, monkeypatch):
    """Nulls, empty and very long texts, repeated rows, small chunks, no rows."""
    docs = documents(spark, [(i, t, "s") for i, t in enumerate(TEXTS)] + [(None, "a b", None)] * 2).repartition(3)
    monkeypatch.setattr(pieces, "CHUNK_BYTES", 1000)
    encoded = pieces.encode(spark, docs, pieces_path())
    assert encoded.columns == ["doc_id", "lang", "source", "n_chars", "ids"]
    rows = pieces.decode(spark, encoded, pieces_path()).collect()
    assert len(rows) == len(TEXTS) + 2
    for r in rows:
        assert r.ids == brute("a b" if r.doc_id is None else TEXTS[r.doc_id])
        assert r.decoded == LIBRARY.decode(r.ids)
    assert pieces.encode(spark, documents(spark, []), pieces_path(), digests=True).count() == 0


def test_names_that_clash_raise(spark):
    docs = documents(spark, [(1, "a", "s")])
    with pytest.raises(ValueError, match="ids"):
        pieces.encode(spark, docs.withColumnRenamed("lang", "ids"), pieces_path())
    with pytest.raises(ValueError, match="decoded"):
        pieces.decode(spark, docs.withColumnsRenamed({"lang": "decoded"}), pieces_path())
    assert pieces.encode(spark, docs.withColumnsRenamed({"lang": "row", "source": "a.b"}), pieces_path()).first().ids == brute("a")


ALPHABETS = st.one_of(st.text(st.characters(exclude_categories=["Cs"]), max_size=60), st.text("ab ▁\n<é中\x00", max_size=40),
                      st.lists(st.sampled_from(sorted(MODEL["tokens"])), max_size=12).map("".join))


@settings(max_examples=400, deadline=None)
@given(st.lists(ALPHABETS, max_size=5))
def test_ids_are_the_librarys(texts):
    assert pieces.token_lists(ENCODER, pa.array(texts, pa.string()), 1, 2).to_pylist() == [brute(t) for t in texts]


@settings(max_examples=400, deadline=None)
@given(st.lists(st.lists(st.one_of(st.integers(0, 300), st.integers(0, 31999)), max_size=12), max_size=5))
def test_texts_are_the_librarys(lists):
    got = DECODER.decode(pa.array(lists, pa.list_(pa.int32())))
    assert [t.decode() for t in got] == [LIBRARY.decode(ids) for ids in lists]


def test_ids_without_a_piece_are_skipped(spark):
    df = spark.createDataFrame([(1, [264, 10**6, -1, 287]), (2, []), (3, None)], "doc_id long, ids array<int>")
    assert {r.doc_id: r.decoded for r in pieces.decode(spark, df, pieces_path()).collect()} == {1: LIBRARY.decode([264, 287]), 2: "", 3: ""}


def test_kept_answers_may_be_dropped(monkeypatch):
    monkeypatch.setattr(pieces, "KEPT_SEGMENTS", 2)
    monkeypatch.setattr(pieces, "KEPT_PAIRS", 2)
    text = "the one and only thing they were looking for in the valley"
    assert pieces.token_lists(pieces.Encoder(MODEL), pa.array([text]), 1, 2).to_pylist() == [brute(text)]
