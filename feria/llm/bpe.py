"""BPE encoding through a table of distinct words, and decoding.

Blanks never join two words in this vocabulary (its splitting pattern matches
no white space, and its normaliser composes nothing across a blank), so a
text's ids are the ids of its words in order. Documents are packed into chunks
of an Arrow batch; a chunk's distinct words go to the word table, which
is partitioned by word, in buckets that grow in number with the text; there each
distinct word is encoded once, and its ids return to every chunk that holds it,
where they are put back by position.

Decoding joins ids to pieces: the vocabulary, whose size is fixed, goes to
every task as one array, and each document's ids are looked up in it.
"""

from __future__ import annotations

import array
import hashlib
import itertools
import os
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import ArrayType, IntegerType, LongType, StringType, StructField, StructType
from tokenizers import Tokenizer

from feria.llm.common import lean, text_bytes

#: The most entries of a vocabulary that is sent to every task.
MAX_VOCABULARY = 1 << 20
#: Bytes of text at which a chunk ends (a document is never split).
CHUNK_BYTES = 16 << 20
#: Bytes of text for each bucket of the word table, and the most buckets: more
#: would leave a chunk's words in rows of a few.
BUCKET_BYTES = 256 << 20
MAX_BUCKETS = 1 << 14
#: Words that a bucket's table holds; beyond, it starts anew, and a word that
#: comes again is encoded again.
TABLE_WORDS = 1 << 21
#: Rows of a compressed stream.
STREAM_ROWS = 500


def vocabulary(path: str) -> str:
    """The tokenizer file's content, without truncation and padding."""
    tokenizer = Tokenizer.from_file(path)
    tokenizer.no_truncation()
    tokenizer.no_padding()
    if tokenizer.get_vocab_size() > MAX_VOCABULARY:
        raise ValueError("the vocabulary is over MAX_VOCABULARY")
    return tokenizer.to_str()


def _blob(words: list[bytes]) -> bytes:
    return zstandard.ZstdCompressor(3).compress(b"\n".join(words))


def _unblob(blob: bytes) -> list[bytes]:
    return zstandard.ZstdDecompressor().decompress(blob).split(b"\n")


def _encoded(tokenizer: Tokenizer, words: list[bytes]) -> Iterator[tuple[bytes, bytes]]:
    """Each word with its ids, as little-endian unsigned 32-bit integers."""
    for part in itertools.batched(words, 1 << 13):
        found = tokenizer.encode_batch_fast([w.decode() for w in part], add_special_tokens=False)
        yield from zip(part, (array.array("I", e.ids).tobytes() for e in found))


def _words(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, list[bytes]]:
    """Where the words of each text end among all (a zero first), which word
    each is, and the distinct words."""
    lists = pc.ascii_split_whitespace(texts.fill_null(""))
    flat = lists.flatten()
    full = pc.greater(pc.binary_length(flat), 0)  # blanks at an end leave an empty one
    ends = np.concatenate([[0], np.cumsum(full.to_numpy(zero_copy_only=False))])[np.concatenate([[0], np.cumsum(lists.value_lengths().to_numpy())])]
    coded = flat.filter(full).dictionary_encode()
    return ends, coded.indices.to_numpy(), coded.dictionary.cast(pa.binary()).to_pylist()


def _chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        ends = np.cumsum(pc.fill_null(pc.binary_length(batch.column("text")), 0).to_numpy(zero_copy_only=False).astype(np.int64))
        cuts = [0, *(np.flatnonzero(np.diff(ends // CHUNK_BYTES)) + 1).tolist(), batch.num_rows]
        for a, b in itertools.pairwise(cuts):
            if b > a:
                lean()
                yield batch.slice(a, b - a).take(pa.array(range(b - a)))  # a copy without the rest of the batch
        lean()


def _name(batch: pa.RecordBatch) -> str:
    """A chunk's name: what it holds."""
    name = xxhash.xxh3_128()
    for column in batch.columns:
        if pa.types.is_string(column.type):
            column = column.fill_null("").cast(pa.binary())
            name.update(np.ascontiguousarray(column.buffers()[1])[: 4 * len(column) + 4].tobytes())
            name.update(memoryview(column.buffers()[2]) if column.buffers()[2] else b"")
        else:
            name.update(repr(column.to_pylist()).encode())
    return name.hexdigest()


def _spread(words: list[bytes], buckets: int) -> list[list[bytes]]:
    """The words by the bucket of their hash, each bucket in order."""
    out: list[list[bytes]] = [[] for _ in range(buckets)]
    for w in sorted(words):
        out[xxhash.xxh32_intdigest(w) % buckets].append(w)
    return out


def encode(spark: SparkSession, docs: DataFrame, path: str, digests: bool = False) -> DataFrame:
    """The columns of ``docs`` but text, and ids (array of int): the text's
    tokens as the tokenizers library gives them without special tokens added.
    With ``digests``, also n_tokens, ids_sha256 (of the ids as little-endian
    unsigned 32-bit integers) and decoded_sha256 (of what :func:`decode` makes
    of them, in UTF-8), all in the same task.

    ``docs`` is (doc_id, text) or any columns beside text. A null text is
    empty; an empty text, or one of blanks, has no ids. Words of any length are
    encoded whole. Repeated rows stay; an empty table gives no rows.
    """
    rest = [f for f in docs.schema.fields if f.name != "text"]
    names = [f.name for f in rest]
    model = spark.sparkContext.broadcast(vocabulary(path))
    pieces = _pieces(spark, path) if digests else None
    buckets = max(int(spark.conf.get("spark.sql.shuffle.partitions")), min(MAX_BUCKETS, -(-text_bytes(docs) // BUCKET_BYTES)))

    def distinct(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _chunks(batches):
            held: set[bytes] = set()
            for at in range(0, batch.num_rows, STREAM_ROWS):
                held.update(_words(batch.column("text").slice(at, STREAM_ROWS))[2])
            words = _spread(list(held), buckets)
            del held
            used = [b for b in range(buckets) if words[b] or not b]
            yield pa.RecordBatch.from_arrays(
                [pa.array(used, pa.int32()), pa.array([_name(batch)] * len(used), pa.string()), pa.array([_blob(words[b]) for b in used], pa.binary())],
                ["bucket", "chunk", "words"])

    def word_table(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark runs the tasks side by side
        tokenizer, at, table = Tokenizer.from_str(model.value), None, {}
        for batch in batches:
            parts: dict[str, list] = {"chunk": [], "words": [], "ids": []}
            for bucket, chunk, blob in zip(*(batch.column(c).to_pylist() for c in ("bucket", "chunk", "words"))):
                if bucket != at or len(table) > TABLE_WORDS:
                    at, table = bucket, {}
                words = _unblob(blob)
                table.update(_encoded(tokenizer, [w for w in words if w not in table]))
                ids = [table[w] for w in words]
                lengths = np.array([len(i) // 4 for i in ids], "<u4").tobytes()
                parts["chunk"].append(chunk)
                parts["words"].append(blob)
                parts["ids"].append(zstandard.ZstdCompressor(3).compress(lengths + b"".join(ids)))
            lean()
            yield pa.RecordBatch.from_arrays([pa.array(parts["chunk"], pa.string()), pa.array(parts["words"], pa.binary()),
                                              pa.array(parts["ids"], pa.binary())], ["chunk", "words", "ids"])

    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Each chunk as compressed Arrow streams."""
        options = pa.ipc.IpcWriteOptions(compression=pa.Codec("zstd", 3))
        for batch in _chunks(batches):
            name = _name(batch)
            for at in range(0, batch.num_rows, STREAM_ROWS):
                sink = pa.BufferOutputStream()
                with pa.ipc.new_stream(sink, batch.schema, options=options) as out:
                    out.write_batch(batch.slice(at, STREAM_ROWS))
                yield pa.RecordBatch.from_arrays([pa.array([name]), pa.array([sink.getvalue().to_pybytes()], pa.binary())], ["chunk", "rows"])

    def put_back(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lean()
        rows = pa.Table.from_batches(list(batches))
        names_of = pieces and pa.array(pieces.value, pa.string())
        table: dict[bytes, int] = {}
        lengths, flat, streams = [], [], []
        for words, ids, stream in zip(*(rows.column(c) for c in ("words", "ids", "rows"))):
            if stream.is_valid:
                streams.append(stream)
                continue
            words = _unblob(words.as_py())
            whole = np.frombuffer(zstandard.ZstdDecompressor().decompress(ids.as_py()), "<u4")
            table.update(zip(words, range(len(table), len(table) + len(words))))
            lengths.append(whole[: len(words)].astype(np.int64))
            flat.append(whole[len(words):])
        lengths = np.concatenate([np.zeros(0, np.int64), *lengths])
        flat = np.concatenate([np.zeros(0, "<u4"), *flat]).astype(np.int32)
        starts = np.cumsum(lengths) - lengths
        for stream in streams:
            batch = pa.ipc.open_stream(stream.as_buffer()).read_all().combine_chunks()
            ends, codes, words = _words(batch.column("text").combine_chunks())
            try:
                at = np.fromiter(map(table.__getitem__, words), np.int64, len(words))[codes]
            except KeyError as e:
                raise RuntimeError("a chunk of the documents changed between two readings") from e
            n = lengths[at]
            total = np.concatenate([[0], np.cumsum(n)])
            ids = flat[np.repeat(starts[at] - total[:-1], n) + np.arange(total[-1])]
            column = pa.ListArray.from_arrays(pa.array(total[ends], pa.int32()), pa.array(ids))
            new = [column, *_digests(column, names_of)] if names_of else [column]
            yield from pa.table([*(batch.column(c) for c in names), *new], schema).to_batches()
            lean()

    out = StructType([*rest, StructField("ids", ArrayType(IntegerType())), *(DIGESTS if digests else [])])
    schema = to_arrow_schema(out)
    words = docs.mapInArrow(distinct, "bucket int, chunk string, words binary")
    words = words.repartition(buckets, "bucket").sortWithinPartitions("bucket").mapInArrow(word_table, "chunk string, words binary, ids binary")
    rows = docs.mapInArrow(packed, "chunk string, rows binary")
    null = F.lit(None).cast("binary")
    both = words.withColumn("rows", null).unionByName(rows.withColumns({"words": null, "ids": null}))
    return both.groupBy("chunk").applyInArrow(put_back, out)


def _pieces(spark: SparkSession, path: str):
    """The vocabulary as an array of pieces by id, sent to every task."""
    tokenizer = Tokenizer.from_str(vocabulary(path))
    if tokenizer.decoder is not None:
        raise ValueError("this vocabulary's pieces aren't joined by blanks")
    names = {i: piece for piece, i in tokenizer.get_vocab(with_added_tokens=True).items()}
    return spark.sparkContext.broadcast([names.get(i) for i in range(max(names) + 1)])


def _join_pieces(lists: pa.ListArray, table: pa.Array) -> pa.Array:
    known = table.is_valid().to_numpy(zero_copy_only=False)
    flat = lists.flatten().fill_null(-1).to_numpy()
    owner = np.repeat(np.arange(len(lists)), lists.value_lengths().to_numpy())
    ok = (flat >= 0) & (flat < len(known))
    ok[ok] = known[flat[ok]]
    ends = np.concatenate([[0], np.cumsum(np.bincount(owner[ok], minlength=len(lists)))])
    return pc.binary_join(pa.ListArray.from_arrays(pa.array(ends, pa.int32()), table.take(pa.array(flat[ok]))), " ")


def decode(spark: SparkSession, encoded: DataFrame, path: str) -> DataFrame:
    """The columns of ``encoded`` and decoded: the pieces of its ids (array of
    int), special ones too, joined by a blank, as the vocabulary has no decoder.
    Ids without a piece are skipped; null or no ids give an empty text."""
    pieces = _pieces(spark, path)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lean()
        table = pa.array(pieces.value, pa.string())
        for batch in batches:
            decoded = _join_pieces(batch.column("ids").fill_null([]), table)
            yield pa.RecordBatch.from_arrays([*batch.columns, decoded], [*batch.schema.names, "decoded"])

    return encoded.mapInArrow(run, StructType([*encoded.schema.fields, StructField("decoded", StringType())]))


DIGESTS = [StructField("n_tokens", LongType()), StructField("ids_sha256", StringType()), StructField("decoded_sha256", StringType())]


def _digests(lists: pa.ListArray, table: pa.Array) -> list[pa.Array]:
    flat, ends = lists.flatten().to_numpy().astype("<u4"), np.concatenate([[0], np.cumsum(lists.value_lengths().to_numpy())])
    ids = [hashlib.sha256(flat[a:b].tobytes()).hexdigest() for a, b in itertools.pairwise(ends)]
    texts = [hashlib.sha256(t.as_buffer()).hexdigest() for t in _join_pieces(lists, table)]
    return [pa.array(np.diff(ends), pa.int64()), pa.array(ids, pa.string()), pa.array(texts, pa.string())]
