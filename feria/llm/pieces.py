"""SentencePiece encoding by a table of each prefix's last token, and decoding.

BPE joins, again and again, the adjacent symbols whose join is the best-scored
piece, the leftmost of equals. What it does inside a stretch that ends at a
boundary of its result does not depend on what follows. So each prefix of a
text has one last token, and a sequence of tokens is the encoding if and only
if every two neighbours are: joined, they encode to themselves. The table is
filled from left to right: an automaton of all pieces gives those that end at a
position, and the one that is compatible with the last token of the prefix
before it is the last token here. The ids are read off backwards.

Two tokens are compatible if no symbol at the right edge of the first, at any
stage of its making, joins to a piece with one at the left edge of the second;
where some do, their text is encoded by merging, once a pair.

Nothing is joined over two letters that are neighbours in no piece, such as a
letter and a blank after it: texts are cut there, and a distinct segment is
encoded once by each task that meets it. Segments of any length are encoded
whole.
"""

from __future__ import annotations

import hashlib
import itertools
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import sentencepiece
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import ArrayType, IntegerType, LongType, StringType, StructField, StructType

from feria.llm.common import lean

#: The most pieces of a model that is sent to every task.
MAX_PIECES = 1 << 20
#: Bytes of text that a task works on at one time (a document is never split).
CHUNK_BYTES = 8 << 20
#: Segments, and pairs of tokens, that a worker keeps the answer of.
KEPT_SEGMENTS, KEPT_PAIRS = 300_000, 2_000_000

BLANK = "▁"
DIGESTS = [StructField("n_tokens", LongType()), StructField("ids_sha256", StringType()), StructField("decoded_sha256", StringType())]


def read_model(path: str) -> dict:
    """What the tasks need of a model file: pieces, scores, begin, end and byte ids."""
    model = sentencepiece.SentencePieceProcessor(model_file=path)
    size = model.get_piece_size()
    if size > MAX_PIECES:
        raise ValueError("the model has over MAX_PIECES pieces")
    if model.normalize(" ﬁ  A ") != BLANK * 2 + "ﬁ" + BLANK * 2 + "A" + BLANK:
        raise ValueError("the model changes texts by more than blanks and a leading one")
    special = [model.is_control(i) or model.is_unknown(i) or model.is_byte(i) for i in range(size)]
    names = [model.id_to_piece(i) for i in range(size)]
    tokens = {names[i]: (model.get_score(i), i) for i in range(size) if not special[i]}
    letters = {p for p in tokens if len(p) == 1}
    bytes_at = [model.piece_to_id(f"<0x{b:02X}>") for b in range(256)]
    if not all(model.is_byte(i) for i in bytes_at):
        raise ValueError("the model has no bytes to fall back on")
    if any(set(p) - letters for p in tokens):
        raise ValueError("pieces of letters without a piece")
    hidden = [model.is_control(i) for i in range(size)]
    digest = hashlib.sha256(model.serialized_model_proto()).hexdigest()
    return {"digest": digest, "tokens": tokens, "names": names, "hidden": hidden, "unknown": model.unk_id(), "bytes": bytes_at,
            "begin": model.bos_id(), "end": model.eos_id()}


def merge(tokens: dict[str, tuple[float, int]], text: str) -> tuple[list[str], list[str], list[str]]:
    """The symbols that merging makes of a short ``text``, and every symbol that
    was at its left edge, and at its right, on the way."""
    parts = list(text)
    left, right = [parts[0]], [parts[-1]]
    while True:
        found = [(-tokens[a + b][0], i) for i, (a, b) in enumerate(itertools.pairwise(parts)) if a + b in tokens]
        if not found:
            return parts, left, right
        _, i = min(found)
        parts[i: i + 2] = [parts[i] + parts[i + 1]]
        if i == 0:
            left.append(parts[0])
        if i == len(parts) - 1:
            right.append(parts[-1])


class Encoder:
    """The prefix table of one model."""

    def __init__(self, model: dict):
        self.tokens, self.bytes = model["tokens"], model["bytes"]
        self.automaton = ahocorasick.Automaton()
        self.size, self.name, self.left, self.right = {}, {}, {}, {}
        for name, (_, i) in self.tokens.items():
            parts, left, right = merge(self.tokens, name)
            if len(parts) == 1:  # others are never made
                self.automaton.add_word(name, (i, len(name)))
                self.size[i], self.name[i], self.left[i], self.right[i] = len(name), name, left, right
        self.automaton.make_automaton()
        self.cuts = cut_table(self.tokens)
        self.pairs: dict[tuple[int, int], bool] = {}
        self.segments: dict[str, np.ndarray] = {}

    def compatible(self, a: int, b: int) -> bool:
        if len(self.pairs) >= KEPT_PAIRS:
            self.pairs.clear()
        fit = not any(x + y in self.tokens for x in self.right[a] for y in self.left[b])
        fit = fit or merge(self.tokens, self.name[a] + self.name[b])[0] == [self.name[a], self.name[b]]
        self.pairs[a, b] = fit
        return fit

    def encode(self, text: str) -> list[int]:
        # By place; 0 is a letter without a piece, joined to nothing, and so is
        # the place more at the end, which is looked up before the first letter.
        last = [0] * (len(text) + 1)
        pairs = self.pairs
        for end, (token, size) in self.automaton.iter(text):
            if not last[end]:
                if before := last[end - size]:
                    fit = pairs.get((before, token))
                    if fit is None:
                        fit = self.compatible(before, token)
                    if not fit:
                        continue
                last[end] = token
        ids, at = [], len(text) - 1
        while at >= 0:
            if token := last[at]:
                ids.append(token)
                at -= self.size[token]
            else:
                ids.extend(self.bytes[b] for b in reversed(text[at].encode()))
                at -= 1
        ids.reverse()
        return ids

    def segment(self, text: str) -> np.ndarray:
        ids = self.segments.get(text)
        if ids is None:
            if len(self.segments) >= KEPT_SEGMENTS:
                self.segments.clear()
            self.segments[text] = ids = np.array(self.encode(text), np.int32)
        return ids


def cut_table(tokens: dict[str, tuple[float, int]]) -> np.ndarray:
    """Whether a text is cut between two bytes, at 256 times the first plus the
    second: where a letter starts and no piece has the bytes side by side."""
    table = np.ones((256, 256), bool)
    table[:, 0x80:0xC0] = False
    for piece in tokens:
        held = np.frombuffer(piece.replace(BLANK, " ").encode(), np.uint8)
        table[held[:-1], held[1:]] = False
    return table.ravel()


def segments(texts: pa.Array, cut: np.ndarray) -> tuple[np.ndarray, np.ndarray, list[str]]:
    """Where the segments of each text end among all (a zero first), which
    segment each is, and the distinct ones."""
    texts = pc.replace_substring(texts.fill_null(""), BLANK, " ")
    texts = pc.if_else(pc.equal(texts, ""), "", pc.binary_join_element_wise(" ", texts, ""))
    ends = np.concatenate([[0], np.cumsum(pc.binary_length(texts).to_numpy())])
    data = np.frombuffer(b"".join(t.as_buffer() for t in texts), np.uint8)
    starts = np.ones(len(data), bool)
    starts[1:] = cut[(data[:-1].astype(np.uint16) << 8) | data[1:]]
    starts[ends[:-1][np.diff(ends) > 0]] = True
    cuts = np.append(np.flatnonzero(starts), len(data)).astype(np.int32)
    each = pa.StringArray.from_buffers(len(cuts) - 1, pa.py_buffer(cuts), pa.py_buffer(data))
    coded = each.dictionary_encode()
    distinct = [s.replace(" ", BLANK) for s in coded.dictionary.to_pylist()]
    return np.concatenate([[0], np.cumsum(starts)])[ends], coded.indices.to_numpy(), distinct


def token_lists(model: Encoder, texts: pa.Array, begin: int, end: int) -> pa.ListArray:
    """The ids of each text, between ``begin`` and ``end``."""
    ends, codes, distinct = segments(texts, model.cuts)
    ids = [model.segment(s) for s in distinct] + [np.array([i], np.int32) for i in (begin, end)]
    lengths = np.fromiter(map(len, ids), np.int64, len(ids))
    flat = np.concatenate(ids)
    starts = np.cumsum(lengths) - lengths
    first, last = len(distinct), len(distinct) + 1
    at = np.insert(codes.astype(np.int64), np.repeat(ends, 2)[1:-1], np.tile([first, last], len(texts)))
    n = lengths[at]
    total = np.concatenate([[0], np.cumsum(n)])
    whole = flat[np.repeat(starts[at] - total[:-1], n) + np.arange(total[-1])]
    return pa.ListArray.from_arrays(pa.array(total[ends + 2 * np.arange(len(ends))], pa.int32()), pa.array(whole))


def _chunks(batches: Iterator[pa.RecordBatch], column: str) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        held = batch.column(column)
        sizes = pc.fill_null(pc.binary_length(held) if pa.types.is_string(held.type) else pc.list_value_length(held), 0)
        ends = np.cumsum(sizes.to_numpy(zero_copy_only=False).astype(np.int64))
        cuts = [0, *(np.flatnonzero(np.diff(ends // CHUNK_BYTES)) + 1).tolist(), batch.num_rows]
        for a, b in itertools.pairwise(cuts):
            if b > a:
                lean()
                yield batch.slice(a, b - a).take(pa.array(range(b - a)))
        lean()


def _letters(run: bytes) -> str:
    """A run of byte tokens as text; a byte that is part of no letter gives the
    replacement sign."""
    out, at = [], 0
    while at < len(run):
        for size in (1, 2, 3, 4):
            try:
                out.append(run[at: at + size].decode())
                at += size
                break
            except UnicodeDecodeError:
                continue
        else:
            out.append("�")
            at += 1
    return "".join(out)


class Decoder:
    def __init__(self, model: dict):
        self.byte = {i: b for b, i in enumerate(model["bytes"])}
        plain = [n.replace(BLANK, " ").encode() for n in model["names"]]
        for i, hidden in enumerate(model["hidden"]):
            if hidden:
                plain[i] = b""
        for i, b in self.byte.items():
            plain[i] = bytes([b])
        plain[model["unknown"]] = " ⁇ ".encode()
        self.plain = pa.array(plain, pa.binary())
        self.leading = np.array([n.startswith(BLANK) and not h for n, h in zip(model["names"], model["hidden"])])
        self.hidden = np.array(model["hidden"])

    def decode(self, lists: pa.ListArray) -> list[bytes]:
        """The text of each list of ids; ids that the model lacks are skipped."""
        flat = lists.flatten().fill_null(-1).to_numpy()
        ends = np.concatenate([[0], np.cumsum(pc.fill_null(lists.value_lengths(), 0).to_numpy())])
        ok = (flat >= 0) & (flat < len(self.hidden))
        ends = np.concatenate([[0], np.cumsum(ok)])[ends]
        flat = flat[ok]
        joined = pc.binary_join(pa.ListArray.from_arrays(pa.array(ends, pa.int32()), self.plain.take(pa.array(flat))), pa.scalar(b"", pa.binary()))
        shown = np.concatenate([[0], np.cumsum(~self.hidden[flat])])
        out = []
        for i, text in enumerate(joined):
            text = text.as_py()
            a, b = ends[i], ends[i + 1]
            try:
                text.decode()
                parted = b - a > 2 and shown[b - 1] - shown[a + 1] < b - a - 2  # a hidden token may part bytes
            except UnicodeDecodeError:
                parted = True
            if parted:
                text = self.mended(flat[a:b].tolist())
            # the blank put before a text goes, if the first token shown has one
            first = a + int(np.searchsorted(shown[a: b + 1], shown[a] + 1)) - 1 if shown[b] > shown[a] else b
            out.append(text[1:] if first < b and self.leading[flat[first]] else text)
        return out

    def mended(self, ids: list[int]) -> bytes:
        out = []
        for is_byte, group in itertools.groupby(ids, self.byte.__contains__):
            if is_byte:
                out.append(_letters(bytes(self.byte[i] for i in group)).encode())
            else:
                out.extend(self.plain[i].as_py() for i in group)
        return b"".join(out)


_ready: dict[str, tuple[Encoder, Decoder]] = {}


def _coders(model) -> tuple[Encoder, Decoder]:
    """Made once in a worker from the broadcast ``model``."""
    name = model.value["digest"]
    if name not in _ready:
        _ready.clear()
        _ready[name] = Encoder(model.value), Decoder(model.value)
    return _ready[name]


def encode(spark: SparkSession, docs: DataFrame, path: str, digests: bool = False) -> DataFrame:
    """The columns of ``docs`` but text, and ids (array of int): the text's
    tokens as the sentencepiece library gives them with begin and end ids. With
    ``digests``, also n_tokens, ids_sha256 (of the ids as little-endian unsigned
    32-bit integers) and decoded_sha256 (of what :func:`decode` makes of them).

    A null or empty text has the begin and end ids only; texts and words of any
    length are encoded whole; repeated rows stay; an empty table gives no rows;
    input columns named like a new one raise.
    """
    rest = [f for f in docs.schema.fields if f.name != "text"]
    new = [StructField("ids", ArrayType(IntegerType())), *(DIGESTS if digests else [])]
    _no_clash(rest, new)
    model = spark.sparkContext.broadcast(read_model(path))
    plain, text = _plain(docs, "text")
    names = [c for c in plain.columns if c != text]
    out = StructType([*rest, *new])
    schema = to_arrow_schema(out)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc, dec = _coders(model)
        begin, end = model.value["begin"], model.value["end"]
        for batch in _chunks(batches, text):
            lists = token_lists(enc, batch.column(text), begin, end)
            columns = [*(batch.column(c) for c in names), lists]
            if digests:
                flat, ends = lists.flatten().to_numpy().astype("<u4"), lists.offsets.to_numpy()
                columns += [pa.array(np.diff(ends), pa.int64()),
                            pa.array([hashlib.sha256(flat[a:b]).hexdigest() for a, b in itertools.pairwise(ends)], pa.string()),
                            pa.array([hashlib.sha256(t).hexdigest() for t in dec.decode(lists)], pa.string())]
            yield from pa.table(columns, schema).to_batches()

    return plain.mapInArrow(run, out)


def decode(spark: SparkSession, encoded: DataFrame, path: str) -> DataFrame:
    """The columns of ``encoded`` and decoded: the text of its ids (array of
    int), as the library's decode gives it. Ids that the model lacks are
    skipped; null or no ids give an empty text; a column named decoded raises."""
    new = [StructField("decoded", StringType())]
    _no_clash(encoded.schema.fields, new)
    model = spark.sparkContext.broadcast(read_model(path))
    plain, ids = _plain(encoded, "ids")
    out = StructType([*encoded.schema.fields, *new])
    schema = to_arrow_schema(out)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        dec = _coders(model)[1]
        for batch in _chunks(batches, ids):
            texts = pa.array(dec.decode(batch.column(ids)), pa.binary()).cast(pa.string())
            yield from pa.table([*batch.columns, texts], schema).to_batches()

    return plain.mapInArrow(run, out)


def _plain(df: DataFrame, column: str) -> tuple[DataFrame, str]:
    """``df`` under names without dots or repeats, and the new one of ``column``."""
    return df.toDF(*[f"c{i}" for i in range(len(df.columns))]), f"c{df.columns.index(column)}"


def _no_clash(fields: list[StructField], new: list[StructField]) -> None:
    if clash := {f.name.lower() for f in fields} & {f.name.lower() for f in new}:
        raise ValueError(f"the input has columns named like results: {sorted(clash)}")
