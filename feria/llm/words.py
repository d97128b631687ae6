"""Words of an Arrow batch of texts, split without a Python object per word."""

from __future__ import annotations

import itertools
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from feria.llm.common import lean

#: Classes of bytes: part of a word, a blank between words, a break of pieces.
WORD, BLANK, BREAK = 0, 1, 2


def byte_classes(blanks: bytes, breaks: bytes = b"") -> np.ndarray:
    classes = np.zeros(256, np.uint8)
    classes[list(blanks)] = BLANK
    classes[list(breaks)] = BREAK
    return classes


#: What parts words by the contracts: blank and \t \n \v \f \r.
BLANKS = byte_classes(b" \t\n\x0b\x0c\r")


@dataclass
class Words:
    ends: np.ndarray     # where the words of each text end among all, a zero first
    codes: np.ndarray    # which of the distinct words each is
    distinct: pa.BinaryArray
    piece: np.ndarray    # rises where a text or a piece of it ends


def split(texts: pa.Array, classes: np.ndarray = BLANKS, lower: bool = False) -> Words:
    """The words of ``texts``, a null being empty; ``lower``: A-Z lower-cased."""
    texts = texts.fill_null("")
    offsets = np.frombuffer(texts.buffers()[1], np.int32)[texts.offset: texts.offset + len(texts) + 1]
    held = texts.buffers()[2]
    data = np.frombuffer(held, np.uint8)[offsets[0]: offsets[-1]] if held else np.zeros(0, np.uint8)
    bounds = (offsets - offsets[0]).astype(np.int64)
    if lower:
        table = np.arange(256, dtype=np.uint8)
        table[65:91] += 32
        data = table[data]
    kinds = classes[data]
    inside = kinds == WORD
    starts = inside.copy()
    starts[1:] &= ~inside[:-1]
    first = bounds[:-1][np.diff(bounds) > 0]
    starts[first] = inside[first]
    at = np.flatnonzero(starts)
    cuts = np.append(np.cumsum(inside)[at] - 1, inside.sum()).astype(np.int32)
    each = pa.BinaryArray.from_buffers(pa.binary(), len(at), [None, pa.py_buffer(cuts), pa.py_buffer(np.ascontiguousarray(data[inside]))])
    coded = each.dictionary_encode()
    ends = np.concatenate([[0], np.cumsum(starts)])[bounds]
    piece = np.repeat(np.arange(len(texts)), np.diff(ends))
    if (classes == BREAK).any():
        piece = piece + np.cumsum(kinds == BREAK)[at]
    return Words(ends, coded.indices.to_numpy(), coded.dictionary, piece)


def joined(words: Words, keep: np.ndarray) -> pa.Array:
    """Each text's words that are kept, joined by one blank."""
    ends = np.concatenate([[0], np.cumsum(keep)])[words.ends]
    lists = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), words.distinct.take(pa.array(words.codes[keep])))
    return pc.binary_join(lists, pa.scalar(b" ", pa.binary()))


def chunks(batches: Iterator[pa.RecordBatch], column: str, size: int) -> Iterator[pa.RecordBatch]:
    """The rows in runs of about ``size`` bytes of text; no text is split."""
    for batch in batches:
        ends = np.cumsum(pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False).astype(np.int64))
        cuts = [0, *(np.flatnonzero(np.diff(ends // size)) + 1).tolist(), batch.num_rows]
        for a, b in itertools.pairwise(cuts):
            if b > a:
                lean()
                yield batch.slice(a, b - a).take(pa.array(range(b - a)))  # a copy without the rest of the batch
        lean()
