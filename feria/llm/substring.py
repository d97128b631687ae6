"""Removal of repeated passages: words under any window of words that also
starts elsewhere.

A count-min sketch comes first. Each partition (a piece of an Arrow batch)
hashes its windows into the rows of the sketch and sends its counters, which
are mostly zero, as sorted lists of the others; the lists are dealt by ranges
of counters, merged there, and every piece learns which of its counters reach
two. The merged sketch is never in one place: its width and the number of ranges
grow with the text.

A window whose counters all reach two is estimated repeated; no repeated window
is missed, as counters only overestimate. The second pass groups those windows
exactly, by 128 bits of their word sequence, and takes the overestimates back.

Both passes, and the removal, read the documents in pieces that are named by
their content. They have to be the same at each reading, as they are for a
table or a file scan; a piece without its answers raises.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from feria.llm.common import lean, saved, text_bytes

#: log2 of the least counters of a sketch row, one row for each lane of the hash.
WIDTH_BITS = 33
LANES = 2
#: Counters of a row for each word, at least, and words for each range of them.
WORD_COUNTERS = 16
RANGE_WORDS = 1 << 23
#: The least words of a piece at which it ends (a document is never split).
PIECE_WORDS = 1 << 19
#: Odd factors of the two polynomial hashes, and their inverses modulo 2^64.
FACTORS = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F)
INVERSES = tuple(pow(f, -1, 1 << 64) for f in FACTORS)


def _pack(values: np.ndarray, twice: np.ndarray) -> bytes:
    """Ascending 32-bit values and a flag for each, compressed."""
    steps = np.diff(values, prepend=np.uint32(0)).astype("<u4")
    planes = np.ascontiguousarray(steps.view(np.uint8).reshape(-1, 4).T).tobytes()
    return zstandard.ZstdCompressor(1).compress(len(values).to_bytes(8, "little") + planes + np.packbits(twice).tobytes())


def _unpack(blob: bytes) -> tuple[np.ndarray, np.ndarray]:
    raw = zstandard.ZstdDecompressor().decompress(blob)
    n = int.from_bytes(raw[:8], "little")
    planes = np.frombuffer(raw, np.uint8, 4 * n, 8).reshape(4, n)
    values = np.cumsum(np.ascontiguousarray(planes.T).view("<u4").reshape(-1), dtype=np.uint32)
    return values, np.unpackbits(np.frombuffer(raw, np.uint8, -1, 8 + 4 * n), count=n).astype(bool)


def _distinct(ordered: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct of ascending values, and whether each occurs twice or more."""
    first = np.concatenate([[True], ordered[1:] != ordered[:-1]]) if len(ordered) else np.zeros(0, bool)
    at = np.flatnonzero(first)
    return ordered[at], np.diff(np.append(at, len(ordered))) > 1


def _within(values: np.ndarray, ascending: np.ndarray) -> np.ndarray:
    at = np.searchsorted(ascending, values)
    at[at == len(ascending)] = 0
    return ascending[at] == values if len(ascending) else np.zeros(len(values), bool)


class Windows:
    """The window hashes of a piece's texts."""

    def __init__(self, texts: list[bytes], size: int, bits: int = WIDTH_BITS):
        self.bits = bits
        self.words = [t.split() for t in texts]
        lengths = np.array([len(w) for w in self.words], np.int64)
        ends = np.cumsum(lengths)
        n = int(lengths.sum())
        self.lengths, self.ends, self.size = lengths, ends, size
        room = np.repeat(ends, lengths) - np.arange(n) >= size
        self.starts = np.flatnonzero(room)
        raw = b"".join(map(xxhash.xxh3_128_digest, itertools.chain.from_iterable(self.words)))
        lanes = np.frombuffer(raw, "<u8").reshape(-1, 2)
        self.hashes = []
        for lane in range(LANES):
            power = np.full(n, FACTORS[lane], np.uint64)
            power[:1] = 1
            np.cumprod(power, out=power)
            total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(lanes[:, lane] * power, dtype=np.uint64)])
            power[:] = INVERSES[lane]
            power[:1] = 1
            np.cumprod(power, out=power)
            self.hashes.append((total[self.starts + size] - total[self.starts]) * power[self.starts])

    def counters(self, lane: int) -> np.ndarray:
        return self.hashes[lane] >> np.uint64(64 - self.bits)

    def estimated(self, reached: list[np.ndarray]) -> np.ndarray:
        """Which windows the sketch estimates repeated, as places in starts;
        ``reached`` has, for each lane, the counters of the piece at two."""
        found = np.arange(len(self.starts))
        for lane in range(LANES):
            found = found[_within(self.counters(lane)[found], reached[lane])]
        return found

    def covered(self, starts: np.ndarray) -> list[np.ndarray]:
        """For each text, which words lie in the windows at ``starts``."""
        steps = np.zeros(int(self.lengths.sum()) + 1, np.int64)
        np.add.at(steps, starts, 1)
        np.add.at(steps, starts + self.size, -1)
        inside = np.cumsum(steps)[:-1] > 0
        return np.split(inside, self.ends[:-1]) if len(self.ends) else []


def _ordered(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Order of the pairs (a, b), and of each in that order whether it starts a
    run of equal pairs and whether the run is longer than one."""
    order = np.lexsort((b, a))
    x, y = a[order], b[order]
    new = np.concatenate([[True], (x[1:] != x[:-1]) | (y[1:] != y[:-1])]) if len(x) else np.zeros(0, bool)
    run = np.cumsum(new) - 1
    return order, new, np.bincount(run)[run] > 1 if len(x) else new


def _piece(name: str, table: pa.Table) -> tuple[str, bytes]:
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, table.schema) as out:
        out.write_table(table)
    return name, zstandard.ZstdCompressor(3).compress(sink.getvalue().to_pybytes())


def _pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[str, pa.Table, list[bytes]]]:
    for batch in batches:
        table = pa.Table.from_batches([batch])
        sizes = pc.fill_null(pc.binary_length(batch.column("text")), 0).to_numpy(zero_copy_only=False)
        # a word takes some six bytes
        ends = np.cumsum(sizes // 6 + 1, dtype=np.int64)
        for rows in np.split(np.arange(len(sizes)), np.flatnonzero(np.diff(ends // PIECE_WORDS)) + 1):
            if len(rows):
                lean()
                piece = table.slice(rows[0], len(rows))
                own = [t.as_py() or b"" for t in piece.column("text").cast(pa.binary())]
                digest = xxhash.xxh3_128(repr(piece.drop_columns("text").to_pylist()).encode())
                for t in own:
                    digest.update(len(t).to_bytes(8, "little") + t)
                yield digest.hexdigest(), piece, own


def sketch_shape(size: int, parts: int) -> tuple[int, int]:
    """log2 of the counters of a row, and of the ranges they are merged in, for
    ``size`` bytes of text."""
    words = size // 6 + 1  # a word takes some six bytes
    bits = max(WIDTH_BITS, (WORD_COUNTERS * words - 1).bit_length())
    return bits, max(bits - 32, (2 * max(2, parts) - 1).bit_length(), (words // RANGE_WORDS).bit_length())


def _ranged(ascending: np.ndarray, low: int) -> Iterator[tuple[int, int, int]]:
    """(range, start, end) of the ranges of 2^low that hold values."""
    held, starts = np.unique(ascending >> np.uint64(low), return_index=True)
    yield from zip(held.tolist(), starts.tolist(), [*starts[1:].tolist(), len(ascending)])


def remove_repeats(spark: SparkSession, docs: DataFrame, window: int = 35) -> DataFrame:
    """The columns of ``docs`` but text, then n_words, n_removed and kept (the
    words left, joined by a blank).

    A word is removed if it lies in ``window`` consecutive words of a document
    that also start anywhere else in ``docs``, in the same document too;
    windows are judged on the input. A null text has no words, a text of fewer
    words than a window loses none, repeated rows are copies like any other,
    and an empty table gives no rows.
    """
    rest = [f for f in docs.schema.fields if f.name != "text"]
    names = [f.name for f in rest]
    bits, shift = sketch_shape(text_bytes(docs), int(spark.conf.get("spark.sql.shuffle.partitions")))
    ranges, low = 1 << shift, bits - shift

    def sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for name, _, texts in _pieces(batches):
            own = Windows(texts, window, bits)
            keys, blobs = [], []
            for lane in range(LANES):
                cells, twice = _distinct(np.sort(own.counters(lane)))
                held = list(_ranged(cells, low))
                if not held or held[0][0]:  # range 0 always, for its answer
                    held.insert(0, (0, 0, 0))
                for r, a, b in held:
                    keys.append(lane * ranges + r)
                    blobs.append(_pack((cells[a:b] & np.uint64((1 << low) - 1)).astype(np.uint32), twice[a:b]))
            yield pa.RecordBatch.from_arrays([pa.array(keys, pa.int32()), pa.array([name] * len(keys)), pa.array(blobs, pa.binary())],
                                             ["key", "piece", "counters"])

    def merge(rows: pa.Table) -> pa.Table:
        lean()
        lists = [_unpack(c) for c in rows.column("counters").to_pylist()]
        once, more = _distinct(np.sort(np.concatenate([v for v, _ in lists])))
        reached = np.union1d(once[more], np.concatenate([v[t] for v, t in lists]))
        out = []
        for values, _ in lists:
            own = values[_within(values, reached)]
            out.append(_pack(own, np.zeros(len(own), bool)))
        return pa.table([rows.column("key"), rows.column("piece"), pa.array(out, pa.binary())], ["key", "piece", "counters"])

    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for name, table, _ in _pieces(batches):
            name, blob = _piece(name, table)
            yield pa.RecordBatch.from_arrays([pa.array([name]), pa.array([blob], pa.binary())], ["piece", "rows"])

    def opened(rows: pa.Table) -> Iterator[tuple[str, pa.Table, Windows, np.ndarray]]:
        """Each piece of a group with its windows and those estimated repeated."""
        lean()
        keys, lists, blobs = (rows.column(c).to_pylist() for c in ("key", "counters", "rows"))
        answers = sorted((k, c) for k, c, r in zip(keys, lists, blobs) if c is not None and k >= 0)
        if len({k for k, _ in answers if k % ranges == 0}) != LANES or all(r is None for r in blobs):
            raise RuntimeError("a piece of the documents changed between two readings")
        reached = []
        for lane in range(LANES):
            own = [_unpack(c)[0].astype(np.uint64) + np.uint64((k % ranges) << low) for k, c in answers if k // ranges == lane]
            reached.append(np.unique(np.concatenate(own)))
        for blob in blobs:
            if blob is not None:
                table = pa.ipc.open_stream(zstandard.ZstdDecompressor().decompress(blob)).read_all()
                own = Windows([t.as_py() or b"" for t in table.column("text").cast(pa.binary())], window, bits)
                yield rows.column("piece")[0].as_py(), table, own, own.estimated(reached)

    def estimate(rows: pa.Table) -> pa.Table:
        out = {"key": [], "piece": [], "a": [], "b": [], "twice": []}
        for name, _, own, found in opened(rows):
            a, b = (h[found] for h in own.hashes)
            order, new, again = _ordered(a, b)
            a, b, again = a[order][new], b[order][new], again[new]
            for r, s, e in _ranged(a, 64 - shift):
                for k, v in zip(out, (r, name, a[s:e].tobytes(), b[s:e].tobytes(), np.packbits(again[s:e]).tobytes())):
                    out[k].append(v)
        kinds = (pa.int32(), pa.string(), pa.binary(), pa.binary(), pa.binary())
        return pa.table([pa.array(v, k) for v, k in zip(out.values(), kinds)], list(out))

    def group(rows: pa.Table) -> pa.Table:
        lean()
        pieces, a, b, twice = (rows.column(c).to_pylist() for c in ("piece", "a", "b", "twice"))
        a, b = ([np.frombuffer(x, "<u8") for x in v] for v in (a, b))
        marked = np.concatenate([np.unpackbits(np.frombuffer(t, np.uint8), count=len(x)).astype(bool) for t, x in zip(twice, a)])
        owner = np.repeat(np.arange(len(a)), [len(x) for x in a])
        a, b = np.concatenate(a), np.concatenate(b)
        order, _, again = _ordered(a, b)
        single = order[~again & ~marked[order]]
        out = {"piece": [], "single": []}
        for p in np.unique(owner[single]):
            own = single[owner[single] == p]
            out["piece"].append(pieces[p])
            out["single"].append(a[own].tobytes() + b[own].tobytes())
        return pa.table([pa.array(out["piece"], pa.string()), pa.array(out["single"], pa.binary())], list(out))

    result = StructType([*rest, StructField("n_words", LongType()), StructField("n_removed", LongType()), StructField("kept", StringType())])

    def remove(rows: pa.Table) -> pa.Table:
        single = [np.frombuffer(s, "<u8").reshape(2, -1) for s in rows.column("single").to_pylist() if s is not None]
        pairs = {p for s in single for p in zip(*s.tolist())}
        alone = np.unique(np.concatenate([np.zeros(0, np.uint64), *(s[0] for s in single)]))
        out = []
        for _, table, own, found in opened(rows):
            a, b = (h[found] for h in own.hashes)
            doubt = np.flatnonzero(_within(a, alone))
            good = np.ones(len(found), bool)
            good[doubt] = [p not in pairs for p in zip(a[doubt].tolist(), b[doubt].tolist())]
            gone = own.covered(own.starts[found[good]])
            kept = [b" ".join(itertools.compress(w, ~g)) if g.any() else b" ".join(w) for w, g in zip(own.words, gone)]
            out.append(pa.table([*(table.column(n) for n in names), pa.array(own.lengths), pa.array([int(g.sum()) for g in gone], pa.int64()),
                                 pa.array(kept, pa.binary()).cast(pa.string())], [*names, "n_words", "n_removed", "kept"]))
        return pa.concat_tables(out)

    def nulls(df: DataFrame, **kinds: str) -> DataFrame:
        return df.withColumns({c: F.lit(None).cast(k) for c, k in kinds.items()})

    counters = docs.mapInArrow(sketch, "key int, piece string, counters binary")
    reached = saved(counters.groupBy("key").applyInArrow(merge, "key int, piece string, counters binary"), "substring-sketch")
    rows = docs.mapInArrow(packed, "piece string, rows binary")
    rows = nulls(rows, key="int", counters="binary")
    both = nulls(reached, rows="binary").unionByName(rows)
    guesses = both.groupBy("piece").applyInArrow(estimate, "key int, piece string, a binary, b binary, twice binary")
    single = saved(guesses.groupBy("key").applyInArrow(group, "piece string, single binary"), "substring-single")
    told = nulls(single, key="int", counters="binary", rows="binary").unionByName(nulls(both, single="binary"))
    return told.groupBy("piece").applyInArrow(remove, result)
