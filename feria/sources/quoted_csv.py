"""Records of CSV files whose quoted fields hold line breaks, read in parallel.

Spark's ``multiLine`` reader makes one task of a file. Here every split is read
as lines. Whether a split starts inside quotes follows from the parity of the
quotes in all splits before it, so one aggregation over the lines (a row per
split, as many as the scan's own plan has) and a running parity over the splits
of each file settle all starts. Each split then joins its lines to records;
a record cut by the end of a split is one fragment there and one in each split
after it, and only fragments are shuffled.

Quotes are taken as in RFC 4180: a field that holds one is quoted, and a quote
in it is doubled. A file that ends inside quotes raises.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

Split = tuple[str, int]


def _lines(spark: SparkSession, path: str) -> DataFrame:
    at = F.col("_metadata")
    return spark.read.option("lineSep", "\n").text(path).select(
        "value", at["file_path"].alias("file"), at["file_block_start"].alias("block"))


def split_starts(lines: DataFrame) -> tuple[dict[Split, bool], dict[Split, int]]:
    """Of each split (file, block): whether it starts inside quotes, and the
    block where the record that it starts inside of began."""
    odd = (F.length("value") - F.length(F.replace(F.col("value"), F.lit('"'), F.lit("")))) % 2
    per_split = lines.select("file", "block", odd.alias("odd")).groupBy("file", "block").agg(
        F.sum("odd").alias("odd"), F.max("odd").alias("closes"))
    inside: dict[Split, bool] = {}
    owner: dict[Split, int] = {}
    file, quoted, began = None, False, 0
    for r in sorted(per_split.collect()):  # a row per split
        if r.file != file:
            if quoted:
                raise ValueError(f"{file} ends inside quotes")
            file, quoted, began = r.file, False, r.block
        inside[r.file, r.block], owner[r.file, r.block] = quoted, began
        if not quoted or r.closes:  # the last record starts in this split
            began = r.block
        quoted ^= bool(r.odd % 2)
    if quoted:
        raise ValueError(f"{file} ends inside quotes")
    return inside, owner


SCHEMA = "file string, owner long, block long, record string, first boolean"


class _Joiner:
    """Joins the lines of one split, batch after batch."""

    def __init__(self, split: Split, inside: bool, owner: int):
        self.split, self.rest, self.owner = split, inside, owner
        self.odd = inside          # after the lines so far
        self.open: list[str] = []  # lines of the record, or of the rest of one, that is open
        self.first = split[1] == 0  # the next record is the file's first

    def add(self, lines: pa.Array) -> list[pa.Array]:
        """The whole records that the lines complete (as text, and whether each
        is the file's first), and rows of a fragment where one ends."""
        flips = pc.bit_wise_and(pc.count_substring(lines, '"'), 1).to_numpy(zero_copy_only=False)
        after = (np.cumsum(flips) + self.odd) % 2
        self.odd = bool(after[-1])
        ends = np.flatnonzero(after == 0) + 1  # a record ends with these lines
        out = []
        if len(ends) and self.open or len(ends) and self.rest:
            joined = "\n".join([*self.open, *lines[: ends[0]].to_pylist()])
            if self.rest:
                out.append(self._row(joined, self.owner, False))
                self.rest = False
            else:
                out.append(self._row(joined, None, self.first))
                self.first = False
            self.open, begin, ends = [], ends[0], ends[1:]
        else:
            begin = 0
        if len(ends):
            cuts = pa.array(np.concatenate([[begin], ends]), pa.int32())
            records = pc.binary_join(pa.ListArray.from_arrays(cuts, lines), "\n")
            first = np.zeros(len(records), bool)
            first[0], self.first = self.first, False
            out.append(self._rows(records, None, first))
            begin = ends[-1]
        self.open += lines[int(begin):].to_pylist()
        return out

    def end(self) -> list[pa.RecordBatch]:
        """The fragment that the end of the split leaves."""
        if not self.open:
            return []
        return [self._row("\n".join(self.open), self.owner if self.rest else self.split[1], self.first and not self.rest)]

    def _row(self, record: str, owner: int | None, first: bool) -> pa.RecordBatch:
        return self._rows(pa.array([record], pa.string()), owner, np.array([first]))

    def _rows(self, records: pa.Array, owner: int | None, first: np.ndarray) -> pa.RecordBatch:
        n = len(records)
        return pa.RecordBatch.from_arrays(
            [pa.array([self.split[0]] * n, pa.string()), pa.array([owner] * n, pa.int64()), pa.array([self.split[1]] * n, pa.int64()),
             records, pa.array(first)], ["file", "owner", "block", "record", "first"])


def _joined(lines: DataFrame, starts: tuple[dict[Split, bool], dict[Split, int]], fragments: bool) -> DataFrame:
    """Whole records, or the fragments: rows with an owner."""
    inside, owner = starts

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        joiner = None
        for batch in batches:
            files, blocks = batch.column("file").dictionary_encode(), batch.column("block").to_numpy()
            change = np.flatnonzero((np.diff(files.indices.to_numpy()) != 0) | (np.diff(blocks) != 0)) + 1
            for a, b in zip([0, *change], [*change, batch.num_rows]):
                if a == b:
                    continue
                split = (files[int(a)].as_py(), int(blocks[a]))
                if joiner is None or joiner.split != split:
                    if joiner:
                        yield from _of(joiner.end(), fragments)
                    joiner = _Joiner(split, inside[split], owner[split])
                yield from _of(joiner.add(batch.column("value").slice(int(a), int(b - a)).fill_null("")), fragments)
        if joiner:
            yield from _of(joiner.end(), fragments)

    return lines.mapInArrow(run, SCHEMA)


def _of(rows: list[pa.RecordBatch], fragments: bool) -> Iterator[pa.RecordBatch]:
    return (r for r in rows if r.column("owner")[0].is_valid == fragments)


def quoted_records(spark: SparkSession, path: str) -> DataFrame:
    """record: the text of every record of the CSV files at ``path`` but their
    first (the header), without the line break at its end. Empty lines are
    skipped; an empty file, or one of a header only, gives no rows."""
    lines = _lines(spark, path)
    starts = split_starts(lines)
    whole = _joined(lines, starts, False).select("record", "first")
    parts = _joined(lines, starts, True).groupBy("file", "owner").agg(
        F.array_sort(F.collect_list(F.struct("block", "record"))).alias("parts"), F.max("first").alias("first"))
    cut = parts.select(F.array_join(F.transform("parts", lambda p: p["record"]), "\n").alias("record"), "first")
    record = F.regexp_replace("record", "\r$", "")
    return whole.union(cut).where(~F.col("first")).select(record.alias("record")).where("record <> ''")
