"""URL filter over a sorted array of 64-bit digests.

The entries (``host/path-prefix``) become flat files: the sorted XXH64
digests, the offsets of the entries' strings in the same order, and the
strings. They are written to the shared folder and Spark ships them to every
executor; each task memory-maps them, probes the digests with a vectorised
binary search for every (host suffix, path prefix) a url could be listed
under, and compares the stored string of each hit, so that a digest collision
never decides.
"""

from __future__ import annotations

import io
import uuid
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import SparkFiles
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from feria.llm.common import shared_dir

#: The most bytes of entries that one list may hold; beyond it, split the list.
MAX_LIST_BYTES = 1 << 30
#: What an entry's stored string ends with.
KINDS = {"allow": b"+", "block": b"-", "listed": b"x"}


def digest_arrays(rules: Iterable[tuple[str, str]], blocklist: Iterable[str]) -> dict[str, np.ndarray]:
    """The arrays of the list: digests in order, offsets, strings, and the
    shape (most labels of a host; the lengths of the path prefixes)."""
    kinds: dict[bytes, str] = {}
    for entry, kind in [*((e, "listed") for e in blocklist), *rules]:
        if kind not in KINDS or "/" not in entry:
            raise ValueError(f"not an entry: {entry!r}, {kind!r}")
        if kinds.get(key := entry.encode(), "listed") not in ("listed", kind):
            raise ValueError(f"{entry!r} is both allowed and blocked")
        kinds[key] = kind
    if sum(map(len, kinds)) > MAX_LIST_BYTES:
        raise ValueError("the list is over MAX_LIST_BYTES")
    rows = sorted((xxhash.xxh64_intdigest(k), k + KINDS[v], k) for k, v in kinds.items())
    hosts = [k[: k.index(b"/")] for _, _, k in rows]
    return {
        "digests": np.array([d for d, _, _ in rows], np.uint64),
        "offsets": np.cumsum([0, *(len(s) for _, s, _ in rows)]).astype(np.int64),
        "strings": np.frombuffer(b"".join(s for _, s, _ in rows), np.uint8),
        "shape": np.array([max((h.count(b".") + 1 for h in hosts), default=0),
                           *sorted({len(k) - len(h) for h, (_, _, k) in zip(hosts, rows, strict=True)})], np.int64),
    }


def ship(spark: SparkSession, arrays: dict[str, np.ndarray]) -> dict[str, str]:
    """Write the arrays to the shared folder, hand them to every executor, and
    give the name each has there."""
    names = {}
    for kind, array in arrays.items():
        names[kind] = f"{kind}-{uuid.uuid4().hex}.npy"
        np.save(buffer := io.BytesIO(), array)
        path = spark._jvm.org.apache.hadoop.fs.Path(f"{shared_dir(spark)}/{names[kind]}")
        out = path.getFileSystem(spark._jsc.hadoopConfiguration()).create(path)
        out.write(bytearray(buffer.getvalue()))
        out.close()
        spark.sparkContext.addFile(path.toString())
    return names


class UrlList:
    """The mapped arrays of a list, as a task sees them."""

    def __init__(self, paths: dict[str, str]):
        def mapped(name: str) -> np.ndarray:
            # an empty array cannot be mapped
            return np.load(paths[name], mmap_mode="r" if name == "offsets" or self.offsets[-1] else None)
        self.offsets = mapped("offsets")
        self.digests, self.strings = mapped("digests"), mapped("strings")
        self.labels, *self.prefixes = np.load(paths["shape"]).tolist()

    def candidates(self, host: bytes, path: bytes) -> Iterator[bytes]:
        parts = host.split(b".")
        hosts = [b".".join(parts[i:]) for i in range(max(0, len(parts) - self.labels), len(parts))]
        for n in self.prefixes:
            if n > len(path):
                return
            for h in hosts:
                yield h + path[:n]

    def match(self, hosts: list[str], paths: list[str]) -> list[tuple[str | None, str | None]]:
        """(rule, verdict) of each url, by its longest rule, else its list."""
        keys: list[bytes] = []
        owner: list[int] = []
        for i, (h, p) in enumerate(zip(hosts, paths, strict=True)):
            for key in self.candidates(h.encode(), p.encode()):
                keys.append(key)
                owner.append(i)
        found: list[tuple[str | None, str | None]] = [(None, None)] * len(hosts)
        if not keys or not self.digests.size:
            return found
        probes = np.array([xxhash.xxh64_intdigest(k) for k in keys], np.uint64)
        left = np.searchsorted(self.digests, probes, "left")
        right = np.searchsorted(self.digests, probes, "right")
        for q in np.flatnonzero(right > left):
            for at in range(left[q], right[q]):  # more than one only after a collision
                stored = self.strings[self.offsets[at]: self.offsets[at + 1]].tobytes()
                if stored[:-1] != keys[q]:
                    continue
                rule = found[owner[q]][0]
                if stored.endswith(KINDS["listed"]):
                    if rule is None:
                        found[owner[q]] = None, "block"
                elif len(keys[q]) > len((rule or "").encode()):
                    found[owner[q]] = keys[q].decode(), "allow" if stored.endswith(KINDS["allow"]) else "block"
        return found


def split_url(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path; both empty without ``://``."""
    pattern = r"(?s)^.*?://([^/?#]*)([^?#]*)"
    host, path = (F.coalesce(F.regexp_extract(url, pattern, i), F.lit("")) for i in (1, 2))
    return F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"), path


def filter_urls(spark: SparkSession, pages: DataFrame, rules: Iterable[tuple[str, str]],
                blocklist: Iterable[str] = ()) -> DataFrame:
    """page_id, host, path, rule, verdict of every row of ``pages``.

    ``rules`` are (``host/path-prefix``, ``block`` or ``allow``), ``blocklist``
    further entries to block, :data:`MAX_LIST_BYTES` together. An entry fits
    its host and all subdomains if the url's path starts with the entry's. The
    longest rule wins; where no rule fits, a listed url is blocked and any
    other allowed.

    Null urls, and urls without ``://``, have an empty host and path, so no
    entry fits; neither does one fit an empty path. Repeated rows stay, an
    empty table gives no rows, and other columns are ignored.
    """
    names = ship(spark, digest_arrays(rules, blocklist))
    host, path = split_url(F.col("url"))
    urls = pages.select(F.col("page_id"), host.alias("host"), path.alias("path"))
    schema = StructType([*urls.schema.fields, StructField("rule", StringType()), StructField("verdict", StringType())])

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        listed = UrlList({k: SparkFiles.get(n) for k, n in names.items()})
        for batch in batches:
            found = listed.match(batch.column("host").to_pylist(), batch.column("path").to_pylist())
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array([r for r, _ in found], pa.string()),
                 pa.array([v or "allow" for _, v in found], pa.string())],
                [*batch.schema.names, "rule", "verdict"])

    return urls.mapInArrow(judge, schema)
