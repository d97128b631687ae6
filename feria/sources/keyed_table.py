"""A Parquet table with a primary key that is appended to without being read.

The rows lie in folders by a hash of their key. Beside the rows each bucket has
a filter: bits of its keys' hashes, added to with every append. A batch first
asks the filters of the buckets it hits; a key whose bit is not set is new. Only
buckets where some bit is set are read, and of them only the key columns. So
what an append reads grows with the batch, not with the table, and the answer
is exact whatever the filters hold.

The filter of new keys is written before their rows: a run that is cut off
leaves bits without rows, which cost a look into a bucket, never a row without
its bit. One writer at a time.
"""

from __future__ import annotations

import json
import os
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from feria.operators.dedup import By, first_per_key
from feria.session import work_dir
from feria.sources.sinks import path_exists, read_text, remove_path, write_text

#: The bits that a row of Spark's bitmap functions holds.
ROW_BITS = 32768


@dataclass(frozen=True)
class Appended:
    appended: int
    skipped: int
    buckets_hit: int   # buckets that the batch has keys for
    buckets_read: int  # buckets whose keys were read


class KeyedTable:
    """``keys`` may hold NULLs, which equal each other. ``buckets`` and ``bits``
    (per bucket) are fixed when the table is made; an existing one keeps its own."""

    def __init__(self, spark: SparkSession, path: str, keys: list[str], buckets: int = 256, bits: int = 1 << 22):
        self.spark, self.path = spark, path.rstrip("/")
        about = os.path.join(self.path, "_table.json")
        if path_exists(spark, about):
            known = json.loads(read_text(spark, about))
            if known["keys"] != keys:
                raise ValueError(f"{path} has the key {known['keys']}, not {keys}")
            buckets, bits = known["buckets"], known["bits"]
        else:
            if buckets < 1 or bits < ROW_BITS or bits % ROW_BITS:
                raise ValueError(f"buckets has to be positive and bits a multiple of {ROW_BITS}")
            write_text(spark, about, json.dumps({"keys": keys, "buckets": buckets, "bits": bits}))
        self.keys, self.buckets, self.bits = keys, buckets, bits

    @property
    def _rows(self) -> str:
        return os.path.join(self.path, "rows")

    @property
    def _filters(self) -> str:
        return os.path.join(self.path, "filters")

    def read(self) -> DataFrame:
        """All rows, without the bucket."""
        return self.spark.read.parquet(self._rows).drop("_bucket")

    def _placed(self, df: DataFrame) -> DataFrame:
        """``df`` with its keys' bucket, and the row and bit of the filter."""
        key = [F.col(f"`{k}`") for k in self.keys]
        place = F.pmod(F.xxhash64(F.lit("place"), *key), F.lit(self.bits))
        return df.withColumns({"_bucket": F.pmod(F.xxhash64(*key), F.lit(self.buckets)).cast("int"),
                               "_row": F.floor(place / ROW_BITS).cast("int"), "_bit": (place % ROW_BITS).cast("int")})

    def keys_of(self, buckets: list[int]) -> DataFrame:
        """The keys of some buckets: only their folders are read."""
        return self.spark.read.parquet(self._rows).where(F.col("_bucket").isin(buckets)).select("_bucket", *self.keys)

    def _known_buckets(self, batch: DataFrame, hit: list[int]) -> list[int]:
        """The buckets where the bit of a key of ``batch`` is set: at most ``buckets``."""
        filters = self.spark.read.parquet(self._filters).where(F.col("_bucket").isin(hit))
        held = filters.groupBy("_bucket", "_row").agg(F.bitmap_or_agg("held").alias("held"))
        asked = batch.select("_bucket", "_row", "_bit").join(held, ["_bucket", "_row"])
        return [r[0] for r in asked.where(_is_set(F.col("held"), F.col("_bit"))).select("_bucket").distinct().collect()]

    def append(self, incoming: DataFrame, arrival: list[By]) -> Appended:
        """Add the rows whose key is not there yet; of rows with one key the first
        by ``arrival`` stays. Columns of ``arrival`` that start with an underscore
        are not stored."""
        spark, scratch = self.spark, work_dir(self.spark, "keyed-append")
        stored = [c for c in incoming.columns if not c.startswith("_")]
        first = first_per_key(incoming, self.keys, arrival, counted="_n").select(*stored, "_n")
        placed = self._placed(first)
        placed.write.parquet(f"{scratch}/batch")
        batch = spark.read.schema(placed.schema).parquet(f"{scratch}/batch")
        came = batch.groupBy("_bucket").agg(F.sum("_n").alias("n"), F.count(F.lit(1)).alias("keys")).collect()  # at most ``buckets``
        hit, fresh, read = [r["_bucket"] for r in came], batch.drop("_n"), []
        done = sum(r["keys"] for r in came)
        if hit and path_exists(spark, self._filters) and path_exists(spark, self._rows):
            read = self._known_buckets(batch, hit)
            if read:
                self._same(fresh, self.keys_of(read), "left_anti").write.parquet(f"{scratch}/fresh")
                fresh = spark.read.schema(fresh.schema).parquet(f"{scratch}/fresh")
                done = fresh.count()
        # Each bit once, and its row in one task: no bitmap is shuffled.
        bits = fresh.select("_bucket", "_row", "_bit").repartition("_bucket", "_row").groupBy("_bucket", "_row").agg(F.bitmap_construct_agg("_bit").alias("held"))
        bits.repartition("_bucket").write.mode("append").partitionBy("_bucket").parquet(self._filters)
        rows = fresh.drop("_row", "_bit").repartition("_bucket")  # one file a bucket
        rows.write.mode("append").partitionBy("_bucket").parquet(self._rows)
        result = Appended(done, sum(r["n"] for r in came) - done, len(hit), len(read))
        remove_path(spark, scratch)
        return result

    def _same(self, left: DataFrame, right: DataFrame, how: str) -> DataFrame:
        """``left`` rows with (or without) a row of the same bucket and key."""
        other = right.select(F.col("_bucket").alias("_b"), *[F.col(f"`{k}`").alias(f"_k{i}") for i, k in enumerate(self.keys)])
        on = F.col("_bucket") == F.col("_b")
        for i, k in enumerate(self.keys):
            on = on & F.col(f"`{k}`").eqNullSafe(F.col(f"_k{i}"))
        return left.join(other, on, how)


def _is_set(held: Column, bit: Column) -> Column:
    """Whether a bit is set in a row of a bitmap (bit 0 is the lowest of byte 0)."""
    byte = F.conv(F.hex(F.substring(held, F.floor(bit / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    return F.getbit(byte, bit % 8) == 1
