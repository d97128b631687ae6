"""Incremental insert-ignore load of arriving files.

Each micro-batch keeps the first arrival per key and appends only keys the
target does not hold yet. Re-running a batch after a failure appends
nothing twice (keys already written are skipped), so the sink is
effectively exactly-once without a transaction log.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from feria.operators.dedup import By
from feria.session import checkpoint_dir
from feria.sources.keyed_table import KeyedTable
from feria.sources.sinks import append_insert_ignore


def start_keyed_load(spark: SparkSession, source_dir: str, schema: StructType,
                     target_path: str, keys: list[str], arrival: list[By],
                     fmt: str = "parquet", checkpoint: str | None = None,
                     available_now: bool = True,
                     transform=None, buckets: int | None = None) -> StreamingQuery:
    """Stream ``source_dir`` into the Parquet table at ``target_path``, or, with
    ``buckets``, into a :class:`KeyedTable` there, of which a batch reads only
    the buckets it hits.

    ``transform`` (DataFrame -> DataFrame) runs on each micro-batch before
    the keyed append, e.g. a cleaning function. ``available_now`` processes
    what is there and stops (a scheduled refresh); otherwise the query keeps
    running.
    """
    reader = spark.readStream.schema(schema).format(fmt)
    if fmt == "csv":
        reader = reader.option("header", True).option("escape", '"').option("multiLine", True)
    stream = reader.load(source_dir)
    ckpt = checkpoint or os.path.join(checkpoint_dir(spark), "streams",
                                      os.path.basename(target_path.rstrip("/")))

    def each_batch(batch: DataFrame, epoch_id: int) -> None:
        df = transform(batch) if transform else batch
        if buckets:
            KeyedTable(spark, target_path, keys, buckets).append(df, arrival)
        else:
            append_insert_ignore(spark, df, target_path, keys, arrival)

    w = stream.writeStream.foreachBatch(each_batch).option("checkpointLocation", ckpt)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="1 minute")
    return w.start()
