"""Spark session defaults and the shared checkpoint folder."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def get_spark(master: str | None = None, app: str = "feria",
              shuffle_partitions: int | None = None,
              conf: dict[str, str] | None = None) -> SparkSession:
    """Build (or reuse) a session with the defaults above.

    On a cluster pass ``master=None`` and let spark-submit decide; the
    cluster's own settings win over ours because we only fill gaps.
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    merged = dict(DEFAULT_CONF)
    if shuffle_partitions:
        merged["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    merged.update(conf or {})
    for k, v in merged.items():
        builder = builder.config(k, v)
    return builder.getOrCreate()


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder named in ``spark.checkpoint.dir``.

    Nothing is set or replaced here: a folder that the caller registered with
    ``setCheckpointDir`` stays. Without the setting it raises, as a folder on
    one machine would not be seen by the others.
    """
    d = spark.conf.get("spark.checkpoint.dir", None)
    if not d:
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    return d


def work_dir(spark: SparkSession, name: str) -> str:
    """A new folder's path in the shared folder, for a query that writes tables
    and reads them back. Only a local session may leave the setting out."""
    if not spark.conf.get("spark.checkpoint.dir", None) and spark.sparkContext.master.startswith("local"):
        root = os.path.join(tempfile.gettempdir(), "feria-shared")
    else:
        root = checkpoint_dir(spark)
    return f"{root.rstrip('/')}/{name}-{uuid.uuid4().hex}"
