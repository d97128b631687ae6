"""The star schema with its facts co-located by order.

The four facts are bucketed and sorted by ``order_id`` into equally many
buckets, one file each, so that joins and per-order sums on the order need no
exchange: Q4, Q5, the KPI row, the monthly table and the seller table read
bucket by bucket. The order fact also carries its customer's buyer id and state,
joined once when it is written, so that the dashboard filters by state without
moving the orders to their customers.

The tables are external: any session opens them from their folder.
"""

from __future__ import annotations

import json
import os
import zlib
from collections.abc import Mapping
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from feria.schemas import LOAD_ORDER
from feria.sources.sinks import read_text, write_text

KEY = "order_id"
FACTS = [t for t in LOAD_ORDER if t.startswith("fact_")]


def _name(path: str, table: str) -> str:
    """A table's name in the catalog, by the folder alone."""
    return f"feria_{zlib.crc32(path.rstrip('/').encode()):08x}_{table}"


def orders_with_customer(star: Mapping[str, DataFrame]) -> DataFrame:
    """The order fact and, of its customer, ``_buyer``, ``_state`` and whether
    there is one (``_customer``); all orders stay."""
    c = star["dim_customers"].select(F.col("customer_id"), F.col("customer_unique_id").alias("_buyer"),
                                     F.col("state").alias("_state"), F.lit(True).alias("_known"))
    joined = star["fact_orders"].join(c, "customer_id", "left")
    return joined.select(*star["fact_orders"].columns, "_buyer", "_state", F.coalesce("_known", F.lit(False)).alias("_customer"))


def write_colocated(spark: SparkSession, star: Mapping[str, DataFrame], path: str, buckets: int = 64,
                    parallel: int = 4) -> dict[str, DataFrame]:
    """Write the star under ``path``, up to ``parallel`` tables at a time, and open
    it. ``buckets`` sets the tasks of the joins: for 100 TB take some thousands, so
    that a bucket fits in memory."""
    tables = {t: orders_with_customer(star) if t == "fact_orders" else star[t] for t in LOAD_ORDER}

    def one(t: str) -> None:
        if t in FACTS:
            # Dealt as the buckets are: each task writes one file.
            writer = tables[t].repartition(buckets, KEY).write.bucketBy(buckets, KEY).sortBy(KEY)
            name = _name(path, t)
            spark.sql(f"DROP TABLE IF EXISTS {name}")
            writer.mode("overwrite").option("path", os.path.join(path, t)).saveAsTable(name)
        else:
            tables[t].write.mode("overwrite").parquet(os.path.join(path, t))

    # A table's last step has few tasks: another's fill the cores meanwhile.
    with ThreadPoolExecutor(max_workers=max(1, parallel)) as pool:
        list(pool.map(one, FACTS + [t for t in LOAD_ORDER if t not in FACTS]))
    about = {t: spark.table(_name(path, t)).schema.json() for t in FACTS}
    write_text(spark, os.path.join(path, "_colocated.json"), json.dumps({"buckets": buckets, "schemas": about}))
    return open_colocated(spark, path)


def open_colocated(spark: SparkSession, path: str) -> dict[str, DataFrame]:
    """The tables of a folder that :func:`write_colocated` wrote; facts that the
    session's catalog does not know are declared with their buckets."""
    about = json.loads(read_text(spark, os.path.join(path, "_colocated.json")))
    out = {}
    for t in LOAD_ORDER:
        if t in FACTS:
            name = _name(path, t)
            columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in StructType.fromJson(json.loads(about["schemas"][t])))
            spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({columns}) USING parquet CLUSTERED BY ({KEY}) SORTED BY ({KEY}) "
                      f"INTO {int(about['buckets'])} BUCKETS LOCATION '{os.path.join(path, t)}'")
            out[t] = spark.table(name)
        else:
            out[t] = spark.read.parquet(os.path.join(path, t))
    return out


def close_colocated(spark: SparkSession, path: str) -> None:
    """Take the tables out of the session's catalog; the files stay."""
    for t in FACTS:
        spark.sql(f"DROP TABLE IF EXISTS {_name(path, t)}")
