"""The star load as one publication.

Every load is a run with a folder of its own, where each table is written and
then marked as done. Only when all tables are done does a manifest, a small
file that names the folder, appear in ``manifests`` under the next number, by a
rename. Readers take the highest manifest, so they see all tables of one run or
all of an earlier one, never half a load, and may pin a version. A run that
failed is gone on with by its name: tables that are done are not loaded again.

    out/runs/<run>/<table>/          rows
    out/runs/<run>/_rejects/<table>/ rejected rows with their reasons
    out/runs/<run>/_done/<table>     counts, written after the rows
    out/manifests/0000000001.json    published runs, in order
"""

from __future__ import annotations

import json
import os
import re
import time
import uuid
from collections.abc import Mapping
from concurrent.futures import ThreadPoolExecutor
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from feria.plans.warehouse import SOURCE, load_table
from feria.schemas import LOAD_ORDER
from feria.sources.sinks import list_names, path_exists, read_text, remove_path, rename_path, write_text

MANIFEST = re.compile(r"\d{10}\.json")
STATUS = ("table string, rows long, rejected long, skipped_duplicates long, seconds double, "
          "error string, reused boolean, version long")


class NotPublishedError(FileNotFoundError):
    pass


def new_run() -> str:
    """A name for a run; names sort by time."""
    return time.strftime("%Y%m%dT%H%M%S", time.gmtime()) + "-" + uuid.uuid4().hex[:8]


def _manifests(spark: SparkSession, out_dir: str) -> list[str]:
    return sorted(n for n in list_names(spark, os.path.join(out_dir, "manifests")) if MANIFEST.fullmatch(n))


def _manifest(spark: SparkSession, out_dir: str, name: str) -> dict:
    return json.loads(read_text(spark, os.path.join(out_dir, "manifests", name)))


def versions(spark: SparkSession, out_dir: str) -> list[dict]:
    """The manifests that were published, oldest first."""
    return [_manifest(spark, out_dir, n) for n in _manifests(spark, out_dir)]


def published(spark: SparkSession, out_dir: str, version: int | None = None) -> dict:
    """The manifest of ``version``, the last one without it."""
    names = _manifests(spark, out_dir)
    wanted = names[-1:] if version is None else [n for n in names if int(n[:10]) == version]
    if not wanted:
        raise NotPublishedError(f"{out_dir} has no version {version or ''}".rstrip())
    return _manifest(spark, out_dir, wanted[0])


def read_published(spark: SparkSession, out_dir: str, version: int | None = None) -> dict[str, DataFrame]:
    """The tables of one version, all of the same run."""
    run = os.path.join(out_dir, "runs", published(spark, out_dir, version)["run"])
    return {t: spark.read.parquet(os.path.join(run, t)) for t in LOAD_ORDER}


def unpublished_runs(spark: SparkSession, out_dir: str) -> list[str]:
    """Runs without a manifest, oldest first: failed, or still loading."""
    known = {m["run"] for m in versions(spark, out_dir)}
    return sorted(n for n in list_names(spark, os.path.join(out_dir, "runs")) if n not in known)


def _publish(spark: SparkSession, out_dir: str, run: str, tables: dict[str, dict]) -> int:
    """Write the manifest of ``run`` under the next free number."""
    folder = os.path.join(out_dir, "manifests")
    names = _manifests(spark, out_dir)
    version = int(names[-1][:10]) + 1 if names else 1
    while True:  # another publication may take a number first
        draft = os.path.join(folder, f"_{uuid.uuid4().hex}")
        write_text(spark, draft, json.dumps({"version": version, "run": run, "tables": tables}))
        if rename_path(spark, draft, os.path.join(folder, f"{version:010d}.json")):
            return version
        remove_path(spark, draft)
        version += 1


def publish_star(spark: SparkSession, clean: Mapping[str, DataFrame], out_dir: str, run: str | None = None,
                 partition_orders_by_year: bool = False, stage: bool = True, parallel: int = 4) -> DataFrame:
    """Load the star schema as ``run`` (a new one without it) and publish it if
    every table is loaded; the status has one row per table, with ``version``
    NULL where the run was not published.

    Up to ``parallel`` tables are loaded at once. A table that fails is recorded,
    the others load, and what was published before stays what readers see. Call
    again with the run's name to load what failed; ``reused`` marks the tables
    that were done. ``clean`` has to be the same input then. A run that is
    published already is reported and left as it is.
    """
    run = run or new_run()
    folder = os.path.join(out_dir, "runs", run)

    def one(table: str) -> tuple:
        began, mark = time.perf_counter(), os.path.join(folder, "_done", table)
        try:
            reused = path_exists(spark, mark)
            if not reused:
                part = ["order_year"] if table == "fact_orders" and partition_orders_by_year else None
                rows, rejected, skipped = load_table(spark, table, clean[SOURCE[table]], folder, part, stage)
                write_text(spark, mark, json.dumps({"rows": rows, "rejected": rejected, "skipped_duplicates": skipped}))
            done = json.loads(read_text(spark, mark))
            return (table, done["rows"], done["rejected"], done["skipped_duplicates"], round(time.perf_counter() - began, 3), None, reused)
        except Exception as e:  # noqa: BLE001 - recorded per table, the load goes on
            return (table, None, None, None, round(time.perf_counter() - began, 3), f"{type(e).__name__}: {e}"[:500], False)

    with ThreadPoolExecutor(max_workers=max(1, parallel)) as pool:
        status = list(pool.map(one, LOAD_ORDER))
    version = next((m["version"] for m in versions(spark, out_dir) if m["run"] == run), None)
    if version is None and all(error is None for *_, error, _ in status):
        if stage:
            remove_path(spark, os.path.join(folder, "_staging"))
        counts = {t: {"rows": n, "rejected": bad, "skipped_duplicates": dup} for t, n, bad, dup, *_ in status}
        version = _publish(spark, out_dir, run, counts)
    return spark.createDataFrame([(*row, version) for row in status], STATUS)


def prune(spark: SparkSession, out_dir: str, keep: int) -> list[int]:
    """Remove all but the last ``keep`` versions, manifests first, so that no
    reader is sent to a folder that goes; returns the versions removed. Readers
    of a removed version fail; runs without a manifest stay."""
    if keep < 1:
        raise ValueError("the last version stays")
    gone = versions(spark, out_dir)[:-keep]
    for m in gone:
        remove_path(spark, os.path.join(out_dir, "manifests", f"{m['version']:010d}.json"))
    for m in gone:
        remove_path(spark, os.path.join(out_dir, "runs", m["run"]))
    return [m["version"] for m in gone]


def verify_published(spark: SparkSession, out_dir: str, expected: DataFrame, version: int | None = None) -> DataFrame:
    """table, expected, loaded, missing: the rows that are read from a version
    against ``expected`` (table, rows), a table of the counts that are due.
    A table that only one side has is NULL on the other."""
    star = read_published(spark, out_dir, version)
    loaded = reduce(DataFrame.unionByName, [df.agg(F.lit(t).alias("table"), F.count(F.lit(1)).alias("loaded")) for t, df in star.items()])
    due = expected.groupBy("table").agg(F.sum("rows").alias("expected"))
    return due.join(loaded, "table", "full").select("table", "expected", "loaded", (F.col("expected") - F.col("loaded")).alias("missing"))
