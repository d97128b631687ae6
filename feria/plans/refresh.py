"""The full refresh job: raw files -> cleaned tables -> star schema.

Run as ``python -m feria.plans.refresh --raw-dir DIR --out DIR`` for the
raw CSV files, or ``--driver-dir DIR`` for the Parquet test tables. Every
stage writes Parquet under ``--out`` and the next stage reads it back, so
no stage recomputes another and a lost executor only replays one stage.
"""

from __future__ import annotations

import argparse
import os

from pyspark.sql import DataFrame, SparkSession

from feria.plans.clean import clean_all, clean_products
from feria.plans.marts import master, payments_summary
from feria.plans.publish import publish_star, unpublished_runs
from feria.plans.warehouse import SOURCE, load_star, write_clean
from feria.sources.bindings import raw_tables
from feria.sources.readers import read_raw_dir, read_raw_rejects
from feria.sources.sinks import export_csv, path_exists


CLEAN_TABLES = sorted(set(SOURCE.values()))


def ensure_products(spark: SparkSession, raw: dict[str, DataFrame], clean_dir: str) -> None:
    """If the cleaned products table is missing, build it from the raw
    products and translation (same rules as the cleaning job)."""
    path = os.path.join(clean_dir, "products")
    if not path_exists(spark, path):
        clean_products(raw["products"], raw["category_translation"]) \
            .write.mode("overwrite").parquet(path)


def refresh(spark: SparkSession, raw: dict[str, DataFrame], out_dir: str,
            csv_dir: str | None = None, run: str | None = None) -> DataFrame:
    """Clean, write the clean layer (+ payment summary and master), load the
    star schema and publish it (``publish.read_published`` reads it); returns
    the load status. ``run`` names an unpublished run to go on with: its clean
    layer is kept and only the tables that failed are loaded. With ``csv_dir``
    the ten cleaned tables are also exported as CSV files for hand-off (Parquet
    stays the format the next stage reads)."""
    star_dir = os.path.join(out_dir, "star")
    if run:
        cleaned = {t: spark.read.parquet(os.path.join(out_dir, "clean", t)) for t in CLEAN_TABLES}
        return publish_star(spark, cleaned, star_dir, run, stage=False, partition_orders_by_year=True)
    clean_dir = os.path.join(out_dir, "clean")
    cleaned = write_clean(spark, clean_all(raw), clean_dir)
    extra = {"payments_summary": payments_summary(cleaned["payments"]),
             "master": master(cleaned)}
    written = write_clean(spark, extra, clean_dir)
    if csv_dir:
        for name, df in {**cleaned, **written}.items():
            export_csv(df, os.path.join(csv_dir, name))
    return publish_star(spark, cleaned, star_dir, stage=False, partition_orders_by_year=True)


def load_from_clean_dir(spark: SparkSession, raw: dict[str, DataFrame], clean_dir: str,
                        out_dir: str) -> DataFrame:
    """Load the star schema from an existing clean layer; the products table
    is rebuilt from the raw files first when it is missing."""
    ensure_products(spark, raw, clean_dir)
    cleaned = {name: spark.read.parquet(os.path.join(clean_dir, name))
               for name in CLEAN_TABLES}
    return load_star(spark, cleaned, out_dir, stage=False)


def main(argv: list[str] | None = None) -> None:
    from feria.session import get_spark
    ap = argparse.ArgumentParser(description=__doc__)
    src = ap.add_mutually_exclusive_group(required=True)
    src.add_argument("--raw-dir", help="folder with the raw CSV files")
    src.add_argument("--driver-dir", help="folder with the Parquet test tables")
    ap.add_argument("--out", required=True)
    ap.add_argument("--resume", action="store_true",
                    help="go on with the last run that was not published")
    ap.add_argument("--csv", help="also export the cleaned tables as CSV here")
    a = ap.parse_args(argv)
    spark = get_spark()
    raw = read_raw_dir(spark, a.raw_dir) if a.raw_dir else raw_tables(spark, a.driver_dir)
    open_runs = unpublished_runs(spark, os.path.join(a.out, "star")) if a.resume else []
    if a.raw_dir and not open_runs:
        read_raw_rejects(spark, a.raw_dir).write.mode("overwrite").parquet(
            os.path.join(a.out, "raw_rejects"))
    status = refresh(spark, raw, a.out, a.csv, open_runs[-1] if open_runs else None)
    status.show(truncate=False)
    failed = [r.table for r in status.where("error IS NOT NULL").collect()]  # eight rows at most
    if failed:
        raise SystemExit(f"not loaded: {', '.join(failed)}")


if __name__ == "__main__":
    main()
