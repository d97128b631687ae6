"""Benchmark: load the star schema once, then time the headline queries.

Env: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8),
BENCH_RUNS (warm runs per query, default 3). Prints one JSON line.

Stages timed (median of warm runs, seconds):
* ``clean_tables`` driver tables -> bindings -> cleaned tables, written
                 as Parquet (a full refresh, so every run redoes all of it);
* ``load_star``  cleaned tables -> checked, key-deduplicated star schema
                 written as Parquet;
* ``master``     the denormalised order mart from the cleaned tables;
* every headline query over the written star schema (what the dashboard
  and the SQL report run), each executed in full into a no-op sink.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import tempfile
import uuid
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    runs = int(os.environ.get("BENCH_RUNS", "3"))

    import pyspark
    from feria.session import get_spark
    from feria.plans import analytics as A
    from feria.plans import dashboard as D
    from feria.plans.clean import clean_all
    from feria.plans.marts import master
    from feria.plans.warehouse import load_star, read_star, write_clean
    from feria.sources.bindings import raw_tables

    spark = get_spark(f"local[{cpus}]", app="feria-bench", shuffle_partitions=cpus,
                      conf={"spark.driver.memory": "16g",
                            "spark.sql.files.maxPartitionBytes": str(64 << 20)})
    spark.sparkContext.setLogLevel("ERROR")
    # scratch tables live under the shared checkpoint folder named by the
    # session; this local benchmark makes its own where none is set
    base = spark.conf.get("spark.checkpoint.dir", None) or tempfile.mkdtemp(prefix="feria-bench-")
    scratch = os.path.join(base, f"bench-{uuid.uuid4().hex[:8]}")

    def run(df) -> None:
        df.write.format("noop").mode("overwrite").save()

    timings: dict[str, float] = {}

    raw = raw_tables(spark, sf_dir)
    clean_dir, star_dir = os.path.join(scratch, "clean"), os.path.join(scratch, "star")
    etl = {"clean_tables": [], "load_star": []}
    clean = None
    for i in range(runs + 1):  # first run warms the JVM and Python workers
        t0 = time.perf_counter()
        clean = write_clean(spark, clean_all(raw), clean_dir)
        t1 = time.perf_counter()
        status = load_star(spark, clean, star_dir, stage=False, partition_orders_by_year=True)
        failed = [r for r in status.collect() if r["error"]]
        t2 = time.perf_counter()
        if failed:
            raise SystemExit(f"star load failed: {failed}")
        if i:
            etl["clean_tables"].append(t1 - t0)
            etl["load_star"].append(t2 - t1)
    timings.update({k: statistics.median(v) for k, v in etl.items()})
    star = read_star(spark, os.path.join(scratch, "star"))

    flt = D.Filters(years=(1996, 1999), statuses=("delivered", "shipped"))
    queries = {
        "q1_monthly_volume": lambda: A.q1_monthly_volume(star),
        "q2_top_categories": lambda: A.q2_top_categories(star),
        "q3_delivery_by_state": lambda: A.q3_delivery_by_state(star),
        "q4_incident_rates": lambda: A.q4_incident_rates(star),
        "q5_seller_quality": lambda: A.q5_seller_quality(star),
        "kpi_row": lambda: D.kpi_row(star),
        "kpi_row_by_order": lambda: D.kpi_row_by_order(star),
        "dash_q1_monthly": lambda: D.monthly(star),
        "dash_q2_categories_filtered": lambda: D.top_categories(star, flt),
        "dash_q3_delivery": lambda: D.delivery_by_state(star),
        "dash_q4_incidents": lambda: D.incident_split(star),
        "score_distribution": lambda: D.score_distribution(star),
        "dash_q5_sellers": lambda: D.seller_scatter(star),
        "dash_q5_sellers_by_order": lambda: D.seller_scatter_by_order(star),
        "master": lambda: master(clean),
    }
    for name, build in queries.items():
        run(build())  # warm-up
        ts = []
        for _ in range(runs):
            t = time.perf_counter()
            run(build())
            ts.append(time.perf_counter() - t)
        timings[name] = statistics.median(ts)

    total = sum(timings.values())
    print(json.dumps({
        "metric": "total_seconds_load_plus_headline_queries",
        "value": round(total, 3),
        "unit": "sec",
        "queries": {k: round(v, 3) for k, v in timings.items()},
        "sf": os.path.basename(sf_dir.rstrip("/")).replace("sf", ""),
        "cpus": cpus,
        "runs": runs,
        "spark": pyspark.__version__,
    }))
    spark.stop()


if __name__ == "__main__":
    main()
