"""Physical-plan summary of the headline queries over the written star.

Usage: python tools/plans.py [sf_dir] [--cluster]

``--cluster`` turns off size-based broadcasting so the plan shows what a
large deployment gets when no side is small: the shuffles (Exchange), join
strategies, aggregate kinds and the filters pushed into each scan.
"""

from __future__ import annotations

import os
import re
import sys
import tempfile
import uuid

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def summarize(name: str, df) -> str:
    plan = df._jdf.queryExecution().executedPlan().toString()
    ops = re.findall(r"(Exchange \w+|BroadcastExchange|SortMergeJoin \w*|BroadcastHashJoin \w*"
                     r"|ShuffledHashJoin \w*|BroadcastNestedLoopJoin \w*|CartesianProduct"
                     r"|HashAggregate|SortAggregate|ObjectHashAggregate|TakeOrderedAndProject"
                     r"|Window|Expand|ArrowEvalPython)", plan)
    counts: dict[str, int] = {}
    for o in ops:
        k = o.strip()
        counts[k] = counts.get(k, 0) + 1
    pushed = sorted(set(p.split(", ReadSchema")[0].rstrip("]").rstrip(".")
                        for p in re.findall(r"PushedFilters: \[([^\n]*)", plan)))
    lines = [f"### {name}", "", "| operator | count |", "|---|---|"]
    lines += [f"| {k} | {v} |" for k, v in sorted(counts.items())]
    if pushed:
        lines += ["", "Pushed filters: " + "; ".join(f"`{p}`" for p in pushed if p)]
    return "\n".join(lines) + "\n"


def main() -> None:
    args = [a for a in sys.argv[1:] if not a.startswith("--")]
    sf_dir = args[0] if args else "/root/testdata/sf0.1"
    cluster = "--cluster" in sys.argv
    from feria.plans import analytics as A
    from feria.plans import dashboard as D
    from feria.plans.clean import clean_all
    from feria.plans.marts import master
    from feria.plans.warehouse import load_star, read_star, write_clean
    from feria.session import get_spark
    from feria.sources.bindings import raw_tables
    spark = get_spark("local[8]", shuffle_partitions=8)
    spark.sparkContext.setLogLevel("ERROR")
    base = spark.conf.get("spark.checkpoint.dir", None) or tempfile.mkdtemp(prefix="feria-plans-")
    base = os.path.join(base, f"plans-{uuid.uuid4().hex[:8]}")
    clean = write_clean(spark, clean_all(raw_tables(spark, sf_dir)), os.path.join(base, "clean"))
    load_star(spark, clean, os.path.join(base, "star"), stage=False,
              partition_orders_by_year=True)
    star = read_star(spark, os.path.join(base, "star"))
    if cluster:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", "-1")
    flt = D.Filters(years=(1996, 1999), statuses=("delivered", "shipped"))
    queries = {
        "q1_monthly_volume": A.q1_monthly_volume(star),
        "q2_top_categories": A.q2_top_categories(star),
        "q3_delivery_by_state": A.q3_delivery_by_state(star),
        "q4_incident_rates": A.q4_incident_rates(star),
        "q5_seller_quality": A.q5_seller_quality(star),
        "kpi_row": D.kpi_row(star),
        "dash_q2_categories_filtered": D.top_categories(star, flt),
        "dash_q5_sellers_by_order": D.seller_scatter_by_order(star),
        "master": master(clean),
    }
    mode = "cluster-like (no size-based broadcast)" if cluster else "local defaults"
    print(f"# Physical plans, {mode}, {os.path.basename(sf_dir)}\n")
    for name, df in queries.items():
        print(summarize(name, df))


if __name__ == "__main__":
    main()
