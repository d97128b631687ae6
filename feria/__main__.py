"""Command line: list or run registered queries.

    python -m feria list
    python -m feria run q5_seller_quality --sf-dir /data/sf100 [--show 20 | --out PATH]
    python -m feria sql q5_seller_quality        # the DuckDB oracle statement
"""

from __future__ import annotations

import argparse


def main(argv: list[str] | None = None) -> None:
    ap = argparse.ArgumentParser(prog="python -m feria", description=__doc__,
                                 formatter_class=argparse.RawDescriptionHelpFormatter)
    sub = ap.add_subparsers(dest="cmd", required=True)
    sub.add_parser("list")
    r = sub.add_parser("run")
    r.add_argument("name")
    r.add_argument("--sf-dir", required=True)
    r.add_argument("--show", type=int, default=20)
    r.add_argument("--out", help="write the result as Parquet instead of showing it")
    q = sub.add_parser("sql")
    q.add_argument("name")
    a = ap.parse_args(argv)

    from feria.registry import ORACLE, QUERIES
    if a.cmd == "list":
        for name in QUERIES:
            print(name)
    elif a.cmd == "sql":
        print(ORACLE.get(a.name, f"-- no SQL statement for {a.name}"))
    else:
        from feria.session import get_spark
        spark = get_spark()
        df = QUERIES[a.name](spark, a.sf_dir)
        if a.out:
            df.write.mode("overwrite").parquet(a.out)
        else:
            df.show(a.show, truncate=False)


if __name__ == "__main__":
    main()
