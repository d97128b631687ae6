"""The dashboard statements as parametrised SQL, for no choice and for one."""

from __future__ import annotations

from feria.plans import dashboard_sql
from feria.registry import ALL, ORACLE, QUERIES, SAMPLE_FILTER, normalize_output, star


def _run(name, flt):
    def run(spark, sf_dir):
        return normalize_output(dashboard_sql.run_statement(spark, star(spark, sf_dir), name, flt))
    return run


for _name in dashboard_sql.STATEMENTS:
    for _suffix, _flt in (("", ALL), ("_filtered", SAMPLE_FILTER)):
        QUERIES[f"{_name}{_suffix}_sql"] = _run(_name, _flt)
        ORACLE[f"{_name}{_suffix}_sql"] = ORACLE[f"{_name}{_suffix}"]
