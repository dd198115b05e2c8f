"""Command line: the reference's scripts as subcommands.

    python -m lodestar load   --landing DIR --warehouse ROOT [--format csv]
                              [--domains hr,finance,operations] [--as-of DATE]
                              [--missing null|literal] [--audit-scd]
    python -m lodestar kpi    --warehouse ROOT {hr,finance,finance-by-type,operations}
    python -m lodestar view   --warehouse ROOT --role {HR,Finance,Operations,Super}
    python -m lodestar scd2-report --warehouse ROOT
    python -m lodestar audit  --warehouse ROOT
    python -m lodestar check  --warehouse ROOT

``load`` reads ``DIR/hr``, ``DIR/finance`` and ``DIR/operations`` extracts and
commits one warehouse version (HR first, then the rest; SCD2 when HR is
loaded). The other commands print their result; ``--limit`` bounds only what
is printed.
"""

from __future__ import annotations

import argparse
import datetime as dt

from lodestar.operators import checks, kpi, views
from lodestar.operators.audit import audit_listing
from lodestar.operators.scd2 import change_report
from lodestar.plans.loads import run_domains, warehouse_tables
from lodestar.session import get_session
from lodestar.sources.extracts import read_extract
from lodestar.sources.store import Warehouse


def _show(df, limit: int) -> None:
    df.show(limit, truncate=False)


def main(argv=None) -> int:
    p = argparse.ArgumentParser(prog="lodestar")
    p.add_argument("--master", default=None, help="Spark master (omit on a cluster)")
    p.add_argument("--limit", type=int, default=50, help="rows to print")
    sub = p.add_subparsers(dest="cmd", required=True)
    ld = sub.add_parser("load")
    ld.add_argument("--landing", required=True)
    ld.add_argument("--warehouse", required=True)
    ld.add_argument("--format", default="csv", choices=["csv", "json", "parquet"])
    ld.add_argument("--domains", default="hr,finance,operations")
    ld.add_argument("--as-of", default=None)
    ld.add_argument("--missing", default="null", choices=["null", "literal"])
    ld.add_argument("--audit-scd", action="store_true")
    k = sub.add_parser("kpi")
    k.add_argument("--warehouse", required=True)
    k.add_argument("which", choices=["hr", "finance", "finance-by-type", "operations"])
    k.add_argument("--latest-assignment", action="store_true")
    v = sub.add_parser("view")
    v.add_argument("--warehouse", required=True)
    v.add_argument("--role", required=True)
    for name in ("scd2-report", "audit", "check"):
        sub.add_parser(name).add_argument("--warehouse", required=True)
    a = p.parse_args(argv)

    spark = get_session(a.master)
    spark.sparkContext.setLogLevel("ERROR")
    wh = Warehouse(spark, a.warehouse)
    if a.cmd == "load":
        domains = tuple(d.strip() for d in a.domains.split(",") if d.strip())
        raw = {d: read_extract(spark, f"{a.landing.rstrip('/')}/{d}", d, a.format)
               for d in domains}
        as_of = dt.date.fromisoformat(a.as_of) if a.as_of else dt.date.today()
        events = run_domains(wh, raw, domains, missing=a.missing, as_of=as_of,
                             scd2="hr" in domains, audit_scd=a.audit_scd)
        for table, op, n in events:
            print(f"{op:20s} {table:20s} {n}")
        print(f"committed warehouse version {wh.version}")
        return 0
    t = warehouse_tables(wh)
    if a.cmd == "kpi":
        if a.which == "hr":
            _show(kpi.headcount(t["fact_hr"]), a.limit)
            _show(kpi.attrition(t["fact_hr"]), a.limit)
            _show(kpi.for_display(kpi.salary_by_gender(t["fact_hr"], t["dim_employee"]),
                                  "gender"), a.limit)
        elif a.which == "finance":
            _show(kpi.for_display(kpi.expense_by_month_department_type(
                t["fact_finance"], t["fact_hr"], t["dim_expensetype"], t["dim_department"],
                latest_assignment=a.latest_assignment)), a.limit)
        elif a.which == "finance-by-type":
            _show(kpi.for_display(kpi.expense_by_month_type(t["fact_finance"],
                                                            t["dim_expensetype"])), a.limit)
        else:
            _show(kpi.for_display(kpi.downtime_by_process_department(
                t["fact_operations"], t["dim_process"], t["dim_department"])), a.limit)
    elif a.cmd == "view":
        _show(views.role_view(t, a.role), a.limit)
    elif a.cmd == "scd2-report":
        _show(change_report(t["dim_employee_scd2"]), a.limit)
    elif a.cmd == "audit":
        _show(audit_listing(t["audit_log"]), a.limit)
    elif a.cmd == "check":
        _show(checks.duplicate_keys(t), a.limit)
        _show(checks.orphans(t), a.limit)
    return 0


if __name__ == "__main__":
    raise SystemExit(main())
