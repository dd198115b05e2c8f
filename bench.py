"""Benchmark the headline jobs at $BENCH_SF_DIR on local[$BENCH_CPUS].

Prints one JSON line: {"metric", "value", "unit", "queries", "sf", ...}.
Each job runs once to warm up, then ``BENCH_RUNS`` times (default 3); the
median is reported. Queries are forced with the ``noop`` sink so the full
plan runs without collecting rows to the driver.
"""

from __future__ import annotations

import datetime as dt
import json
import os
import re
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from lodestar.operators import checks, kpi, views  # noqa: E402
from lodestar.operators.cleaning import clean_domain  # noqa: E402
from lodestar.operators.scd2 import (apply_scd2_full, change_report, scd2_input,  # noqa: E402
                                     scd2_rows)
from lodestar.plans import scenarios as sc  # noqa: E402
from lodestar.plans.loads import run_all, run_domains, warehouse_tables  # noqa: E402
from lodestar.session import get_session, scratch_path  # noqa: E402
from lodestar.sources.store import Warehouse  # noqa: E402


def noop(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def timed(fn, runs: int) -> float:
    fn()  # warm-up
    times = []
    for _ in range(runs):
        t0 = time.perf_counter()
        fn()
        times.append(time.perf_counter() - t0)
    return round(statistics.median(times), 3)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    m = re.search(r"sf([0-9.]+)", sf_dir)
    sf = m.group(1) if m else sf_dir
    spark = get_session(f"local[{cpus}]", app_name="lodestar-bench",
                        shuffle_partitions=max(int(cpus), 1),
                        extra={"spark.driver.memory": "16g"})
    spark.sparkContext.setLogLevel("ERROR")

    # extracts land once as Parquet files (not timed), as they would arrive
    raw = sc.landed_extracts(spark, sf_dir)
    base = sc.base_warehouse(spark, sf_dir)
    t = warehouse_tables(base)
    day2 = sc.scd2_day2_input(scd2_input(t["dim_employee"], t["fact_hr"]))
    scd2_after_day2 = apply_scd2_full(t["dim_employee_scd2"], day2, sc.DAY2).checkpoint()

    def master_load():
        run_all(Warehouse(spark, scratch_path(spark, "bench-wh"), new=True), raw,
                as_of=sc.DAY1, stamp=dt.datetime(2024, 1, 1))

    def reload_no_change():
        # second identical load on the built warehouse: every anti join finds
        # the rows present; a dry run, so the base copy is not changed
        events = run_domains(Warehouse(spark, base.root), raw, commit=False)
        assert all(n == 0 for _, _, n in events), events

    jobs = {
        "master_load_L4": master_load,
        "reload_no_change": reload_no_change,
        "clean_all_W1": lambda: [noop(clean_domain(raw[d], d))
                                 for d in ("hr", "finance", "operations")],
        "expense_month_dept_type_A5": lambda: noop(kpi.expense_by_month_department_type(
            t["fact_finance"], t["fact_hr"], t["dim_expensetype"], t["dim_department"])),
        "downtime_A7": lambda: noop(kpi.downtime_by_process_department(
            t["fact_operations"], t["dim_process"], t["dim_department"])),
        "view_super_V4": lambda: noop(views.view_super(t)),
        "scd2_apply_W5": lambda: noop(scd2_rows(t["dim_employee_scd2"], day2, sc.DAY2)),
        "hr_kpis_A2_A4": lambda: [noop(kpi.headcount(t["fact_hr"])),
                                  noop(kpi.attrition(t["fact_hr"])),
                                  noop(kpi.salary_by_gender(t["fact_hr"], t["dim_employee"]))],
        "expense_month_type_A6": lambda: noop(kpi.expense_by_month_type(
            t["fact_finance"], t["dim_expensetype"])),
        "role_views_V1_V3": lambda: [noop(views.VIEWS[v](t)) for v in
                                     ("view_hr_user", "view_finance_user", "view_operations_user")],
        "change_report_W7": lambda: noop(change_report(scd2_after_day2)),
        "checks_W11": lambda: [noop(checks.orphans(t)), noop(checks.duplicate_keys(t))],
    }
    results = {name: timed(fn, runs) for name, fn in jobs.items()}
    total = round(sum(results.values()), 3)
    print(json.dumps({"metric": "headline_jobs_total_median_sec", "value": total, "unit": "sec",
                      "queries": results, "sf": sf, "cpus": int(cpus), "runs": runs}))
    spark.stop()


if __name__ == "__main__":
    main()
