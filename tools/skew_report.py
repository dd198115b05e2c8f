"""Skew check from Spark's event log.

Makes one employee own a third of the finance extract (rows picked by a hash
of their values), runs the master load, the finance KPI (A5) and the finance
view (V2) with the event log written to a fresh scratch folder, then prints
per stage: tasks, and the largest vs the median number of records a task
read (input + shuffle). A stage where one task reads a third of the rows
shows up as max/median far above 1.

The broadcast threshold is lowered so only the small dimensions are broadcast
(``dim_employee`` would not be at scale) and AQE's skew thresholds are scaled down to the data, so
shuffle joins meet the hot key as they would on a cluster.

    python tools/skew_report.py [sf_dir]
"""

from __future__ import annotations

import glob
import json
import os
import re
import statistics
import sys
import tempfile

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import functions as F  # noqa: E402

from lodestar.operators import kpi, views  # noqa: E402
from lodestar.plans.loads import run_all, warehouse_tables  # noqa: E402
from lodestar.session import get_session, scratch_path  # noqa: E402
from lodestar.sources.fixtures import land_extracts  # noqa: E402
from lodestar.sources.store import Warehouse  # noqa: E402


def records(metrics: dict) -> int:
    n = 0
    n += (metrics.get("Input Metrics") or {}).get("Records Read", 0)
    n += (metrics.get("Shuffle Read Metrics") or {}).get("Total Records Read", 0)
    return n


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    log_dir = tempfile.mkdtemp(prefix="lodestar-events-")
    spark = get_session("local[8]", app_name="lodestar-skew", shuffle_partitions=8, extra={
        "spark.eventLog.enabled": "true", "spark.eventLog.dir": log_dir,
        "spark.eventLog.compress": "false", "spark.eventLog.rolling.enabled": "false",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "256k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "256k",
        # small dimensions stay broadcast; dim_employee, which grows with the
        # data, is joined by shuffle as it would be at scale
        "spark.sql.autoBroadcastJoinThreshold": "8k",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "8k"})
    if os.environ.get("SKEW_NO_COALESCE"):   # to tell coalescing from skew
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    spark.sparkContext.setLogLevel("ERROR")
    sc = spark.sparkContext

    raw = land_extracts(spark, sf_dir, scratch_path(spark, "skew-landing"))
    hot = raw["hr"].where(F.col("EmployeeID").isNotNull()).agg(F.min("EmployeeID")).collect()[0][0]
    fin = raw["finance"]
    pick = (F.abs(F.xxhash64(*fin.columns)) % 3) == 0
    raw["finance"] = fin.withColumn("EmployeeID", F.when(pick, F.lit(hot)).otherwise(F.col("EmployeeID")))

    wh = Warehouse(spark, scratch_path(spark, "skew-wh"), new=True)
    sc.setJobGroup("load", "master load with a hot employee")
    run_all(wh, raw, as_of="2024-01-01")
    t = warehouse_tables(wh)
    hot_rows = t["fact_finance"].where(F.col("employeeid") == hot).count()
    total = t["fact_finance"].count()
    sc.setJobGroup("a5", "finance KPI")
    kpi.expense_by_month_department_type(t["fact_finance"], t["fact_hr"], t["dim_expensetype"],
                                         t["dim_department"]).write.format("noop") \
        .mode("overwrite").save()
    sc.setJobGroup("v2", "finance view")
    views.view_finance(t).write.format("noop").mode("overwrite").save()
    app = sc.applicationId
    spark.stop()

    stages, group_of_job, stage_job, split_joins = {}, {}, {}, set()
    files = [p for p in glob.glob(os.path.join(log_dir, "**", "*"), recursive=True)
             if os.path.isfile(p)]
    for path in files:
        with open(path) as fh:
            for line in fh:
                e = json.loads(line)
                kind = e.get("Event")
                if kind == "SparkListenerJobStart":
                    props = e.get("Properties") or {}
                    group_of_job[e["Job ID"]] = props.get("spark.jobGroup.id", "-")
                    for sid in e.get("Stage IDs", []):
                        stage_job[sid] = e["Job ID"]
                elif kind == "SparkListenerTaskEnd" and e.get("Task Metrics"):
                    stages.setdefault(e["Stage ID"], []).append(records(e["Task Metrics"]))
                elif kind and kind.endswith("SparkListenerSQLAdaptiveExecutionUpdate"):
                    # AQE marks a join whose hot partitions it split
                    plan = e.get("physicalPlanDescription", "")
                    split_joins.update(re.findall(r"SortMergeJoin\(skew=true\) (\w+)", plan))
    report = []
    for sid, recs in sorted(stages.items()):
        if len(recs) < 2 or max(recs) < 1000:
            continue
        med = statistics.median(recs)
        report.append({"group": group_of_job.get(stage_job.get(sid), "-"), "stage": sid,
                       "tasks": len(recs), "max_records": max(recs), "median_records": med,
                       "max_over_median": round(max(recs) / med, 1) if med else None})
    print(json.dumps({"app": app, "hot_employee": hot, "hot_fact_rows": hot_rows,
                      "fact_rows": total, "joins_split_by_aqe": sorted(split_joins),
                      "event_log": log_dir}))
    for r in report:
        print(json.dumps(r))


if __name__ == "__main__":
    main()
