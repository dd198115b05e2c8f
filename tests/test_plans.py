"""Plan checks: no Python evaluation, no nested-loop joins, pruned scans,
no single-partition window over a fact."""

import contextlib
import io

import pytest

from conftest import SF_SMALL
from lodestar.operators import kpi, views
from lodestar.operators.cleaning import clean_domain
from lodestar.operators.scd2 import scd2_input, scd2_rows
from lodestar.plans import scenarios as sc
from lodestar.plans.loads import warehouse_tables
from lodestar.sources.fixtures import raw_extracts


def plan(df) -> str:
    """The physical plan text, as printed by the public ``explain``."""
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain()
    return buf.getvalue()


@pytest.fixture(scope="module")
def t(spark):
    return warehouse_tables(sc.base_warehouse(spark, SF_SMALL))


@pytest.fixture(scope="module")
def plans(spark, t):
    raw = raw_extracts(spark, SF_SMALL)
    inc = scd2_input(t["dim_employee"], t["fact_hr"])
    dfs = {
        "clean_finance": clean_domain(raw["finance"], "finance"),
        "clean_operations": clean_domain(raw["operations"], "operations"),
        "a5": kpi.expense_by_month_department_type(t["fact_finance"], t["fact_hr"],
                                                   t["dim_expensetype"], t["dim_department"]),
        "a7": kpi.downtime_by_process_department(t["fact_operations"], t["dim_process"],
                                                 t["dim_department"]),
        "v4": views.view_super(t),
        "scd2_rows": scd2_rows(t["dim_employee_scd2"], inc, sc.DAY2),
        "scd2_input": inc,
    }
    return {k: plan(v) for k, v in dfs.items()}


def test_no_python_udfs(plans):
    for name, p in plans.items():
        assert "BatchEvalPython" not in p and "ArrowEvalPython" not in p, name


def test_no_nested_loop_joins(plans):
    for name, p in plans.items():
        assert "BroadcastNestedLoopJoin" not in p and "CartesianProduct" not in p, name


def test_kpi_scans_are_pruned(spark, t):
    df = kpi.downtime_by_process_department(t["fact_operations"], t["dim_process"],
                                            t["dim_department"])
    p = plan(df)
    # the fact scan reads only the columns the KPI needs
    assert "ReadSchema: struct<processid:bigint,departmentid:bigint,downtimehours:double>" in p \
        or "ReadSchema: struct<processid:bigint,departmentid:bigint,downtimehours:double" in p


def test_no_unpartitioned_window_over_fact(plans):
    for name in ("a5", "a7", "v4", "scd2_rows"):
        assert "Window [" not in plans[name] or "partitionBy" in plans[name], name
        assert "SinglePartition" not in plans[name], name


def test_a5_aggregates_before_join(plans):
    # partial aggregation appears before the employee join exchange
    assert plans["a5"].count("HashAggregate") >= 4


def test_scd2_applies_with_one_outer_join(plans):
    p = plans["scd2_rows"].split("== Initial Plan ==")[0]
    assert p.count("FullOuter") == 1
    assert p.count("iscurrent") >= 1 and p.count("Generate inline") == 1


def test_latest_status_is_reduced_by_hash(plans):
    p = plans["scd2_input"]
    assert "SortAggregate" not in p and "HashAggregate" in p


def test_view_filter_reaches_every_fact_scan(t):
    p = plan(views.view_hr(t).where("employeeid = 5 AND datekey = 20230105"))
    scans = [x for x in p.splitlines() if "FileScan" in x and "hrid" in x]
    assert len(scans) == 1
    assert "EqualTo(datekey,20230105)" in scans[0] and "EqualTo(employeeid,5)" in scans[0]


def test_orphan_check_scans_each_fact_once(t):
    from lodestar.operators import checks
    p = plan(checks.orphans(t))
    for key in ("processid", "expensetypeid", "departmentid"):
        assert p.count("SortMergeJoin") + p.count("BroadcastHashJoin") <= 2, key
    assert p.count("FileScan") == 3 + 5
