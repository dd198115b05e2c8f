
import datetime as dt

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from lodestar.operators import checks, kpi, views
from lodestar.plans import scenarios as sc
from lodestar.plans.loads import run_domains, warehouse_tables
from lodestar.sources.fixtures import raw_extracts
from lodestar.sources.store import Warehouse


@pytest.fixture(scope="module")
def wh(spark):
    return sc.base_warehouse(spark, SF_SMALL)


@pytest.fixture(scope="module")
def t(wh):
    return warehouse_tables(wh)


def test_golden_counts(t):
    got = {n: t[n].count() for n in ("dim_employee", "dim_department", "dim_expensetype",
                                     "dim_process", "dim_location", "fact_hr", "fact_finance",
                                     "fact_operations", "dim_employee_scd2", "audit_log")}
    assert got == {"dim_employee": 138, "dim_department": 6, "dim_expensetype": 6,
                   "dim_process": 5, "dim_location": 4, "fact_hr": 141, "fact_finance": 1247,
                   "fact_operations": 816, "dim_employee_scd2": 138, "audit_log": 8}


def test_hr_kpis(t):
    assert kpi.headcount(t["fact_hr"]).collect()[0].headcount == 111
    a = kpi.attrition(t["fact_hr"]).collect()[0]
    assert (a.resigned, a.employees, a.attrition_rate) == (27, 138, 19.57)
    g = {r.gender: (round(r.avg_salary, 4), r.fact_rows)
         for r in kpi.salary_by_gender(t["fact_hr"], t["dim_employee"]).collect()}
    assert g == {"Female": (4979.6065, 65), "Male": (3997.6517, 65), "Unknown": (3640.4409, 11)}


def test_finance_kpi_fan_out(t):
    a5 = kpi.expense_by_month_department_type(t["fact_finance"], t["fact_hr"],
                                              t["dim_expensetype"], t["dim_department"])
    latest = kpi.expense_by_month_department_type(t["fact_finance"], t["fact_hr"],
                                                  t["dim_expensetype"], t["dim_department"],
                                                  latest_assignment=True)
    total = a5.agg(F.sum("total_expense")).collect()[0][0]
    correct = latest.agg(F.sum("total_expense")).collect()[0][0]
    fact_total = t["fact_finance"].agg(F.sum(F.col("expenseamount").cast("decimal(18,4)"))) \
        .collect()[0][0]
    assert a5.count() == 949 and latest.count() == 936
    assert round(total, 2) == 315448078.17
    assert round(float(fact_total), 2) == 311432253.2
    assert total >= correct  # D14: fan-out never lowers a non-negative total
    assert kpi.expense_by_month_type(t["fact_finance"], t["dim_expensetype"]).count() == 416


def test_downtime_kpi(t):
    a7 = kpi.downtime_by_process_department(t["fact_operations"], t["dim_process"],
                                            t["dim_department"])
    assert a7.count() == 25
    assert round(a7.agg(F.sum("total_downtime")).collect()[0][0], 2) == 40552.67


def test_views_and_roles(t):
    counts = {n: views.VIEWS[n](t).count() for n in views.VIEWS}
    assert counts["view_super_user"] == (counts["view_hr_user"] + counts["view_finance_user"]
                                         + counts["view_operations_user"])
    assert views.view_super(t).columns == views.SUPER_COLUMNS
    with pytest.raises(PermissionError):
        views.role_view(t, "Intern")


def test_no_orphans_no_duplicate_keys(t):
    assert {r.orphan_rows for r in checks.orphans(t).collect()} == {0}
    assert {r.duplicate_keys for r in checks.duplicate_keys(t).collect()} == {0}


def test_scd2_day1_one_current_per_id(t):
    s = t["dim_employee_scd2"]
    assert s.where("iscurrent = 1").groupBy("employeeid").count().where("count > 1").count() == 0
    assert s.select("startdate").distinct().collect()[0][0] == sc.DAY1


def test_second_identical_load_inserts_nothing_and_keeps_keys(spark, tmp_root, t):
    raw = raw_extracts(spark, SF_SMALL)
    wh = Warehouse(spark, tmp_root, new=True)
    run_domains(wh, raw, stamp=dt.datetime(2024, 1, 1))
    before = {n: sorted(map(tuple, wh.read(n).collect()))
              for n in ("dim_department", "fact_finance")}
    events = run_domains(wh, raw, stamp=dt.datetime(2024, 1, 2))
    assert [n for _, _, n in events] == [0] * 8
    after = Warehouse(spark, tmp_root)
    assert after.version == 2
    for n, rows in before.items():
        assert sorted(map(tuple, after.read(n).collect())) == rows
    # time travel: version 1 still readable, audit grows by 8 per run
    assert Warehouse(spark, tmp_root, version=1).read("audit_log").count() == 8
    assert after.read("audit_log").count() == 16


def test_incremental_two_loads(spark):
    first = Warehouse(spark, sc.incremental_root(spark, SF_SMALL), version=1)
    assert first.read("fact_finance").count() == 564
    full = Warehouse(spark, sc.incremental_root(spark, SF_SMALL), version=2)
    ff = full.read("fact_finance")
    assert ff.count() == 1247
    # keys of load 1 are unchanged by load 2 and new keys continue after them
    old = {r.financeid for r in first.read("fact_finance").select("financeid").collect()}
    assert old == set(range(1, 565))
    assert ff.agg(F.min("financeid"), F.max("financeid")).collect()[0][:] == (1, 1247)


def test_failed_run_is_invisible(spark, tmp_root):
    raw = raw_extracts(spark, SF_SMALL)
    wh = Warehouse(spark, tmp_root, new=True)
    run_domains(wh, raw, domains=("hr",), stamp=dt.datetime(2024, 1, 1))
    tx = wh.transaction()
    tx.write("dim_department", spark.createDataFrame([(99, "X")], "departmentid long, department string"))
    # no commit: readers still see the committed version
    assert Warehouse(spark, tmp_root).read("dim_department").count() == 6


def test_register_views_and_audit_listing(spark, t):
    from lodestar.operators.audit import audit_listing
    names = views.register_views(spark, t)
    assert spark.sql("SELECT count(*) FROM view_super_user").collect()[0][0] == \
        views.view_super(t).count()
    assert len(names) == 4
    ids = [r.id for r in audit_listing(t["audit_log"]).collect()]
    assert ids == sorted(ids, reverse=True)


def test_literal_reading_goldens(spark, tmp_root):
    """Missing text read as the literal 'nan' (FIXTURES.md §3, literal)."""
    from lodestar.plans.loads import run_all
    wh = Warehouse(spark, tmp_root, new=True)
    run_all(wh, raw_extracts(spark, SF_SMALL), as_of=sc.DAY1, missing="literal")
    t = warehouse_tables(wh)
    counts = {n: t[n].count() for n in ("dim_employee", "dim_department", "dim_expensetype",
                                        "dim_process", "dim_location", "fact_hr",
                                        "fact_finance", "fact_operations")}
    assert counts == {"dim_employee": 144, "dim_department": 7, "dim_expensetype": 7,
                      "dim_process": 5, "dim_location": 5, "fact_hr": 147,
                      "fact_finance": 1328, "fact_operations": 827}
    a = kpi.attrition(t["fact_hr"]).collect()[0]
    assert (kpi.headcount(t["fact_hr"]).collect()[0][0], a.resigned, a.attrition_rate) == \
        (116, 28, 19.44)
    a5 = kpi.expense_by_month_department_type(t["fact_finance"], t["fact_hr"],
                                              t["dim_expensetype"], t["dim_department"])
    assert a5.count() == 1028
    assert round(a5.agg(F.sum("total_expense")).collect()[0][0], 2) == 335179495.2
    a7 = kpi.downtime_by_process_department(t["fact_operations"], t["dim_process"],
                                            t["dim_department"])
    assert round(a7.agg(F.sum("total_downtime")).collect()[0][0], 2) == 40921.41


def test_fixture_history_goldens(spark, t):
    """FIXTURES.md §3-4 values for sf0.001 (default reading)."""
    two_facts = t["fact_hr"].groupBy("employeeid").count().where("count = 2").count()
    assert two_facts == 3
    twins = (t["fact_finance"].groupBy("employeeid", "expensetypeid", "datekey").count()
             .where("count > 1").count())
    assert twins == 0
    states = sc.scd2_states(spark, SF_SMALL)
    employees = t["dim_employee"].count()
    assert states["second"].count() - employees == 42          # changed on day 2
    cur2 = states["second"].where("iscurrent = 1").select("employeeid", "name")
    cur3 = states["same_day"].where("iscurrent = 1").select("employeeid", F.col("name").alias("n3"))
    replaced = cur2.join(cur3, "employeeid").where("name <> n3").count()
    assert replaced == 7                                       # replaced on day 2 again
    assert states["same_day"].count() == states["second"].count()
    # day 3: absent ids keep their open rows
    open3 = states["missing"].where("iscurrent = 1").count()
    assert open3 == employees


def test_optional_scd_audit(spark, tmp_root):
    """SCD1 updates and SCD2 closes/opens audited on request."""
    from lodestar.plans.loads import run_all
    raw = raw_extracts(spark, SF_SMALL)
    wh = Warehouse(spark, tmp_root, new=True)
    ev1 = run_all(wh, raw, as_of=sc.DAY1, audit_scd=True)
    assert ev1[8:] == [("dim_employee", "SCD1_UPDATE", 0),
                       ("dim_employee_scd2", "SCD2_CLOSE", 0),
                       ("dim_employee_scd2", "SCD2_OPEN", 138)]
    ev2 = run_all(wh, raw, as_of=sc.DAY2, audit_scd=True)
    assert [n for _, _, n in ev2] == [0] * 11
    assert wh.read("audit_log").count() == 22


def test_concurrent_and_serial_loads_are_identical(spark, tmp_root):
    """Keys and rows do not depend on how the independent loads interleave."""
    from lodestar.plans.loads import run_domains
    raw = raw_extracts(spark, SF_SMALL)
    got = []
    for parallel in (True, False):
        wh = Warehouse(spark, f"{tmp_root}/{'par' if parallel else 'ser'}", new=True)
        run_domains(wh, raw, as_of=sc.DAY1, scd2=True, parallel=parallel,
                    stamp=dt.datetime(2024, 1, 1))
        t = warehouse_tables(wh)
        got.append({n: sorted(map(tuple, df.collect())) for n, df in t.items()})
    assert got[0] == got[1]
