"""Registered queries: one per operator or close pair of operators.

Every query takes ``(spark, sf_dir)`` and reads the driver's tables (or a
warehouse Spark derived from them), so its work grows with the data. Column
names match the DuckDB oracle in ``lodestar.plans.oracle``.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lodestar.functions import (lenient_number, lenient_timestamp, strip, title_strip,
                                value_map)
from lodestar.operators import checks, kpi, views
from lodestar.operators.audit import audit_listing
from lodestar.operators.cleaning import SPECS, clean_before_dedup, clean_domain
from lodestar.operators.dimensions import OP, date_dimension, dim_merge_scd1
from lodestar.operators.scd2 import SCD2_COLUMNS, change_report
from lodestar.operators.stats import exact_median_df
from lodestar.plans import scenarios as sc
from lodestar.sources import schemas
from lodestar.sources.fixtures import raw_finance, raw_hr, raw_operations, raw_extracts
from lodestar.sources.store import Warehouse


def _select(df: DataFrame, schema) -> DataFrame:
    return df.select([f.name for f in schema.fields])


def _union(parts) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)


# -- W1 and its column rules --------------------------------------------------

def clean_hr(spark, sf):
    return clean_domain(raw_hr(spark, sf), "hr")


def clean_finance(spark, sf):
    return clean_domain(raw_finance(spark, sf), "finance")


def clean_operations(spark, sf):
    return clean_domain(raw_operations(spark, sf), "operations")


def clean_literal_counts(spark, sf):
    """Staging row counts under the literal reading of missing text."""
    raw = raw_extracts(spark, sf)
    return _union([clean_domain(raw[d], d, missing="literal")
                   .agg(F.count(F.lit(1)).alias("rows"))
                   .select(F.lit(d).alias("domain"), "rows") for d in ("hr", "finance", "operations")])


def salary_median_fill(spark, sf):
    return exact_median_df(raw_hr(spark, sf), "Salary", "salary_median")


def title_case(spark, sf):
    by_raw = raw_operations(spark, sf).groupBy(F.col("Location").alias("raw_location")) \
        .agg(F.count(F.lit(1)).alias("n"))
    return by_raw.select("raw_location", title_strip("raw_location").alias("location"), "n")


def _by_raw(df: DataFrame, source: str, col: str, parse) -> DataFrame:
    g = df.groupBy(F.col(col).cast("string").alias("raw_value")).agg(F.count(F.lit(1)).alias("n"))
    return g.select(F.lit(source).alias("source"), "raw_value", parse(F.col("raw_value")), "n")


def lenient_number_q(spark, sf):
    h, f, o = raw_hr(spark, sf), raw_finance(spark, sf), raw_operations(spark, sf)
    p = lambda c: lenient_number(c).alias("value")
    return _union([_by_raw(h, "ManagerID", "ManagerID", p),
                   _by_raw(f, "ExpenseAmount", "ExpenseAmount", p),
                   _by_raw(f, "ApprovedBy", "ApprovedBy", p),
                   _by_raw(o, "DowntimeHours", "DowntimeHours", p)])


def lenient_date_q(spark, sf):
    h, f, o = raw_hr(spark, sf), raw_finance(spark, sf), raw_operations(spark, sf)
    p = lambda c: F.to_date(lenient_timestamp(c)).alias("parsed")
    return _union([_by_raw(h, "DateOfJoining", "DateOfJoining", p),
                   _by_raw(f, "ExpenseDate", "ExpenseDate", p),
                   _by_raw(o, "ProcessDate", "ProcessDate", p)])


def value_map_q(spark, sf):
    mapping = SPECS["finance"].value_maps["ExpenseType"]
    g = raw_finance(spark, sf).groupBy(F.col("ExpenseType").alias("raw_value")) \
        .agg(F.count(F.lit(1)).alias("n"))
    return g.select("raw_value", value_map(F.upper(strip("raw_value")), mapping)
                    .alias("expensetype"), "n")


def dedup_rows(spark, sf):
    """Rows before and after the full-row dedup (P8), per domain, in one
    aggregation: group by every column, then count groups and rows."""
    raw = raw_extracts(spark, sf)
    parts = []
    for d in ("hr", "finance", "operations"):
        pre = clean_before_dedup(raw[d], SPECS[d])
        g = pre.groupBy(*pre.columns).agg(F.count(F.lit(1)).alias("c"))
        parts.append(g.agg(F.sum("c").cast("bigint").alias("rows_before"),
                           F.count(F.lit(1)).alias("rows_after"))
                     .select(F.lit(d).alias("domain"), "rows_before", "rows_after"))
    return _union(parts)


# -- dimensions, facts, incremental loads -------------------------------------

def _base(name):
    def q(spark, sf):
        return _select(sc.base_tables(spark, sf)[name], schemas.WAREHOUSE[name])
    q.__name__ = name
    return q


# Dimension, surrogate key and natural key.
SURROGATE_DIMS = [("dim_department", "departmentid", "department"),
                  ("dim_expensetype", "expensetypeid", "expensetype"),
                  ("dim_process", "processid", "processname"),
                  ("dim_location", "locationid", "location")]


def dim_second_load(spark, sf):
    t = sc.incremental_tables(spark, sf, version=2)
    return _union([t[n].select(F.lit(n).alias("dimension"), F.col(k).alias("id"),
                               F.col(v).alias("value")) for n, k, v in SURROGATE_DIMS])


def fact_second_load(spark, sf):
    t = sc.incremental_tables(spark, sf, version=2)
    return _select(t["fact_finance"], schemas.FACT_FINANCE)


def fact_reload_empty(spark, sf):
    """Rows the third identical load inserted into each fact: zero."""
    t = sc.incremental_tables(spark, sf, version=3)
    audit = t["audit_log"]
    third = audit.where(F.col("timestamp") == F.lit("2024-01-03 12:00:00").cast("timestamp"))
    return third.where(F.col("table_name").startswith("fact_")).select(
        "table_name", F.col("row_count").alias("inserted"))


def stream_incremental_finance(spark, sf):
    """fact_finance after two stream runs over newly landed extract files."""
    wh = Warehouse(spark, sc.streamed_finance_root(spark, sf))
    return _select(wh.read("fact_finance"), schemas.FACT_FINANCE)


def scd1_update(spark, sf):
    t = sc.base_tables(spark, sf)
    staging = sc.base_warehouse(spark, sf).read("staging_hr")
    return dim_merge_scd1(t["dim_employee"], sc.scd1_staging(staging)).drop(OP)


# -- SCD2 ---------------------------------------------------------------------

def _scd2(state):
    def q(spark, sf):
        return sc.scd2_states(spark, sf)[state].select(*SCD2_COLUMNS)
    q.__name__ = f"scd2_{state}"
    return q


def scd2_change_report(spark, sf):
    return change_report(sc.scd2_states(spark, sf)["missing"])


# -- KPIs ---------------------------------------------------------------------

def kpi_headcount(spark, sf):
    return kpi.headcount(sc.base_tables(spark, sf)["fact_hr"])


def kpi_attrition(spark, sf):
    return kpi.attrition(sc.base_tables(spark, sf)["fact_hr"])


def kpi_salary_by_gender(spark, sf):
    t = sc.base_tables(spark, sf)
    return kpi.salary_by_gender(t["fact_hr"], t["dim_employee"])


def kpi_expense_month_dept_type(spark, sf):
    t = sc.base_tables(spark, sf)
    return kpi.expense_by_month_department_type(
        t["fact_finance"], t["fact_hr"], t["dim_expensetype"], t["dim_department"])


def kpi_expense_latest_assignment(spark, sf):
    t = sc.base_tables(spark, sf)
    return kpi.expense_by_month_department_type(
        t["fact_finance"], t["fact_hr"], t["dim_expensetype"], t["dim_department"],
        latest_assignment=True)


def kpi_expense_month_type(spark, sf):
    t = sc.base_tables(spark, sf)
    return kpi.expense_by_month_type(t["fact_finance"], t["dim_expensetype"])


def kpi_downtime(spark, sf):
    t = sc.base_tables(spark, sf)
    return kpi.downtime_by_process_department(
        t["fact_operations"], t["dim_process"], t["dim_department"])


def kpi_downtime_sorted(spark, sf):
    """O2: the KPI in display order, with each row's place in it."""
    shown = kpi.for_display(kpi_downtime(spark, sf), "processname", "department")
    return shown.withColumn("place", F.row_number().over(
        Window.orderBy("processname", "department")))


# -- views, audit, checks, date dimension, pipeline -----------------------------

def _view(role):
    def q(spark, sf):
        return views.role_view(sc.base_tables(spark, sf), role)
    q.__name__ = f"view_{role.lower()}"
    return q


def audit_rows(spark, sf):
    audit = sc.base_tables(spark, sf)["audit_log"]
    return audit.select("id", "operation_type", "table_name", "row_count")


def audit_listing_q(spark, sf):
    """The trail newest first, with stamp and place in the list."""
    listed = audit_listing(sc.incremental_tables(spark, sf, version=3)["audit_log"])
    return listed.withColumn("place", F.row_number().over(
        Window.orderBy(F.col("timestamp").desc(), F.col("id").desc())))


def view_super_sql(spark, sf):
    """V6: SQL over the registered views."""
    views.register_views(spark, sc.base_tables(spark, sf))
    return spark.sql("SELECT Source, count(*) AS n, count(employeeid) AS with_employee, "
                     "min(datekey) AS first_key, max(datekey) AS last_key "
                     "FROM view_super_user GROUP BY Source")


def _domain_table(name, root=sc.domain_by_domain_root):
    def q(spark, sf):
        df = Warehouse(spark, root(spark, sf)).read(name)
        return _select(df, schemas.WAREHOUSE[name])
    return q


def check_orphans(spark, sf):
    return checks.orphans(sc.base_tables(spark, sf))


def check_duplicate_keys(spark, sf):
    return checks.duplicate_keys(sc.base_tables(spark, sf))


def dim_date(spark, sf):
    t = sc.base_tables(spark, sf)
    return date_dimension(t["fact_hr"], t["fact_finance"], t["fact_operations"])


def literal_load_row_counts(spark, sf):
    """Row counts after a master load that reads missing text as 'nan' (D1)."""
    wh = sc.literal_warehouse(spark, sf)
    names = list(schemas.STAGING) + [n for n in schemas.WAREHOUSE
                                     if n not in ("dim_employee_scd2", "audit_log")]
    return _union([wh.read(n, schemas.STAGING.get(n) or schemas.WAREHOUSE.get(n))
                   .agg(F.count(F.lit(1)).alias("row_count"))
                   .select(F.lit(n).alias("table_name"), "row_count") for n in names])


def master_load_row_counts(spark, sf):
    """Row count of every table after the master pipeline (L4)."""
    wh = sc.base_warehouse(spark, sf)
    names = list(schemas.STAGING) + list(schemas.WAREHOUSE)
    return _union([wh.read(n, schemas.STAGING.get(n) or schemas.WAREHOUSE.get(n))
                   .agg(F.count(F.lit(1)).alias("row_count"))
                   .select(F.lit(n).alias("table_name"), "row_count") for n in names])


QUERIES = {
    "clean_hr": clean_hr,
    "clean_finance": clean_finance,
    "clean_operations": clean_operations,
    "clean_literal_counts": clean_literal_counts,
    "salary_median_fill": salary_median_fill,
    "title_case": title_case,
    "lenient_number": lenient_number_q,
    "lenient_date": lenient_date_q,
    "value_map": value_map_q,
    "dedup_rows": dedup_rows,
    "dim_department": _base("dim_department"),
    "dim_employee": _base("dim_employee"),
    "dim_expensetype": _base("dim_expensetype"),
    "dim_process": _base("dim_process"),
    "dim_location": _base("dim_location"),
    "dim_second_load": dim_second_load,
    "scd1_update": scd1_update,
    "fact_hr": _base("fact_hr"),
    "fact_finance": _base("fact_finance"),
    "fact_operations": _base("fact_operations"),
    "fact_second_load": fact_second_load,
    "fact_reload_empty": fact_reload_empty,
    "stream_incremental_finance": stream_incremental_finance,
    "scd2_first": _scd2("first"),
    "scd2_second": _scd2("second"),
    "scd2_same_day": _scd2("same_day"),
    "scd2_missing_id": _scd2("missing"),
    "scd2_change_report": scd2_change_report,
    "kpi_headcount": kpi_headcount,
    "kpi_attrition": kpi_attrition,
    "kpi_salary_by_gender": kpi_salary_by_gender,
    "kpi_expense_month_dept_type": kpi_expense_month_dept_type,
    "kpi_expense_latest_assignment": kpi_expense_latest_assignment,
    "kpi_expense_month_type": kpi_expense_month_type,
    "kpi_downtime": kpi_downtime,
    "view_hr": _view("HR"),
    "view_finance": _view("Finance"),
    "view_operations": _view("Operations"),
    "view_super": _view("Super"),
    "audit_rows": audit_rows,
    "audit_listing": audit_listing_q,
    "view_super_sql": view_super_sql,
    "kpi_downtime_sorted": kpi_downtime_sorted,
    "hr_load_alone_scd2": _domain_table("dim_employee_scd2"),
    "finance_load_alone": _domain_table("fact_finance"),
    "operations_load_alone": _domain_table("fact_operations"),
    "csv_load_finance": _domain_table("fact_finance", sc.csv_root),
    "drift_load_employee": _domain_table("dim_employee", sc.drift_root),
    "drift_load_finance": _domain_table("fact_finance", sc.drift_root),
    "stream_hr_scd2": _domain_table("dim_employee_scd2", sc.streamed_hr_root),
    "check_orphans": check_orphans,
    "check_duplicate_keys": check_duplicate_keys,
    "dim_date": dim_date,
    "master_load_row_counts": master_load_row_counts,
    "literal_load_row_counts": literal_load_row_counts,
}
