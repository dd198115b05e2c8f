"""Role views V1-V6.

Each view is a DataFrame of plain joins over the warehouse tables, so a
user's filter reaches the fact scan. Catalyst broadcasts a dimension whose
size is under the broadcast threshold; otherwise AQE splits the partition of
an employee that holds a large share of a fact. Authentication is not built:
``role_view`` only maps a role to its data (V5).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def _with_employee(fact: DataFrame, dim_employee: DataFrame, cols) -> DataFrame:
    return fact.join(dim_employee.select("employeeid", *cols), "employeeid")


def view_hr(t: dict) -> DataFrame:
    """V1."""
    hr = _with_employee(t["fact_hr"], t["dim_employee"], ["name", "gender", "managerid"])
    dept = t["dim_department"]
    return (hr.join(dept, "departmentid")
            .select("hrid", "employeeid", "name", "gender", "managerid", "department",
                    "salary", "status", "datekey"))


def view_finance(t: dict) -> DataFrame:
    """V2."""
    fin = _with_employee(t["fact_finance"], t["dim_employee"], ["name"])
    exp = t["dim_expensetype"]
    return (fin.join(exp, "expensetypeid")
            .select("financeid", "employeeid", "name", "expensetype", "expenseamount",
                    "approvedby", "datekey"))


def view_operations(t: dict) -> DataFrame:
    """V3."""
    named = t["fact_operations"]
    for dim, key in (("dim_process", "processid"), ("dim_location", "locationid"),
                     ("dim_department", "departmentid")):
        named = named.join(t[dim], key)
    return named.select("operationsid", "processname", "location", "department",
                        "downtimehours", "datekey")


# The super view's columns and branch labels.
SUPER_COLUMNS = ["Source", "ID", "employeeid", "name", "gender", "managerid", "department",
                 "Amount", "status", "datekey"]


def _null(t: str):
    return F.lit(None).cast(t)


def view_super(t: dict) -> DataFrame:
    """V4: the three role views stacked (UNION ALL), padded with typed NULLs;
    the finance branch still requires a known expense type and the
    operations branch a known process and location."""
    hr = view_hr(t).select(
        F.lit("HR").alias("Source"), F.col("hrid").alias("ID"), "employeeid", "name", "gender",
        "managerid", "department", F.col("salary").alias("Amount"), "status", "datekey")
    fin = view_finance(t).select(
        F.lit("FINANCE").alias("Source"), F.col("financeid").alias("ID"), "employeeid", "name",
        _null("string").alias("gender"), _null("int").alias("managerid"),
        _null("string").alias("department"), F.col("expenseamount").alias("Amount"),
        _null("string").alias("status"), "datekey")
    ops = view_operations(t).select(
        F.lit("OPERATIONS").alias("Source"), F.col("operationsid").alias("ID"),
        _null("bigint").alias("employeeid"), _null("string").alias("name"),
        _null("string").alias("gender"), _null("int").alias("managerid"), "department",
        F.col("downtimehours").alias("Amount"), _null("string").alias("status"), "datekey")
    return hr.unionByName(fin).unionByName(ops).select(*SUPER_COLUMNS)


VIEWS = {
    "view_hr_user": view_hr,
    "view_finance_user": view_finance,
    "view_operations_user": view_operations,
    "view_super_user": view_super,
}

# Role -> view.
ROLE_VIEWS = {
    "HR": "view_hr_user",
    "Finance": "view_finance_user",
    "Operations": "view_operations_user",
    "Super": "view_super_user",
}


def register_views(spark: SparkSession, tables: dict) -> list:
    """V6: (re)create the four role views as temp views."""
    for name, build in VIEWS.items():
        build(tables).createOrReplaceTempView(name)
    return list(VIEWS)


def role_view(tables: dict, role: str) -> DataFrame:
    """V5: the data a role may see; unknown roles are denied."""
    view = ROLE_VIEWS.get(role)
    if view is None:
        raise PermissionError(f"access denied for role {role!r}")
    return VIEWS[view](tables)
