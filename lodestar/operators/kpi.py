"""KPIs A2-A7.

Plans aggregate facts by surrogate keys first (partial + final hash
aggregate, so a hot key is combined map-side), then attach dimension names to
the few aggregated rows. Values are doubles, as in pandas, so none is narrowed
or refused; their sums are exact and rounded once (``sums``), so a total is
the same for any order or partitioning of the rows. NULL group keys are dropped as pandas ``groupby`` does (P15); an all-NULL
group sums to 0, as in pandas.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodestar.functions import key_month, month_text, percentage
from lodestar.operators import distinct, sums
from lodestar.operators.joins import last_per_key


def _total(c):
    return F.coalesce(F.col(c), F.lit(0.0)).cast("double").alias(c)


def headcount(fact_hr: DataFrame) -> DataFrame:
    """A2: distinct employees with an ``active`` status (case-insensitive,
    untrimmed)."""
    active = F.coalesce(F.lower(F.col("status")) == F.lit("active"), F.lit(False))
    found = distinct.id_sets(fact_hr, "employeeid", {"headcount": active})
    return distinct.sizes(found, ["headcount"])


def attrition(fact_hr: DataFrame) -> DataFrame:
    """A3: distinct resigned / distinct employees * 100, rounded to 2 places;
    NULL with no employees (D21)."""
    resigned = F.coalesce(F.lower(F.col("status")) == F.lit("resigned"), F.lit(False))
    found = distinct.id_sets(fact_hr, "employeeid", {"resigned": resigned, "employees": F.lit(True)})
    counts = distinct.sizes(found, ["resigned", "employees"])
    return counts.select("resigned", "employees",
                         F.round(percentage("resigned", "employees"), 2).alias("attrition_rate"))


def salary_by_gender(fact_hr: DataFrame, dim_employee: DataFrame) -> DataFrame:
    """A4: mean salary per gender over HR fact rows (not per person)."""
    per_emp = (sums.binned(fact_hr.select("employeeid", "salary", F.col("salary").alias("_has")), "salary")
               .groupBy("employeeid", "_bin")
               .agg(*[F.sum(p).alias(p) for p in sums.PIECES], F.sum("_odd").alias("_odd"),
                    F.count("_has").alias("n")))
    genders = dim_employee.select("employeeid", "gender")
    by_bin = (per_emp.join(genders, "employeeid", "left").where(F.col("gender").isNotNull())
              .groupBy("gender", "_bin")
              .agg(*[F.sum(p).alias(p) for p in sums.PIECES], F.sum("_odd").alias("_odd"),
                   F.sum("n").alias("n")))
    by_gender = sums.totals(by_bin, ["gender"], "s", F.sum("n").alias("n"))
    return by_gender.select(
        "gender", F.try_divide(F.col("s"), F.col("n").cast("double"))
        .alias("avg_salary"), F.col("n").alias("fact_rows"))


def _finance_by_month(fact_finance: DataFrame, by_employee: bool) -> DataFrame:
    """Parts of the monthly amounts."""
    keys = (["employeeid"] if by_employee else []) + ["month", "expensetypeid"]
    rows = (fact_finance.withColumn("month", key_month("datekey"))
            .where(F.col("month").isNotNull()).select(*keys, "expenseamount"))
    return sums.added(sums.binned(rows, "expenseamount"), keys)


def expense_by_month_department_type(fact_finance: DataFrame, fact_hr: DataFrame,
                                     dim_expensetype: DataFrame, dim_department: DataFrame,
                                     latest_assignment: bool = False) -> DataFrame:
    """A5: monthly expense by department and expense type.

    The department comes from the employee's HR facts. By default every HR
    fact of the employee counts, so an expense is repeated once per HR fact
    (the reference's fan-out, D14); ``latest_assignment=True`` uses only the
    department of the latest HR fact (highest date key, then fact key).
    The fan-out is applied as a multiplicity on pre-aggregated amounts
    instead of joining raw rows.
    """
    fin = _finance_by_month(fact_finance, by_employee=True)
    if latest_assignment:
        assign = (last_per_key(fact_hr, "employeeid", ["datekey", "hrid"], ["departmentid"])
                  .withColumn("m", F.lit(1).cast("bigint")))
    else:
        assign = fact_hr.groupBy("employeeid", "departmentid").agg(F.count(F.lit(1)).alias("m"))
    by_ids = sums.added(fin.join(assign, "employeeid"), ["month", "departmentid", "expensetypeid"], "m")
    named = (by_ids.join(dim_department.select("departmentid", "department"), "departmentid")
             .join(dim_expensetype.select("expensetypeid", "expensetype"), "expensetypeid")
             .where(F.col("department").isNotNull() & F.col("expensetype").isNotNull()))
    keys = ["month", "department", "expensetype"]
    return (sums.totals(named, keys, "total_expense")
            .select(month_text("month").alias("month"), "department", "expensetype", _total("total_expense")))


def expense_by_month_type(fact_finance: DataFrame, dim_expensetype: DataFrame) -> DataFrame:
    """Monthly expense by expense type (no HR join, so no fan-out)."""
    fin = _finance_by_month(fact_finance, by_employee=False)
    named = (fin.join(dim_expensetype.select("expensetypeid", "expensetype"), "expensetypeid")
             .where(F.col("expensetype").isNotNull()))
    keys = ["month", "expensetype"]
    return (sums.totals(named, keys, "total_expense")
            .select(month_text("month").alias("month"), "expensetype", _total("total_expense")))


def downtime_by_process_department(fact_operations: DataFrame, dim_process: DataFrame,
                                   dim_department: DataFrame) -> DataFrame:
    """Total downtime by process and department."""
    rows = fact_operations.select("processid", "departmentid", "downtimehours")
    by_ids = sums.added(sums.binned(rows, "downtimehours"), ["processid", "departmentid"])
    named = (by_ids.join(dim_process.select("processid", "processname"), "processid")
             .join(dim_department.select("departmentid", "department"), "departmentid")
             .where(F.col("processname").isNotNull() & F.col("department").isNotNull()))
    keys = ["processname", "department"]
    return (sums.totals(named, keys, "total_downtime")
            .select(*keys, _total("total_downtime")))


def for_display(df: DataFrame, *keys) -> DataFrame:
    """O2: the reference's pandas ``groupby`` output is sorted by its keys.
    The KPIs above stay unsorted (a global sort is a shuffle nobody needs
    until the result is shown); sort only for display."""
    return df.orderBy(*(keys or df.columns[:-1]))
