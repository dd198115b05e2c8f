"""Table schemas as code.

Raw extracts keep dirty columns as text; warehouse tables are typed. Ids from
the driver's tables are 64-bit, so natural and surrogate keys are ``bigint``.
"""

from __future__ import annotations

from pyspark.sql import types as T

S, L, I, D, DT, TS = (T.StringType(), T.LongType(), T.IntegerType(), T.DoubleType(),
                      T.DateType(), T.TimestampType())


def _schema(*fields) -> T.StructType:
    return T.StructType([T.StructField(n, t, True) for n, t in fields])


# Table and column names of the extracts and the warehouse.
# Raw extracts (S1). Salary arrives numeric, everything dirty arrives as text.
RAW_HR = _schema(("EmployeeID", L), ("Name", S), ("Gender", S), ("ManagerID", S),
                 ("Department", S), ("Salary", D), ("Status", S), ("DateOfJoining", S))
RAW_FINANCE = _schema(("EmployeeID", L), ("ExpenseType", S), ("ExpenseAmount", S),
                      ("ApprovedBy", S), ("ExpenseDate", S))
RAW_OPERATIONS = _schema(("ProcessName", S), ("Department", S), ("Location", S),
                         ("DowntimeHours", S), ("ProcessDate", S))

# Staging (S2): cleaned and narrowed.
STAGING_HR = _schema(("EmployeeID", L), ("Name", S), ("Gender", S), ("ManagerID", I),
                     ("Department", S), ("Salary", D), ("Status", S), ("DateOfJoining", DT))
STAGING_FINANCE = _schema(("EmployeeID", L), ("ExpenseType", S), ("ExpenseAmount", D),
                          ("ApprovedBy", I), ("ExpenseDate", DT))
STAGING_OPERATIONS = _schema(("ProcessName", S), ("Department", S), ("Location", S),
                             ("DowntimeHours", D), ("ProcessDate", DT))

# Warehouse.
DIM_EMPLOYEE = _schema(("employeeid", L), ("name", S), ("gender", S), ("managerid", I))
DIM_DEPARTMENT = _schema(("departmentid", L), ("department", S))
DIM_EXPENSETYPE = _schema(("expensetypeid", L), ("expensetype", S))
DIM_PROCESS = _schema(("processid", L), ("processname", S))
DIM_LOCATION = _schema(("locationid", L), ("location", S))
FACT_HR = _schema(("hrid", L), ("employeeid", L), ("departmentid", L), ("salary", D),
                  ("status", S), ("datekey", I))
FACT_FINANCE = _schema(("financeid", L), ("employeeid", L), ("expensetypeid", L),
                       ("expenseamount", D), ("approvedby", I), ("datekey", I))
FACT_OPERATIONS = _schema(("operationsid", L), ("processid", L), ("locationid", L),
                          ("departmentid", L), ("downtimehours", D), ("datekey", I))
DIM_EMPLOYEE_SCD2 = _schema(("employeeid", L), ("name", S), ("gender", S), ("managerid", I),
                            ("startdate", DT), ("enddate", DT), ("iscurrent", I),
                            ("status", S))
# The HR fact with the highest date key, then fact key, of every employee: kept
# between loads so that SCD2 does not read the HR facts again.
EMPLOYEE_STATUS = _schema(("employeeid", L), ("datekey", I), ("hrid", L), ("status", S))
AUDIT_LOG = _schema(("id", L), ("operation_type", S), ("table_name", S), ("row_count", L),
                    ("timestamp", TS))

WAREHOUSE = {
    "dim_employee": DIM_EMPLOYEE,
    "dim_department": DIM_DEPARTMENT,
    "dim_expensetype": DIM_EXPENSETYPE,
    "dim_process": DIM_PROCESS,
    "dim_location": DIM_LOCATION,
    "fact_hr": FACT_HR,
    "fact_finance": FACT_FINANCE,
    "fact_operations": FACT_OPERATIONS,
    "dim_employee_scd2": DIM_EMPLOYEE_SCD2,
    "audit_log": AUDIT_LOG,
}

STAGING = {
    "staging_hr": STAGING_HR,
    "staging_finance": STAGING_FINANCE,
    "staging_operations": STAGING_OPERATIONS,
}

RAW = {"hr": RAW_HR, "finance": RAW_FINANCE, "operations": RAW_OPERATIONS}


def empty(spark, schema: T.StructType):
    """An empty table for a first load."""
    return spark.createDataFrame([], schema)
