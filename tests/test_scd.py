"""SCD1 (W4) and SCD2 (W5, W7) edge cases on tiny inline tables."""

import datetime as dt

import pytest
from pyspark.errors import PySparkException
from pyspark.sql.utils import CapturedException

from lodestar.operators.dimensions import OP, dim_merge_scd1
from lodestar.operators.scd2 import SCD2_COLUMNS, apply_scd2_full, change_report
from lodestar.sources.schemas import DIM_EMPLOYEE_SCD2

D1, D2 = dt.date(2024, 1, 1), dt.date(2024, 2, 1)
INP = "employeeid long, name string, gender string, managerid int, status string"


def table(spark, rows):
    return spark.createDataFrame(rows, DIM_EMPLOYEE_SCD2)


def by_id(df):
    out = {}
    for r in df.select(*SCD2_COLUMNS).collect():
        out.setdefault(r.employeeid, []).append(tuple(r))
    return {k: sorted(v, key=lambda x: (x[4], x[6])) for k, v in out.items()}


def test_scd2_branches(spark):
    first = apply_scd2_full(table(spark, []), spark.createDataFrame(
        [(1, "a", "F", None, "Active"), (2, "b", "M", 3, "Active"), (3, "c", "F", 1, "Active"),
         (4, "d", "M", 2, "Active")], INP), D1)
    day2 = spark.createDataFrame(
        [(1, "a", "F", 5, "Active"),      # NULL -> value: a change
         (2, "b", "M", None, "Active"),   # value -> NULL: a change
         (3, "c", "F", 1, "Active")],     # unchanged; id 4 missing: stays open
        INP)
    got = by_id(apply_scd2_full(first, day2, D2))
    assert got[1] == [(1, "a", "F", None, D1, D2, 0, "Active"), (1, "a", "F", 5, D2, None, 1, "Active")]
    assert got[2] == [(2, "b", "M", 3, D1, D2, 0, "Active"), (2, "b", "M", None, D2, None, 1, "Active")]
    assert got[3] == [(3, "c", "F", 1, D1, None, 1, "Active")]
    assert got[4] == [(4, "d", "M", 2, D1, None, 1, "Active")]


def test_scd2_same_day_change_replaces_current(spark):
    s1 = apply_scd2_full(table(spark, []), spark.createDataFrame([(1, "a", "F", 1, "Active")], INP), D1)
    s2 = apply_scd2_full(s1, spark.createDataFrame([(1, "b", "F", 1, "Active")], INP), D2)
    s3 = apply_scd2_full(s2, spark.createDataFrame([(1, "c", "F", 1, "Active")], INP), D2)
    got = by_id(s3)[1]
    assert got == [(1, "a", "F", 1, D1, D2, 0, "Active"), (1, "c", "F", 1, D2, None, 1, "Active")]
    report = [tuple(r) for r in change_report(s3).collect()]
    assert report == [(1, "name: a → c", "Active")]


def test_scd2_rejects_as_of_before_start(spark):
    s1 = apply_scd2_full(table(spark, []), spark.createDataFrame([(1, "a", "F", 1, "A")], INP), D2)
    with pytest.raises((PySparkException, CapturedException, Exception)):
        apply_scd2_full(s1, spark.createDataFrame([(1, "b", "F", 1, "A")], INP), D1).collect()


def test_scd1_null_rule(spark):
    dim = spark.createDataFrame([(1, "a", "F", None), (2, "b", "M", None), (3, "c", "F", 7)],
                                "employeeid long, name string, gender string, managerid int")
    staging = spark.createDataFrame(
        [(1, "a", "F", 5, D1), (2, "bb", "M", 5, D1), (3, "c", "F", 7, D1), (4, "d", "M", 1, D1),
         (4, "d2", "M", 1, D2)],
        "EmployeeID long, Name string, Gender string, ManagerID int, DateOfJoining date")
    got = {r.employeeid: (r.name, r.managerid, r[OP])
           for r in dim_merge_scd1(dim, staging).collect()}
    # NULL -> 5 alone is not seen (3-valued <>); a name change updates every column
    assert got == {1: ("a", None, "keep"), 2: ("bb", 5, "update"), 3: ("c", 7, "keep"),
                   4: ("d2", 1, "insert")}
