"""Raw HR, finance and operations extracts derived from the driver's tables.

The reference ships no data, so the three dirty extracts are derived from
``customer``, ``orders`` and ``events`` with injected dirt (missing values,
padding, mixed case, typos, bad numbers, several date layouts, exact copies
and second jobs). Every source row is used; the derivation only decides how
each row is made dirty. The same derivation exists as DuckDB SQL for the
oracle (``lodestar.plans.oracle``).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

def _null_s() -> Column:
    return F.lit(None).cast("string")


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _case(k: Column, rules, default) -> Column:
    """``CASE WHEN k % m = 0 THEN v ... ELSE default END``."""
    expr = None
    for m, v in rules:
        cond = (k % F.lit(m)) == 0
        expr = F.when(cond, v) if expr is None else expr.when(cond, v)
    return expr.otherwise(default) if expr is not None else default


def raw_hr(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = _table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("k"), "c_name", F.col("c_mktsegment").alias("seg"),
        F.col("c_nationkey").alias("nk"), F.col("c_acctbal").alias("bal"))
    k = F.col("k")
    yy = (F.lit(2015) + k % 8).cast("string")
    mm = F.lpad((F.lit(1) + k % 12).cast("string"), 2, "0")
    dd = F.lpad((F.lit(1) + k % 28).cast("string"), 2, "0")
    even = (k % 2) == 0
    first = c.select(
        F.when(k % 211 == 0, F.lit(None).cast("bigint")).otherwise(k).alias("EmployeeID"),
        F.col("c_name").alias("Name"),
        F.when(k % 13 == 0, _null_s()).when(even, F.lit("Female")).otherwise(F.lit("Male"))
        .alias("Gender"),
        F.when(k % 17 == 0, F.lit("n/a")).otherwise(F.col("nk").cast("string")).alias("ManagerID"),
        _case(k, [(23, _null_s()), (19, F.concat(F.lit("  "), F.lower("seg"), F.lit(" ")))],
              F.col("seg")).alias("Department"),
        F.when(k % 11 == 0, F.lit(None).cast("double")).otherwise(F.col("bal")).alias("Salary"),
        _case(k, [(5, F.lit("Resigned")), (7, F.lit("ACTIVE"))], F.lit("Active")).alias("Status"),
        _case(k, [(29, F.lit("not a date")),
                  (31, F.concat(mm, F.lit("/"), dd, F.lit("/"), yy))],
              F.concat(yy, F.lit("-"), mm, F.lit("-"), dd)).alias("DateOfJoining"),
        k)
    cols = ["EmployeeID", "Name", "Gender", "ManagerID", "Department", "Salary", "Status",
            "DateOfJoining"]
    second_job = c.where((k % 41 == 0) & (k % 211 != 0)).select(
        k.alias("EmployeeID"), F.col("c_name").alias("Name"),
        F.when(even, F.lit("Female")).otherwise(F.lit("Male")).alias("Gender"),
        F.col("nk").cast("string").alias("ManagerID"),
        F.lit("CONTRACTING").alias("Department"),
        (F.col("bal") + F.lit(100)).alias("Salary"),
        F.lit("Active").alias("Status"),
        F.concat(F.lit("2024"), F.lit("-"), mm, F.lit("-"), dd).alias("DateOfJoining"))
    return (first.select(cols)
            .unionByName(first.where(k % 37 == 0).select(cols))
            .unionByName(second_job.select(cols)))


def raw_finance(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = _table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("k"), "o_custkey", F.col("o_totalprice").alias("amt"),
        F.substring("o_orderpriority", 3, 1 << 30).alias("pri"),
        F.col("o_orderdate").cast("date").cast("string").alias("d"))
    k, d = F.col("k"), F.col("d")
    rows = o.select(
        _case(k, [(97, F.lit(None).cast("bigint")),
                  (101, F.lit(1000000000) + F.col("o_custkey"))],
              F.col("o_custkey")).alias("EmployeeID"),
        _case(k, [(53, F.lit("   ")), (43, F.lit(" travell ")), (47, F.lit("Travel")),
                  (67, _null_s())], F.col("pri")).alias("ExpenseType"),
        F.when(k % 59 == 0, F.lit("abc")).otherwise(F.col("amt").cast("string"))
        .alias("ExpenseAmount"),
        F.when(k % 17 == 0, F.lit("n/a")).otherwise((k % 150).cast("string")).alias("ApprovedBy"),
        _case(k, [(61, F.lit("2023-02-30")),
                  (31, F.concat(F.substring(d, 6, 2), F.lit("/"), F.substring(d, 9, 2),
                                F.lit("/"), F.substring(d, 1, 4)))],
              d).alias("ExpenseDate"),
        k)
    cols = ["EmployeeID", "ExpenseType", "ExpenseAmount", "ApprovedBy", "ExpenseDate"]
    return rows.select(cols).unionByName(rows.where(k % 37 == 0).select(cols))


def raw_operations(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = _table(spark, sf_dir, "events").select(
        F.col("event_id").alias("k"), "event_type", "user_id", "value",
        F.col("ts").cast("date").cast("string").alias("d"))
    k, u = F.col("k"), F.col("user_id") % 6
    dept = (F.when(u == 0, "building").when(u == 1, "FURNITURE ").when(u == 2, "Machinery")
            .when(u == 3, "HOUSEHOLD").when(u == 4, "automobile").otherwise("Facilities"))
    loc4 = k % 4
    location = (F.when(loc4 == 0, "new york").when(loc4 == 1, "o'neil PARK")
                .when(loc4 == 2, "SAN-jose 3rd").otherwise(" boston "))
    rows = e.select(
        _case(k, [(53, F.lit(" ")),
                  (19, F.concat(F.lit(" "), F.col("event_type"), F.lit(" ")))],
              F.col("event_type")).alias("ProcessName"),
        dept.alias("Department"),
        F.when(k % 71 == 0, _null_s()).otherwise(location).alias("Location"),
        F.when(k % 59 == 0, F.lit("n/a")).otherwise(F.col("value").cast("string"))
        .alias("DowntimeHours"),
        F.when(k % 61 == 0, F.lit("unknown")).otherwise(F.col("d")).alias("ProcessDate"),
        k)
    cols = ["ProcessName", "Department", "Location", "DowntimeHours", "ProcessDate"]
    return rows.select(cols).unionByName(rows.where(k % 37 == 0).select(cols))


RAW_BUILDERS = {"hr": raw_hr, "finance": raw_finance, "operations": raw_operations}


def raw_extracts(spark: SparkSession, sf_dir: str) -> dict:
    return {name: build(spark, sf_dir) for name, build in RAW_BUILDERS.items()}


def land_extracts(spark: SparkSession, sf_dir: str, landing_root: str) -> dict:
    """Write the three extracts as Parquet files (S1: extracts land as
    splittable files) and return scans of them with the raw schemas.

    Loads then start from a file scan, as in production. Rows are dealt by a
    hash to at least as many files as the cluster has cores: splits of a
    table's file are of little use where its row groups are large, since a row
    group is read by one task, and the landed files would be as uneven.
    """
    from lodestar.sources.extracts import read_extract, write_extract
    cores = spark.sparkContext.defaultParallelism
    out = {}
    for name, df in raw_extracts(spark, sf_dir).items():
        df = df.repartition(max(cores, df.rdd.getNumPartitions()), *df.columns)
        path = f"{landing_root.rstrip('/')}/{name}"
        write_extract(df, path, "parquet")
        out[name] = read_extract(spark, path, name, "parquet")
    return out
