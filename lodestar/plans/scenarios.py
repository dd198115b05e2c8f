"""Warehouse states the registered queries read, built from the driver's
tables: one full load, a two-load incremental history, SCD1 and SCD2 days.

Each state is built once per Spark application and source folder under the
shared checkpoint folder, then read by every query that needs it.
"""

from __future__ import annotations

import datetime as _dt
import os
import threading

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lodestar.functions import lenient_timestamp
from lodestar.operators.scd2 import apply_scd2_full, scd2_input
from lodestar.plans.loads import (run_all, run_domains, run_finance, run_hr, run_operations,
                                  warehouse_tables)
from lodestar.session import scratch_path
from lodestar.sources.fixtures import land_extracts
from lodestar.sources.store import Warehouse

# Scenario parameters.
DAY1 = _dt.date(2024, 1, 1)
DAY2 = _dt.date(2024, 2, 1)
DAY3 = _dt.date(2024, 3, 1)
FINANCE_CUTOFF = _dt.date(1998, 1, 1)
OPERATIONS_CUTOFF = _dt.date(2024, 1, 15)
RENAME_SUFFIX_DAY2 = " II"
RENAME_SUFFIX_AGAIN = " III"
SCD1_RENAME_SUFFIX = " Jr"
SCD1_NULL_MANAGER = 5
DRIFT_ID = 1234567890000000000

_lock = threading.RLock()
_built: dict = {}


def _key(spark: SparkSession, sf_dir: str, what: str):
    return (what, spark.sparkContext.applicationId, os.path.abspath(sf_dir))


def _once(spark, sf_dir, what, build):
    k = _key(spark, sf_dir, what)
    with _lock:
        if k not in _built:
            _built[k] = build()
        return _built[k]


def landed_extracts(spark: SparkSession, sf_dir: str) -> dict:
    """The raw extracts derived from the driver's tables, landed once as
    Parquet under the shared folder (see ``land_extracts``)."""
    root = _once(spark, sf_dir, "landing", lambda: scratch_path(spark, "landing"))
    k = _key(spark, sf_dir, "landed")
    with _lock:
        if k not in _built:
            _built[k] = land_extracts(spark, sf_dir, root)
        return dict(_built[k])


def base_warehouse(spark: SparkSession, sf_dir: str) -> Warehouse:
    """One full master load (L4) with SCD2 on DAY1."""
    def build():
        root = scratch_path(spark, "wh-base")
        run_all(Warehouse(spark, root, new=True), landed_extracts(spark, sf_dir), as_of=DAY1,
                stamp=_dt.datetime(2024, 1, 1, 12, 0, 0))
        return root
    return Warehouse(spark, _once(spark, sf_dir, "base", build))


def literal_warehouse(spark: SparkSession, sf_dir: str) -> Warehouse:
    """One full load reading missing text as the literal 'nan' (D1)."""
    def build():
        root = scratch_path(spark, "wh-literal")
        run_all(Warehouse(spark, root, new=True), landed_extracts(spark, sf_dir), as_of=DAY1,
                missing="literal", stamp=_dt.datetime(2024, 1, 1, 12, 0, 0))
        return root
    return Warehouse(spark, _once(spark, sf_dir, "literal", build))


def base_tables(spark: SparkSession, sf_dir: str) -> dict:
    return warehouse_tables(base_warehouse(spark, sf_dir))


def before(df: DataFrame, date_col: str, cutoff) -> DataFrame:
    """Raw rows whose cleaned date is before ``cutoff``."""
    return df.where(lenient_timestamp(date_col) < F.lit(cutoff).cast("timestamp"))


def incremental_root(spark: SparkSession, sf_dir: str) -> str:
    """Load 1: all of HR, finance before FINANCE_CUTOFF, operations before
    OPERATIONS_CUTOFF. Load 2 and load 3: the full extracts. Versions 1-3."""
    def build():
        root = scratch_path(spark, "wh-incr")
        raw = landed_extracts(spark, sf_dir)
        first = {"hr": raw["hr"],
                 "finance": before(raw["finance"], "ExpenseDate", FINANCE_CUTOFF),
                 "operations": before(raw["operations"], "ProcessDate", OPERATIONS_CUTOFF)}
        wh = Warehouse(spark, root, new=True)
        for n, load in enumerate((first, raw, raw), start=1):
            run_domains(wh, load, stamp=_dt.datetime(2024, 1, n, 12, 0, 0))
        return root
    return _once(spark, sf_dir, "incremental", build)


def incremental_tables(spark: SparkSession, sf_dir: str, version: int) -> dict:
    return warehouse_tables(Warehouse(spark, incremental_root(spark, sf_dir), version))


def scd2_day2_input(day1_input: DataFrame) -> DataFrame:
    """Day 2: id % 10 renamed, id % 9 loses its manager, id % 8 resigns."""
    e = F.col("employeeid")
    return day1_input.select(
        "employeeid",
        F.when(e % 10 == 0, F.concat("name", F.lit(RENAME_SUFFIX_DAY2))).otherwise(F.col("name"))
        .alias("name"),
        "gender",
        F.when(e % 9 == 0, F.lit(None).cast("int")).otherwise(F.col("managerid")).alias("managerid"),
        F.when(e % 8 == 0, F.lit("Resigned")).otherwise(F.col("status")).alias("status"))


def scd2_day2_again_input(day2_input: DataFrame) -> DataFrame:
    """Same day again: id % 20 renamed once more."""
    e = F.col("employeeid")
    return day2_input.withColumn(
        "name", F.when(e % 20 == 0, F.concat("name", F.lit(RENAME_SUFFIX_AGAIN)))
        .otherwise(F.col("name")))


def scd2_day3_input(day2_again_input: DataFrame) -> DataFrame:
    """Day 3: ids % 7 are absent from the input."""
    return day2_again_input.where(F.col("employeeid") % 7 != 0)


def scd2_states(spark: SparkSession, sf_dir: str) -> dict:
    """The SCD2 table after day 1, day 2, day 2 again and day 3."""
    t = base_tables(spark, sf_dir)
    in1 = scd2_input(t["dim_employee"], t["fact_hr"])
    first = t["dim_employee_scd2"]
    in2 = scd2_day2_input(in1)
    second = apply_scd2_full(first, in2, DAY2).checkpoint()
    in2b = scd2_day2_again_input(in2)
    same_day = apply_scd2_full(second, in2b, DAY2).checkpoint()
    missing = apply_scd2_full(same_day, scd2_day3_input(in2b), DAY3)
    return {"first": first, "second": second, "same_day": same_day, "missing": missing}


def scd1_staging(staging_hr: DataFrame) -> DataFrame:
    """A second HR staging: id % 10 renamed; every missing manager becomes 5
    (a NULL -> value change that the 3-valued comparison does not see)."""
    e = F.col("EmployeeID")
    return (staging_hr
            .withColumn("Name", F.when(e % 10 == 0, F.concat("Name", F.lit(SCD1_RENAME_SUFFIX)))
                        .otherwise(F.col("Name")))
            .withColumn("ManagerID", F.coalesce(F.col("ManagerID"),
                                                F.lit(SCD1_NULL_MANAGER).cast("int"))))


def streamed_finance_root(spark: SparkSession, sf_dir: str) -> str:
    """HR loaded in full, then finance fed through the file-source stream:
    a first extract file with rows before FINANCE_CUTOFF, a run, then a
    second file with the full extract and another run. Each run loads only
    the file that is new to the stream's checkpoint."""
    from lodestar.sources.extracts import write_extract
    from lodestar.streaming.incremental import load_new_extracts

    def build():
        root = scratch_path(spark, "wh-stream")
        landing = scratch_path(spark, "landing-stream")
        ckpt = scratch_path(spark, "stream-ckpt")
        raw = landed_extracts(spark, sf_dir)
        run_domains(Warehouse(spark, root, new=True), {"hr": raw["hr"]}, ("hr",),
                    stamp=_dt.datetime(2024, 1, 1, 12, 0, 0))
        write_extract(before(raw["finance"], "ExpenseDate", FINANCE_CUTOFF),
                      f"{landing}/batch-1", "parquet")
        load_new_extracts(spark, f"{landing}/*", "finance", root, ckpt)
        write_extract(raw["finance"], f"{landing}/batch-2", "parquet")
        load_new_extracts(spark, f"{landing}/*", "finance", root, ckpt)
        return root
    return _once(spark, sf_dir, "stream", build)


STAMP = _dt.datetime(2024, 1, 1, 12, 0, 0)


def domain_by_domain_root(spark: SparkSession, sf_dir: str) -> str:
    """L1, L2 and L3 run alone, one commit each: HR with SCD2, finance,
    operations."""
    def build():
        root = scratch_path(spark, "wh-domains")
        raw = landed_extracts(spark, sf_dir)
        wh = Warehouse(spark, root, new=True)
        run_hr(wh, raw["hr"], as_of=DAY1, stamp=STAMP)
        run_finance(wh, raw["finance"], stamp=STAMP)
        run_operations(wh, raw["operations"], stamp=STAMP)
        return root
    return _once(spark, sf_dir, "domains", build)


def csv_root(spark: SparkSession, sf_dir: str) -> str:
    """HR by Parquet, then finance from CSV files whose columns stand in
    another order, whose ids are written as decimals (as a column with blanks
    is exported) and which have one column more."""
    from lodestar.sources.extracts import read_extract, write_extract

    def build():
        root, landing = scratch_path(spark, "wh-csv"), scratch_path(spark, "landing-csv")
        raw = landed_extracts(spark, sf_dir)
        wh = Warehouse(spark, root, new=True)
        run_hr(wh, raw["hr"], as_of=DAY1, stamp=STAMP)
        f = raw["finance"]
        shown = f.select(
            *[c for c in reversed(f.columns) if c != "EmployeeID"],
            F.col("EmployeeID").cast("decimal(20,1)").cast("string").alias("EmployeeID"),
            F.concat(F.lit("R-"), F.coalesce("ExpenseAmount", F.lit("none"))).alias("ReceiptNo"))
        write_extract(shown, landing, "csv")
        run_finance(wh, read_extract(spark, landing, "finance", "csv"), stamp=STAMP)
        return root
    return _once(spark, sf_dir, "csv", build)


def streamed_hr_root(spark: SparkSession, sf_dir: str) -> str:
    """HR fed through the file-source stream as one landed extract in several
    files: one load, with SCD2 at its end."""
    from lodestar.sources.extracts import write_extract
    from lodestar.streaming.incremental import load_new_extracts

    def build():
        root, landing = scratch_path(spark, "wh-stream-hr"), scratch_path(spark, "landing-hr")
        write_extract(landed_extracts(spark, sf_dir)["hr"].repartition(3), landing, "parquet")
        load_new_extracts(spark, landing, "hr", root, scratch_path(spark, "ckpt-hr"), as_of=DAY1,
                          stamp=STAMP)
        return root
    return _once(spark, sf_dir, "stream-hr", build)


def drift_root(spark: SparkSession, sf_dir: str) -> str:
    """Landings whose files disagree, with ids of 19 digits: HR in two files,
    ids as text in one and as numbers, beside one column more, in the other;
    finance twice, once without and once with receipt numbers, through the
    file-source stream."""
    from lodestar.sources.extracts import read_extract, write_extract
    from lodestar.streaming.incremental import load_new_extracts

    def build():
        root, landing = scratch_path(spark, "wh-drift"), scratch_path(spark, "landing-drift")
        raw = {d: df.withColumn("EmployeeID", F.col("EmployeeID") + F.lit(DRIFT_ID))
               for d, df in landed_extracts(spark, sf_dir).items() if d != "operations"}
        odd = F.coalesce(F.col("EmployeeID") % 2 == 1, F.lit(False))
        write_extract(raw["hr"].where(~odd).withColumn("EmployeeID", F.col("EmployeeID").cast("string")),
                      f"{landing}/hr/one", "parquet")
        write_extract(raw["hr"].where(odd).withColumn("Badge", F.concat(F.lit("B-"), "Name")),
                      f"{landing}/hr/two", "parquet")
        run_hr(Warehouse(spark, root, new=True), read_extract(spark, f"{landing}/hr/*", "hr", "parquet"),
               as_of=DAY1, stamp=STAMP)
        f = raw["finance"].withColumn("EmployeeID", F.col("EmployeeID").cast("string"))
        write_extract(f, f"{landing}/finance/one", "parquet")
        write_extract(f.withColumn("ReceiptNo", F.concat(F.lit("R-"), F.coalesce("ExpenseAmount", F.lit("none")))),
                      f"{landing}/finance/two", "parquet")
        load_new_extracts(spark, f"{landing}/finance/*", "finance", root,
                          scratch_path(spark, "ckpt-drift"), stamp=STAMP)
        return root
    return _once(spark, sf_dir, "drift", build)
