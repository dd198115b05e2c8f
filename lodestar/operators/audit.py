"""Audit trail: W9 (append) and W10 (listing)."""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lodestar.sources.schemas import AUDIT_LOG

# The operation type recorded for every insert.
INCREMENTAL_INSERT = "INCREMENTAL_INSERT"


def audit_rows(spark: SparkSession, events, first_id: int, stamp=None) -> DataFrame:
    """One row per (table_name, operation_type, row_count) event, ids
    continuing after ``first_id - 1``; all rows of a run share one stamp.
    A run has a handful of events, so they are built on the driver."""
    stamp = stamp or _dt.datetime.now(_dt.timezone.utc).replace(tzinfo=None)
    rows = [(first_id + i, op, table, int(n), stamp)
            for i, (table, op, n) in enumerate(events)]
    return spark.createDataFrame(rows, AUDIT_LOG)


def audit_listing(audit: DataFrame) -> DataFrame:
    """Newest first."""
    return audit.orderBy(F.col("timestamp").desc(), F.col("id").desc())
