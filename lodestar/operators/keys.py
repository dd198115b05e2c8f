"""Surrogate keys that are unique, rising, and never renumber old rows.

New rows are numbered 1..n in a caller-given order and shifted by the
table's current maximum. No global window: rows are range-partitioned and
sorted within partitions, ``monotonically_increasing_id`` gives
(partition, position), and a prefix sum over the per-partition row counts -
one row per partition, a proven size bound - turns that into a global rank.
The input is checkpointed (so range sampling does not re-run the joins that
produced it) and so are the laid-out rows (so counts and positions come from
one layout, even when a task is retried on another executor). A load of at
most ``ONE_TASK_ROWS`` new rows, a bound on what one task sorts, is ranked
from the first of these copies in one step.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lodestar.session import checkpoint_root, shuffle_partitions

_POS_BITS = 33
ONE_TASK_ROWS = 200_000


def max_key(df: DataFrame, key_col: str) -> int:
    """Current maximum key (0 for an empty table)."""
    row = df.agg(F.max(key_col).alias("m")).collect()[0]
    return int(row["m"] or 0)


def assign_surrogate_keys(df: DataFrame, key_col: str, order_by, start: int = 0,
                          num_partitions: int | None = None) -> DataFrame:
    """Add ``key_col`` = start + global 1-based rank by ``order_by``
    (ascending, NULLs last). Rows equal in every ordering column are
    interchangeable, so order by all columns for a reproducible result."""
    spark = df.sparkSession
    checkpoint_root(spark)
    parts = num_partitions or shuffle_partitions(spark)
    order = [F.col(c).asc_nulls_last() for c in order_by]
    # Range partitioning samples its input in a job of its own; reading the
    # rows from a checkpoint keeps the upstream joins from running twice.
    src = df.checkpoint()
    if num_partitions is None and src.count() <= ONE_TASK_ROWS:
        rank = F.row_number().over(Window.orderBy(*order))
        return src.select((F.lit(int(start)) + rank).cast("bigint").alias(key_col), *df.columns)
    laid = (src.repartitionByRange(parts, *order)
            .sortWithinPartitions(*order)
            .withColumn("_ls_mid", F.monotonically_increasing_id())
            .checkpoint())
    pid = F.shiftrightunsigned(F.col("_ls_mid"), _POS_BITS)
    pos = F.col("_ls_mid").bitwiseAND(F.lit((1 << _POS_BITS) - 1))
    counts = laid.groupBy(pid.alias("_ls_pid")).agg(F.count(F.lit(1)).alias("_ls_n"))
    before = Window.orderBy("_ls_pid").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(
        "_ls_pid", F.coalesce(F.sum("_ls_n").over(before), F.lit(0)).alias("_ls_off"))
    keyed = laid.join(F.broadcast(offsets), pid == F.col("_ls_pid"))  # one row per partition
    key = (F.lit(int(start)) + F.col("_ls_off") + pos + F.lit(1)).cast("bigint")
    return keyed.select(key.alias(key_col), *[F.col(c) for c in df.columns])
