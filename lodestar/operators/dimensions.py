"""Dimension loads: W3 (new natural keys), W3b + W4 (natural-key dimension
with SCD type 1 update) and W12 (date dimension)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodestar.functions import differs_3valued
from lodestar.operators.joins import first_per_key
from lodestar.operators.keys import assign_surrogate_keys, max_key

OP = "_op"   # marker column: insert / update / keep


def dim_new_members(dim: DataFrame, staging: DataFrame, source_col: str, nk: str,
                    key_col: str, start: int | None = None) -> DataFrame:
    """Distinct, non-NULL natural keys of ``staging`` that ``dim`` lacks,
    numbered after the dimension's current maximum in natural-key order.

    ``NOT IN`` with a NULL natural key in the dimension would block every
    insert; the dimension never stores a NULL key, so a plain anti join on
    non-NULL keys gives the same rows without a null-aware broadcast.
    """
    candidates = (staging.select(F.col(source_col).alias(nk))
                  .where(F.col(nk).isNotNull()).distinct())
    new = candidates.join(dim.select(nk), nk, "left_anti")
    if start is None:
        start = max_key(dim, key_col)
    return assign_surrogate_keys(new, key_col, [nk], start=start).select(key_col, nk)


# How one winner is chosen among several staging rows of one
# employee (latest joining date, then name, gender, manager ascending).
EMPLOYEE_SOURCE = {"employeeid": "EmployeeID", "name": "Name", "gender": "Gender",
                   "managerid": "ManagerID"}
EMPLOYEE_ORDER = [("DateOfJoining", True), ("Name", False), ("Gender", False),
                  ("ManagerID", False)]


def staging_winners(staging: DataFrame, source=None, order=None) -> DataFrame:
    """One staging row per natural key, renamed to dimension columns."""
    source = source or EMPLOYEE_SOURCE
    order = order or EMPLOYEE_ORDER
    nk_dim, nk_src = next(iter(source.items()))
    attrs = [s for d, s in source.items() if d != nk_dim]
    best = first_per_key(staging.where(F.col(nk_src).isNotNull()), [nk_src], order, attrs)
    return best.select(*[F.col(s).alias(d) for d, s in source.items()])


def dim_merge_scd1(dim: DataFrame, staging: DataFrame, source=None, order=None,
                   tracked=("name", "gender", "managerid")) -> DataFrame:
    """W3b + W4 in one full outer join.

    * id only in staging: inserted with the winner's values (``insert``);
    * id in both and ``a <> b OR ...`` is true under SQL NULL logic: the
      tracked columns take the winner's values (``update``) - so a change
      from NULL to a value is *not* seen (D9);
    * otherwise the row is kept.

    Returns the whole new dimension with an ``_op`` marker column.
    """
    source = source or EMPLOYEE_SOURCE
    nk = next(iter(source))
    cols = list(source)
    winners = staging_winners(staging, source, order).withColumn("_in_s", F.lit(True))
    current = dim.select(*cols).withColumn("_in_d", F.lit(True))
    j = current.alias("d").join(winners.alias("s"), nk, "full_outer")
    in_d = F.coalesce(F.col("d._in_d"), F.lit(False))
    in_s = F.coalesce(F.col("s._in_s"), F.lit(False))
    changed = in_d & in_s & differs_3valued([(F.col(f"d.{c}"), F.col(f"s.{c}")) for c in tracked])
    op = F.when(~in_d, F.lit("insert")).when(changed, F.lit("update")).otherwise(F.lit("keep"))
    take_s = ~in_d | changed
    out = [F.col(nk)]
    for c in cols[1:]:
        take = take_s if c in tracked else ~in_d
        out.append(F.when(take, F.col(f"s.{c}")).otherwise(F.col(f"d.{c}")).alias(c))
    return j.select(*out, op.alias(OP))


def date_dimension(*date_keys: DataFrame, key_col: str = "datekey") -> DataFrame:
    """One row per day between the smallest and largest date key of the
    given tables. The span is bounded by the calendar, not by the data."""
    keys = None
    for df in date_keys:
        k = df.select(F.col(key_col).alias("k"))
        keys = k if keys is None else keys.unionByName(k)
    bounds = keys.agg(F.min("k").alias("lo"), F.max("k").alias("hi"))
    days = bounds.select(F.explode(F.sequence(
        F.to_date(F.col("lo").cast("string"), "yyyyMMdd"),
        F.to_date(F.col("hi").cast("string"), "yyyyMMdd"))).alias("full_date"))
    d = F.col("full_date")
    return days.select(
        F.date_format(d, "yyyyMMdd").cast("int").alias("datekey"), d,
        F.year(d).alias("year"), F.quarter(d).alias("quarter"), F.month(d).alias("month"),
        F.dayofmonth(d).alias("day"), (F.weekday(d) + 1).alias("isodow"),
        F.date_format(d, "yyyy-MM").alias("month_label"))
