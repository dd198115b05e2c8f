"""SCD type 2: input (W6), apply (W5) and change report.

The reference walks employees one by one with two point lookups and up to
two writes each. Here one full outer join of the current versions with the
input decides every employee at once:

=========  ===========================================  ========================
branch     condition                                    output
=========  ===========================================  ========================
history    ``iscurrent = 0``                            unchanged
keep       current, and (absent from input or no diff)  unchanged
close      current, in input, diff, started before      ``enddate = as_of``,
           ``as_of``                                    ``iscurrent = 0``
open       in input, and (no current row or diff)       new values, ``startdate =
                                                        as_of``, open
=========  ===========================================  ========================

A second change on the same day replaces the current row (D16). History is
append-only: ``scd2_rows`` gives the new current rows and the rows to append
to history, so a run never rewrites old history.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodestar.functions import as_of_literal, change_text, differs_null_safe, join_changes
from lodestar.operators.joins import last_per_key

# SCD2 columns and the attributes whose change opens a version.
SCD2_COLUMNS = ["employeeid", "name", "gender", "managerid", "startdate", "enddate",
                "iscurrent", "status"]
TRACKED = ("name", "gender", "managerid", "status")


def latest_status(fact_hr: DataFrame, kept: DataFrame | None = None) -> DataFrame:
    """The HR fact of every employee that decides the status: highest date
    key, then highest fact key (D15). With what was ``kept`` from earlier
    facts, only the new ones have to be given."""
    cols = ["employeeid", "datekey", "hrid", "status"]
    rows = fact_hr.select(cols)
    if kept is not None:
        rows = kept.select(cols).unionByName(rows)
    return last_per_key(rows, "employeeid", ["datekey", "hrid"], ["datekey", "hrid", "status"])


def scd2_input(dim_employee: DataFrame, fact_hr: DataFrame | None = None,
               status: DataFrame | None = None) -> DataFrame:
    """Every employee with one status, from the HR facts or from the
    ``status`` that is kept of them. Employees without an HR fact get a NULL
    status."""
    status = latest_status(fact_hr) if status is None else status
    return (dim_employee.select("employeeid", "name", "gender", "managerid")
            .join(status.select("employeeid", "status"), "employeeid", "left"))


def scd2_changes(scd2: DataFrame, incoming: DataFrame, as_of, tracked=TRACKED) -> DataFrame:
    """Ids for which W5 writes something or raises: new ones, those with a
    change, and those whose current version starts after ``as_of``."""
    now = scd2.where(F.col("iscurrent") == 1).select(
        F.col("employeeid").alias("_id"), F.struct(*tracked).alias("_now"),
        (F.col("startdate") > as_of_literal(as_of)).alias("_late"))
    new = incoming.select("employeeid", F.struct(*tracked).alias("_new"))
    return (new.join(now, F.col("employeeid") == F.col("_id"), "full_outer")
            .where(F.col("_late") | F.col("_id").isNull()
                   | F.col("employeeid").isNotNull() & ~F.col("_now").eqNullSafe(F.col("_new")))
            .select(F.coalesce("employeeid", "_id").alias("employeeid")))


def scd2_rows(scd2: DataFrame, incoming: DataFrame, as_of, key: str = "employeeid",
              tracked=TRACKED) -> DataFrame:
    """All current rows after the run (``iscurrent = 1``) and the rows that
    become history in it (``iscurrent = 0``), from one full outer join whose
    every row gives an array of the one or two versions it leads to.

    ``incoming`` must hold one row per key (W6 guarantees it). A current row
    that starts after ``as_of`` raises.
    """
    day = as_of_literal(as_of)
    attrs = [c for c in SCD2_COLUMNS if c not in (key, "startdate", "enddate", "iscurrent")]
    cur = scd2.where(F.col("iscurrent") == 1).select(
        F.col(key).alias("ck"), F.struct("startdate", "enddate", *attrs).alias("c"))
    inc = incoming.select(F.col(key).alias("ik"), F.struct(*attrs).alias("i"))
    j = cur.join(inc, F.col("ck") == F.col("ik"), "full_outer")
    in_c, in_i = F.col("c").isNotNull(), F.col("i").isNotNull()
    start = F.when(in_c & (F.col("c.startdate") > day), F.raise_error(
        F.lit("SCD2 as_of date is before the start of a current version"))) \
        .otherwise(F.col("c.startdate"))
    diff = in_c & in_i & differs_null_safe([(F.col(f"c.{a}"), F.col(f"i.{a}")) for a in tracked])

    def version(side, begin, end, current):
        return F.struct(begin.alias("startdate"), end.cast("date").alias("enddate"),
                        F.lit(current).alias("iscurrent"),
                        *[F.col(f"{side}.{a}").alias(a) for a in attrs])

    keeps = F.when(in_c & ~diff, version("c", F.col("_start"), F.col("c.enddate"), 1))
    opens = F.when(in_i & (~in_c | diff), version("i", day, F.lit(None), 1))
    closes = F.when(diff & (F.col("_start") < day), version("c", F.col("_start"), day, 0))
    return (j.withColumn("_start", start)
            .select(F.coalesce("ck", "ik").alias(key), F.inline(F.filter(
                F.array(keeps, opens, closes), lambda v: v.isNotNull())))
            .select(*SCD2_COLUMNS))


def apply_scd2_full(scd2: DataFrame, incoming: DataFrame, as_of, **kw) -> DataFrame:
    """The whole table after W5: old history, newly closed and current."""
    history = scd2.where(F.col("iscurrent") == 0).select(*SCD2_COLUMNS)
    return history.unionByName(scd2_rows(scd2, incoming, as_of, **kw))


def change_report(scd2: DataFrame, tracked=("name", "gender", "managerid"),
                  key: str = "employeeid") -> DataFrame:
    """Every history version against the current version of the same
    key; one line per version that differs, ``col: old → new`` joined by
    ``; ``, with the current status. NULL-safe (D18)."""
    old = scd2.where(F.col("iscurrent") == 0).select(key, *tracked).alias("o")
    new = scd2.where(F.col("iscurrent") == 1).select(key, *tracked, "status").alias("n")
    j = old.join(new, key)
    parts = [change_text(c, F.col(f"o.{c}"), F.col(f"n.{c}")) for c in tracked]
    return (j.select(F.col(key), join_changes(parts).alias("changes"),
                     F.col("n.status").alias("status"))
            .where(F.col("changes") != ""))
