"""Key and reference checks that the storage does not enforce.

Keys that a load has numbered lie close together. They are checked by bitmaps
of 32,768 keys each: a task sends a bitmap and a count for each bucket it has
met, and since a file holds a run of keys, few tasks share a bucket. A bucket
with as many different keys as rows holds no duplicate; only tables with
another bucket are grouped by key, and of them only these buckets. Natural
keys and keys of several columns are grouped as they are.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Primary keys and foreign keys of the warehouse.
PRIMARY_KEYS = {
    "dim_employee": ("employeeid",),
    "dim_department": ("departmentid",),
    "dim_expensetype": ("expensetypeid",),
    "dim_process": ("processid",),
    "dim_location": ("locationid",),
    "fact_hr": ("hrid",),
    "fact_finance": ("financeid",),
    "fact_operations": ("operationsid",),
    "dim_employee_scd2": ("employeeid", "startdate"),
}
NUMBERED = ("dim_department", "dim_expensetype", "dim_process", "dim_location", "fact_hr",
            "fact_finance", "fact_operations")
FOREIGN_KEYS = [
    ("fact_hr", "employeeid", "dim_employee", "employeeid"),
    ("fact_hr", "departmentid", "dim_department", "departmentid"),
    ("fact_finance", "employeeid", "dim_employee", "employeeid"),
    ("fact_finance", "expensetypeid", "dim_expensetype", "expensetypeid"),
    ("fact_operations", "processid", "dim_process", "processid"),
    ("fact_operations", "locationid", "dim_location", "locationid"),
    ("fact_operations", "departmentid", "dim_department", "departmentid"),
]


def _crowded(tables: dict, keys: dict) -> DataFrame:
    """(name, bucket) of the buckets with fewer different keys than rows; rows
    without a key are a bucket of their own."""
    rows = reduce(DataFrame.unionByName, [
        tables[n].select(F.lit(n).alias("name"), F.col(c).cast("bigint").alias("k")) for n, c in keys.items()])
    return (rows.groupBy("name", F.bitmap_bucket_number("k").alias("bucket"))
            .agg(F.count(F.lit(1)).alias("n"),
                 F.bitmap_count(F.bitmap_construct_agg(F.bitmap_bit_position("k"))).alias("different"))
            .where("n > different").select("name", "bucket"))


def duplicate_keys(tables: dict, keys: dict | None = None, numbered=NUMBERED) -> DataFrame:
    """Per table: number of key values held by more than one row (no key is
    one value). ``numbered``: tables whose key a load has numbered."""
    keys = {n: cols for n, cols in (keys or PRIMARY_KEYS).items() if n in tables}
    spark = next(iter(tables.values())).sparkSession
    dense = {n: cols[0] for n, cols in keys.items() if n in numbered and len(cols) == 1}
    crowded = _crowded(tables, dense) if dense else None
    held = {r["name"] for r in crowded.select("name").distinct().collect()} if dense else set()
    parts, clean = [], []
    for name, cols in keys.items():
        shown = [F.lit(name).alias("table_name"), F.lit(",".join(cols)).alias("key_columns")]
        rows = tables[name]
        if name in dense and name not in held:
            clean.append((name, ",".join(cols), 0))
            continue
        if name in dense:
            buckets = crowded.where(F.col("name") == name).select("bucket")
            rows = rows.join(buckets, F.bitmap_bucket_number(F.col(cols[0]).cast("bigint"))
                             .eqNullSafe(F.col("bucket")), "left_semi")
        dup = (rows.groupBy(*cols).count().where(F.col("count") > 1)
               .agg(F.count(F.lit(1)).alias("duplicate_keys")))
        parts.append(dup.select(*shown, "duplicate_keys"))
    if clean:
        parts.append(spark.createDataFrame(clean, "table_name string, key_columns string, duplicate_keys bigint"))
    return reduce(DataFrame.unionByName, parts)


def orphans(tables: dict, fks=None) -> DataFrame:
    """Per foreign key: child rows whose non-NULL key has no parent.

    One scan of each child counts the values of all its foreign keys (combined
    map-side), so distinct keys, not rows, are joined with the parents' keys,
    in one join for all of them."""
    fks = [f for f in (fks or FOREIGN_KEYS) if f[0] in tables and f[2] in tables]
    spark = next(iter(tables.values())).sparkSession
    counts = [spark.createDataFrame([(c, col, p) for c, col, p, _ in fks],
                                    "table_name string, column_name string, parent_table string")
              .select("*", F.lit(None).cast("bigint").alias("k"), F.lit(0).cast("bigint").alias("n"))]
    for child in dict.fromkeys(f[0] for f in fks):
        keys = F.array(*[F.struct(F.lit(col).alias("column_name"), F.lit(p).alias("parent_table"),
                                  F.col(col).cast("bigint").alias("k"))
                         for c, col, p, _ in fks if c == child])
        counts.append(tables[child].select(F.inline(keys)).where(F.col("k").isNotNull())
                      .groupBy("column_name", "parent_table", "k")
                      .agg(F.count(F.lit(1)).alias("n"))
                      .select(F.lit(child).alias("table_name"), "column_name", "parent_table",
                              "k", "n"))
    parents = reduce(DataFrame.unionByName, [
        tables[p].select(F.lit(p).alias("_p"), F.col(pc).cast("bigint").alias("_k"))
        for p, pc in dict.fromkeys((f[2], f[3]) for f in fks)]).distinct()
    c = reduce(DataFrame.unionByName, counts)
    j = c.join(parents, (F.col("parent_table") == F.col("_p")) & (F.col("k") == F.col("_k")), "left")
    return j.groupBy("table_name", "column_name", "parent_table").agg(
        F.sum(F.when(F.col("_k").isNull(), F.col("n")).otherwise(0)).cast("bigint")
        .alias("orphan_rows"))
