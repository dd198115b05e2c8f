"""Distinct counts by bitmaps."""

import pytest
from pyspark.sql import functions as F

from lodestar.operators import distinct, kpi

KIND = "employeeid bigint, status string"


@pytest.mark.parametrize("ids", [
    [1, 1, 2, 32768, 32769, 65536, 0, -1, -32768, -32769, None, None, 7],      # dense enough with the rest
    [(1 << 63) - 1, -(1 << 63), 5, 5, None, 0],                                # both ends
    [10 ** 18 + 12345 * i for i in range(50)] * 2,                             # thin
    [None], []])
@pytest.mark.parametrize("fill", [0, 3000])
def test_counts_are_exact(spark, ids, fill):
    rows = [(i, "Active" if i is None or i % 3 else "Resigned") for i in ids]
    rows += [(i, s) for i in range(fill) for s in ("ACTIVE", None)]
    df = spark.createDataFrame(rows, KIND).repartition(5)
    known = {i for i, _ in rows if i is not None}
    active = {i for i, s in rows if i is not None and (s or "").lower() == "active"}
    gone = {i for i, s in rows if i is not None and (s or "").lower() == "resigned"}
    assert kpi.headcount(df).first().headcount == len(active)
    r = kpi.attrition(df).first()
    assert (r.resigned, r.employees) == (len(gone), len(known))
    assert r.attrition_rate == (round(len(gone) / len(known) * 100, 2) if known else None)


def test_no_single_id_is_shuffled(spark):
    df = spark.range(200_000).select(F.col("id").alias("employeeid"), F.lit("active").alias("status"))
    assert distinct.dense(df, "employeeid")
    found = distinct.bitmaps(df.repartition(4), "employeeid", {"n": F.lit(True)})
    assert found.count() == 8 and distinct.sizes(found, ["n"]).first().n == 200_000


def test_loads_unite(spark):
    a, b = spark.range(0, 50_000), spark.range(40_000, 90_000)
    parts = [distinct.bitmaps(x, "id", {"n": F.lit(True)}) for x in (a, b)]
    assert distinct.sizes(distinct.united(*parts), ["n"]).first().n == 90_000


@pytest.mark.parametrize("ids", [[1, 2, 3], [5, 5, 5, 9, 40_000, 40_000, 7], [None, None, 3], [None, 3, 3], [],
                                 [10 ** 18, 7, 7, -10 ** 18], [-5, -5, 0, 0, 32768, 65536, 65536]])
def test_duplicate_keys(spark, ids):
    from collections import Counter
    from lodestar.operators.checks import duplicate_keys
    df = spark.createDataFrame([(i, "x") for i in ids], "hrid bigint, other string").repartition(3)
    got = duplicate_keys({"fact_hr": df, "two": df.withColumn("b", F.lit(1))},
                         {"fact_hr": ("hrid",), "two": ("hrid", "b"), "absent": ("x",)})
    want = sum(n > 1 for n in Counter(ids).values())
    assert sorted(map(tuple, got.collect())) == [("fact_hr", "hrid", want), ("two", "hrid,b", want)]
