"""W2 surrogate keys and the skew-safe 'one row per key' helpers."""

from pyspark.sql import Window
from pyspark.sql import functions as F

from lodestar.operators.joins import first_per_key, last_per_key
from lodestar.operators.keys import assign_surrogate_keys


def test_keys_equal_global_row_number(spark):
    # skewed leading column: a third of the rows share a = 0
    rows = [(0 if i % 3 == 0 else i % 97, f"s{i % 13}", i) for i in range(3000)]
    df = spark.createDataFrame(rows, "a int, b string, c int").repartition(7)
    ref = df.withColumn("k", F.row_number().over(Window.orderBy("a", "b", "c")) + 100)
    want = sorted(map(tuple, ref.select(F.col("k").cast("long"), "a", "b", "c").collect()))
    keyed = assign_surrogate_keys(df, "k", ["a", "b", "c"], start=100, num_partitions=5)
    assert keyed.count() == 3000
    assert sorted(map(tuple, keyed.select("k", "a", "b", "c").collect())) == want


def test_keys_nulls_last_and_empty(spark):
    df = spark.createDataFrame([("b",), (None,), ("a",)], "x string")
    got = {r.x: r.k for r in assign_surrogate_keys(df, "k", ["x"]).collect()}
    assert got == {"a": 1, "b": 2, None: 3}
    empty = df.where("x = 'zz'")
    assert assign_surrogate_keys(empty, "k", ["x"], start=9).count() == 0


def test_first_per_key_matches_row_number(spark):
    rows = [(1, "2024-01-02", "b", None), (1, "2024-01-02", "a", 3), (1, "2023-01-01", "a", 1),
            (2, "2020-01-01", None, 1), (2, "2020-01-01", "z", 2)]
    df = spark.createDataFrame(rows, "id int, d string, n string, m int") \
        .withColumn("d", F.to_date("d"))
    got = first_per_key(df, ["id"], [("d", True), ("n", False), ("m", False)], ["n", "m"])
    assert sorted(map(tuple, got.collect())) == [(1, "a", 3), (2, "z", 2)]


def test_last_per_key(spark):
    df = spark.createDataFrame([(1, 20200101, 5, "A"), (1, 20200101, 7, "B"), (1, 20190101, 9, "C")],
                               "id int, dk int, hid int, s string")
    assert [tuple(r) for r in last_per_key(df, "id", ["dk", "hid"], ["s"]).collect()] == [(1, "B")]


def test_small_and_large_loads_are_numbered_alike(spark, monkeypatch):
    from lodestar.operators import keys
    df = spark.range(500).selectExpr("id % 7 as a", "if(id % 5 = 0, null, cast(id % 11 as string)) as b", "id")
    small = sorted(map(tuple, keys.assign_surrogate_keys(df, "k", ["a", "b", "id"], 40).collect()))
    monkeypatch.setattr(keys, "ONE_TASK_ROWS", 10)
    large = sorted(map(tuple, keys.assign_surrogate_keys(df, "k", ["a", "b", "id"], 40).collect()))
    assert small == large and [r[0] for r in small] == list(range(41, 541))
