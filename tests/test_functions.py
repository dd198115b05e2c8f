"""Unit edge tables for the column helpers (FIXTURES.md §5)."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from lodestar.functions import (change_text, date_key, differs_3valued, differs_null_safe,
                                join_changes, key_to_date, lenient_number, lenient_timestamp,
                                strip, title_case, value_map)


def one_col(spark, values, fn, t="string"):
    df = spark.createDataFrame([(v,) for v in values], f"x {t}")
    return [r[0] for r in df.select(fn(F.col("x"))).collect()]


def test_title_case(spark):
    got = one_col(spark, ["o'neil new-york 3rd AVE", "são paulo", None, "SAN-jose 3rd"],
                  title_case)
    assert got == ["O'Neil New-York 3Rd Ave", "São Paulo", None, "San-Jose 3Rd"]
    # same as Python on plain Latin text
    for s in ["o'neil new-york 3rd AVE", "hello WORLD", "x1y2z"]:
        assert one_col(spark, [s], title_case) == [s.title()]


def test_strip_matches_python(spark):
    samples = ["  a b  ", "\t\nx\r\n", "　y ", "\x1cz\x1f", "", "   ", "no"]
    assert one_col(spark, samples, strip) == [s.strip() for s in samples]


def test_lenient_number(spark):
    good = {"1e3": 1000.0, " 12 ": 12.0, ".5": 0.5, "-5": -5.0, "+7.25": 7.25, "5.": 5.0}
    bad = ["1d", "1f", "nan", "inf", "0x10", "1,000", "1_000", "abc", "", "1e999", None]
    got = one_col(spark, list(good) + bad, lenient_number)
    assert got[:len(good)] == list(good.values())
    assert got[len(good):] == [None] * len(bad)


@pytest.mark.parametrize("text", ["2023-01-15", "01/15/2023", "15/01/2023", "15-Jan-2023",
                                  "Jan 15, 2023", "20230115", "2023/01/15", "15 January 2023",
                                  " 2023-01-15 ", "2023-01-15 00:00:00"])
def test_lenient_date_layouts(spark, text):
    got = one_col(spark, [text], lambda c: F.to_date(lenient_timestamp(c)))
    assert got == [dt.date(2023, 1, 15)]


def test_lenient_date_ambiguous_and_bad(spark):
    got = one_col(spark, ["03/04/2023", "2023-02-30", "2023-13-01", "not a date", "", None],
                  lambda c: F.to_date(lenient_timestamp(c)))
    assert got == [dt.date(2023, 3, 4), None, None, None, None, None]


def test_date_keys(spark):
    df = spark.createDataFrame([(dt.date(2023, 1, 5), 20230230), (None, 20230105)],
                               "d date, k int")
    rows = df.select(date_key("d").alias("a"), key_to_date("k").alias("b")).collect()
    assert [tuple(r) for r in rows] == [(20230105, None), (None, dt.date(2023, 1, 5))]


def test_value_map_whole_value(spark):
    got = one_col(spark, ["TRAVELL", "TRAVELLER", None, "X"],
                  lambda c: value_map(c, {"TRAVELL": "TRAVEL"}))
    assert got == ["TRAVEL", "TRAVELLER", None, "X"]


def test_differs_three_valued_vs_null_safe(spark):
    df = spark.createDataFrame([(None, 5), (1, 1), (1, 2), (None, None)], "a int, b int")
    rows = df.select(differs_3valued([("a", "b")]).alias("p12"),
                     differs_null_safe([("a", "b")]).alias("p13")).collect()
    assert [tuple(r) for r in rows] == [(False, True), (False, False), (True, True),
                                        (False, False)]


def test_change_text(spark):
    df = spark.createDataFrame([("a", "b", 1, None), ("a", "a", 1, 1)],
                               "n1 string, n2 string, m1 int, m2 int")
    out = df.select(join_changes([change_text("name", "n1", "n2"),
                                  change_text("managerid", "m1", "m2")]).alias("c")).collect()
    assert [r.c for r in out] == ["name: a → b; managerid: 1 → NULL", ""]
