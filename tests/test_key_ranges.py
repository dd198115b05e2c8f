"""Loads that change a few employees write a few key ranges."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from lodestar.operators.dimensions import dim_merge_scd1
from lodestar.operators.scd2 import SCD2_COLUMNS, apply_scd2_full, scd2_input
from lodestar.plans import loads
from lodestar.sources import schemas
from lodestar.sources.store import Warehouse, key_bounds, range_of

DAYS = [dt.date(2024, m, 1) for m in (1, 2, 3, 4)]
N = 400
BIG = 1_234_567_890_000_000_000


def hr(spark, rows):
    return spark.createDataFrame([(i, n, "F", str(m), d, 5.0, s, j) for i, n, m, d, s, j in rows], schemas.RAW_HR)


def first_load():
    return [(BIG * (i % 2) + i, f"n{i}", 1, "D" + str(i % 3), "Active", "2020-01-05") for i in range(N)]


@pytest.fixture()
def small_ranges(monkeypatch):
    monkeypatch.setattr(loads, "ROWS_PER_RANGE", 25)


def state(wh, name):
    return sorted(map(tuple, wh.read(name).collect()), key=str)


def segments(wh, name):
    return {s.rsplit("keyrange=", 1)[1]: s for s in wh.tables[name]["segments"] if "iscurrent=0" not in s}


def load(spark, root, rows, day, **kw):
    wh = Warehouse(spark, root)
    loads.run_hr(wh, hr(spark, rows), as_of=day, **kw)
    return Warehouse(spark, root)


def test_a_change_of_clustered_ids_writes_its_ranges_only(spark, tmp_root, small_ranges):
    root = f"{tmp_root}/wh"
    wh1 = load(spark, root, first_load(), DAYS[0])
    assert len(wh1.tables["dim_employee"]["bounds"]) == 15
    before = {n: wh1.read(n).cache() for n in ("dim_employee", "dim_employee_scd2", "fact_hr")}
    for df in before.values():
        df.count()
    # four neighbours: renamed, resigned later, unchanged, new; one older HR fact
    batch = [(2, "renamed", 1, "D2", "Active", "2020-01-05"), (4, "n4", 1, "D1", "Resigned", "2021-01-05"),
             (6, "n6", 1, "D0", "Active", "2020-01-05"), (7, "new", 1, "D0", "Active", "2021-01-05"),
             (8, "n8", 1, "D2", "Resigned", "2019-01-05")]
    wh2 = load(spark, root, batch, DAYS[1])
    for name in ("dim_employee", "dim_employee_scd2", "employee_status"):
        one, two = segments(wh1, name), segments(wh2, name)
        changed = {r for r in two if two[r] != one.get(r)}
        assert one.keys() == two.keys() and 0 < len(changed) <= 2, name
    # the same as a full recompute
    staging = wh2.read("staging_hr")
    dim = dim_merge_scd1(before["dim_employee"], staging).drop("_op")
    assert state(wh2, "dim_employee") == sorted(map(tuple, dim.collect()), key=str)
    full = apply_scd2_full(before["dim_employee_scd2"], scd2_input(dim, wh2.read("fact_hr")), DAYS[1])
    got = wh2.read("dim_employee_scd2").select(*SCD2_COLUMNS)
    assert sorted(map(tuple, got.collect()), key=str) == sorted(map(tuple, full.collect()), key=str)
    history = wh2.read("dim_employee_scd2").where("iscurrent = 0")
    assert sorted(r.employeeid for r in history.collect()) == [2, 4]


def test_a_load_without_changes_writes_nothing(spark, tmp_root, small_ranges):
    root = f"{tmp_root}/wh"
    wh1 = load(spark, root, first_load(), DAYS[0])
    events = loads.run_hr(Warehouse(spark, root), hr(spark, first_load()), as_of=DAYS[1])
    wh2 = Warehouse(spark, root)
    assert [n for _, _, n in events] == [0, 0, 0]
    for name in ("dim_employee", "dim_employee_scd2", "employee_status", "fact_hr"):
        assert wh1.tables[name]["segments"] == wh2.tables[name]["segments"]


def test_later_loads_do_not_read_the_hr_facts_for_scd2(spark, tmp_root, small_ranges, monkeypatch):
    root = f"{tmp_root}/wh"
    load(spark, root, first_load(), DAYS[0])
    read, plans = loads.scd2_rows, []
    monkeypatch.setattr(loads, "scd2_rows", lambda cur, inc, day: plans.append(
        inc._jdf.queryExecution().toString()) or read(cur, inc, day))
    wh = load(spark, root, [(2, "x", 1, "D0", "Resigned", "2022-01-05")], DAYS[1])
    assert plans and "fact_hr" not in plans[0] and "employee_status" in plans[0]
    now = wh.read("dim_employee_scd2").where("employeeid = 2 and iscurrent = 1").first()
    assert (now["name"], now["status"], now["startdate"]) == ("x", "Resigned", DAYS[1])


def test_an_earlier_day_raises_even_without_a_change(spark, tmp_root, small_ranges):
    root = f"{tmp_root}/wh"
    load(spark, root, first_load(), DAYS[2])
    with pytest.raises(Exception, match="before the start"):
        load(spark, root, first_load(), DAYS[1])


def test_ranges_cover_all_keys(spark):
    df = spark.createDataFrame([(i,) for i in [*range(100), 1 << 62, -(1 << 62)]], "k long")
    for n in (0, 1, 2, 7):
        bounds = key_bounds(df, "k", n, 102)
        assert len(bounds) == max(0, n - 1)
        rows = df.select("k", range_of(F.col("k"), bounds).alias("r")).collect()
        assert all(r.r == sum(b <= r.k for b in bounds) for r in rows)
