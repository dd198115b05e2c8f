"""Sums that do not depend on the order of their terms."""

import math
import random

import pytest
from pyspark.sql import functions as F

from lodestar.operators import sums


def exact(spark, rows, parts=1):
    df = spark.createDataFrame(rows, "k int, x double").repartition(parts)
    out = sums.totals(sums.added(sums.binned(df, "x"), ["k"]), ["k"], "s").collect()
    return {r.k: r.s for r in out}


@pytest.fixture(scope="module")
def values():
    rng = random.Random(6)
    money = [(0, round(rng.uniform(-1e5, 1e6), 2)) for _ in range(3000)]
    wide = [(1, rng.uniform(-1, 1) * 2.0 ** rng.randint(-300, 300)) for _ in range(400)]
    cancel = [(2, s * x) for x in (1e16, 0.1, 3e-9, 7e200, 2.0 ** -60) for s in (1, -1)] + [(2, 0.1), (2, 2.0 ** -70)]
    powers = [(3, math.nextafter(2.0 ** e, way)) for e in range(-40, 41, 8) for way in (0, math.inf)]
    return money + wide + cancel + powers + [(4, 0.0), (4, -0.0), (5, None), (6, 1.0), (6, None)]


def test_sums_are_exact_and_rounded_once(spark, values):
    got = exact(spark, values)
    for k in range(5):
        assert got[k] == math.fsum(x for i, x in values if i == k)
    assert got[5] is None and got[6] == 1.0


def test_sums_do_not_depend_on_the_layout(spark, values):
    one = exact(spark, values)
    for seed, parts in ((1, 1), (2, 3), (3, 64)):
        assert exact(spark, random.Random(seed).sample(values, len(values)), parts) == one


def test_infinite_and_missing_values(spark):
    got = exact(spark, [(0, math.inf), (0, 1.0), (1, math.inf), (1, -math.inf), (2, math.nan), (2, 5.0), (3, -math.inf)])
    assert got[0] == math.inf and math.isnan(got[1]) and math.isnan(got[2]) and got[3] == -math.inf


def test_counted_rows(spark):
    df = spark.createDataFrame([(0, 0.1, 7), (0, 0.2, 3)], "k int, x double, m bigint")
    out = sums.totals(sums.added(sums.binned(df, "x"), ["k"], "m"), ["k"], "s").first()
    assert out.s == math.fsum([0.1] * 7 + [0.2] * 3)


def test_kpis_are_bit_equal_over_layouts(spark):
    from conftest import SF_SMALL
    from lodestar.operators import kpi
    from lodestar.plans import scenarios as sc
    t = sc.base_tables(spark, SF_SMALL)
    for parts in (1, 64):
        fin = t["fact_finance"].repartition(parts, F.rand(parts))
        rows = kpi.expense_by_month_department_type(fin, t["fact_hr"], t["dim_expensetype"], t["dim_department"])
        now = sorted(map(tuple, rows.collect()))
        assert parts == 1 or now == before
        before = now
