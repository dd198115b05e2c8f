"""The exact median."""

import math
import random
import statistics

import pytest

from lodestar.operators import stats


def median(spark, values, parts=3):
    return stats.exact_median(spark.createDataFrame([(v,) for v in values], "x double").repartition(parts), "x")


def test_median_of_small_sets(spark):
    for values, want in [([], None), ([None, math.nan], None), ([3.0], 3.0), ([1.0, 2.0], 1.5),
                         ([None, 5.0, math.nan, 1.0, 9.0], 5.0), ([0.0, -0.0, -1.0, 1.0], 0.0),
                         ([-2.0, -4.0, -8.0], -4.0), ([math.inf, 1.0, -math.inf], 1.0),
                         ([1e308, -1e308, 7.0, 8.0], 7.5), ([5e-324, 0.0, -5e-324], 0.0)]:
        assert median(spark, values) == want, values


@pytest.mark.parametrize("seed", range(3))
def test_median_narrows(spark, monkeypatch, seed):
    """With few buckets and nothing read out it still ends at the median."""
    monkeypatch.setattr(stats, "FEW", 1)
    monkeypatch.setattr(stats, "EVEN_BUCKETS", 4)
    monkeypatch.setattr(stats, "PER_OCTAVE", 1)
    rng = random.Random(seed)
    values = [round(rng.lognormvariate(10, 1), 2) for _ in range(300 + seed)] + [12345.67] * (40 * seed)
    assert median(spark, values) == statistics.median(values)


def test_no_value_is_sorted_or_shuffled(spark):
    df = spark.range(100_000).selectExpr("cast(id as double) as x").repartition(4)
    assert stats.exact_median(df, "x") == 49_999.5
    bucket = stats._logarithmic(df["x"])
    assert df.groupBy(bucket).count().count() < 1100  # rows for 100,000 values
