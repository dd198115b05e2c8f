"""A1: exact median by narrowing histograms.

No value is shuffled or sorted. A pass counts the values by buckets that rise
with the value (combined map-side, so a task sends a row for each bucket it
has met) and keeps each bucket's smallest and largest value; the next pass
reads only the bucket that holds the middle rank, whose bounds are a plain
range filter that reaches the scan. The first buckets are logarithmic, the
further ones cut the range evenly; a bucket of few values is read out. Each
pass leaves about a thousandth of the values, so three read a billion.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

PER_OCTAVE = 64
EVEN_BUCKETS = 4096
FEW = 4096      # distinct values read out at most
_ZERO = 1100    # more octaves than a double has on either side of 1


def _logarithmic(v: Column) -> Column:
    octave = F.least(F.log2(F.abs(v)), F.lit(float(_ZERO)))  # the last for infinite values
    at = F.floor(octave * PER_OCTAVE) + _ZERO * PER_OCTAVE
    return F.when(v == 0, F.lit(0)).when(v > 0, at).otherwise(-at)


def _even(v: Column, lo: float, hi: float) -> Column:
    # halves, since the width of a range may be beyond the largest double
    width = hi / 2 - lo / 2
    return F.floor((v / 2 - lo / 2) / F.lit(width) * EVEN_BUCKETS)


def exact_median(df: DataFrame, column: str, num_partitions: int | None = None):
    """Median of ``column`` skipping NULL and NaN, as a Python float; the mean
    of the two middle values for an even count; ``None`` without values.
    ``num_partitions`` spreads the rows before they are counted."""
    v = F.col("v")
    values = df.select(F.col(column).cast("double").alias("v")).where(v.isNotNull() & ~F.isnan(v))
    if num_partitions:
        values = values.repartition(num_partitions)
    bucket, below, first, last = _logarithmic(v), 0, None, None
    while True:
        rows = (values.groupBy(bucket.alias("b"))
                .agg(F.count(F.lit(1)).alias("n"), F.min("v").alias("lo"), F.max("v").alias("hi"))
                .orderBy("b").collect())
        if first is None:
            total = sum(r["n"] for r in rows)
            if not total:
                return None
            first, last = (total - 1) // 2, total // 2
        for r in rows:
            if first < below + r["n"]:
                break
            below += r["n"]
        if last >= below + r["n"]:  # the middle lies between two buckets
            return (r["hi"] + next(x["lo"] for x in rows if x["b"] > r["b"])) / 2
        if r["lo"] == r["hi"]:
            return r["lo"]
        values = values.where(v.between(r["lo"], r["hi"]))
        if r["n"] <= FEW:
            found = values.groupBy("v").agg(F.count(F.lit(1)).alias("n")).orderBy("v").collect()
            spread = [x["v"] for x in found for _ in range(x["n"])]
            return (spread[first - below] + spread[last - below]) / 2
        bucket = _even(v, r["lo"], r["hi"])


def exact_median_df(df: DataFrame, column: str, alias: str = "median") -> DataFrame:
    """The median as a DataFrame of one row."""
    return df.sparkSession.createDataFrame([(exact_median(df, column),)], f"`{alias}` double")


def approx_median(df: DataFrame, column: str, accuracy: int = 10000):
    """Opt-in approximate median (one pass, bounded memory)."""
    row = df.agg(F.percentile_approx(F.col(column).cast("double"), 0.5, accuracy)
                 .alias("m")).collect()[0]
    return row["m"]
