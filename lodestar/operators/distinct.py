"""Distinct counts of whole-number ids by bitmaps (A2, A3).

Ids fall into buckets of 32,768. A task turns the ids it has seen of a bucket
into one bitmap, so what is shuffled is a bitmap for each task and bucket, not
an id; bitmaps of one bucket are united by OR, across tasks and across loads,
and the count is exact. A bucket takes 4 kB however few ids it has, so ids
that are spread too thin for that (numbers from a hash, say) are kept as sets
of ids instead: which way is decided by the ids' span against their number,
in a pass over that one column.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

THIN = 64  # places of the span per row, above which bitmaps do not pay
LEAST_ID = -(1 << 63)


def is_dense(lo: int | None, hi: int | None, n: int) -> bool:
    """Whether bitmaps of ``n`` ids from ``lo`` to ``hi`` are small."""
    return n == 0 or (hi - lo + 1 <= THIN * n and lo > LEAST_ID)


def dense(df: DataFrame, column: str) -> bool:
    r = df.agg(F.min(column).alias("lo"), F.max(column).alias("hi"), F.count(column).alias("n")).first()
    return is_dense(r["lo"], r["hi"], r["n"])


def bitmaps(df: DataFrame, column: str, wanted: dict[str, Column]) -> DataFrame:
    """(bucket, one bitmap for each name): the ids of the rows for which its
    condition holds. Missing ids are left out. Unite the results of several
    loads with ``united``."""
    place = F.bitmap_bit_position(column)
    return (df.where(F.col(column).isNotNull())
            .groupBy(F.bitmap_bucket_number(column).alias("bucket"))
            .agg(*[F.bitmap_construct_agg(F.when(c, place)).alias(n) for n, c in wanted.items()]))


def united(*parts: DataFrame) -> DataFrame:
    """Bitmaps of several loads as one per bucket."""
    whole = reduce(DataFrame.unionByName, parts)
    return whole.groupBy("bucket").agg(*[F.bitmap_or_agg(c).alias(c) for c in whole.columns if c != "bucket"])


def id_sets(df: DataFrame, column: str, wanted: dict[str, Column]) -> DataFrame:
    """What ``sizes`` counts: bitmaps, or for thin ids one row for each id."""
    if dense(df, column):
        return bitmaps(df, column, wanted)
    return (df.where(F.col(column).isNotNull()).groupBy(column)
            .agg(*[F.max(c.cast("int")).alias(n) for n, c in wanted.items()]))


def sizes(found: DataFrame, names: list[str]) -> DataFrame:
    """One row: how many different ids each name has."""
    kinds = dict(found.dtypes)
    each = {n: F.bitmap_count(n) if kinds[n] == "binary" else F.col(n) for n in names}
    return found.agg(*[F.coalesce(F.sum(c), F.lit(0)).cast("bigint").alias(n) for n, c in each.items()])
