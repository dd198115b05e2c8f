"""Skew-safe 'one row per key'."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

def _rank_field(c: str, descending: bool, dtype: str) -> list[Column]:
    """Fields whose ascending struct order equals the requested order with
    NULLs last."""
    col = F.col(c)
    flag = col.isNull()
    if not descending:
        return [flag, col]
    if dtype == "date":
        return [flag, -F.unix_date(col)]
    if dtype == "timestamp":
        return [flag, -F.unix_micros(col)]
    if dtype in ("string", "binary", "boolean"):
        raise TypeError(f"descending order on {dtype} column {c!r} is not supported")
    return [flag, -col]


def first_per_key(df: DataFrame, keys, order, payload) -> DataFrame:
    """One row per key: the first under ``order`` [(column, descending)].

    Same answer as ``row_number() OVER (PARTITION BY keys ORDER BY ...) = 1``.
    The first order column (a number or a date) is reduced alone by a hash
    aggregate that combines map-side; only the rows that carry a key's best
    value go on to the min(struct) that settles ties, so text is neither
    sorted nor kept for the other rows. Payload columns take part in the order
    last, so ties resolve to the smallest payload.
    """
    types = dict(df.dtypes)
    head, desc = order[0]
    best = df.groupBy(*keys).agg((F.max if desc else F.min)(head).alias("_head"))
    on = None
    for k in keys:
        best = best.withColumnRenamed(k, f"_k_{k}")
        c = F.col(k).eqNullSafe(F.col(f"_k_{k}"))
        on = c if on is None else on & c
    left = df.join(best, on & F.col(head).eqNullSafe(F.col("_head")), "left_semi")
    fields = []
    for i, (c, d) in enumerate(order):
        for j, f in enumerate(_rank_field(c, d, types[c])):
            fields.append(f.alias(f"o{i}_{j}"))
    payload = [p for p in payload if p not in keys]
    for i, p in enumerate(payload):
        fields.append(F.col(p).isNull().alias(f"pn{i}"))
        fields.append(F.col(p).alias(f"p{i}"))
    one = left.groupBy(*keys).agg(F.min(F.struct(*fields)).alias("_best"))
    return one.select(*keys, *[F.col(f"_best.p{i}").alias(p) for i, p in enumerate(payload)])


def last_per_key(df: DataFrame, key: str, order_cols, value_cols) -> DataFrame:
    """One row per key: the one with the highest ``order_cols``, two
    non-negative integers of which the second is unique. They are compared as
    one decimal, a fixed-width value that a hash aggregate keeps, and the
    values are fetched for the winning rows only."""
    major, minor = order_cols
    scale = F.lit(Decimal(10 ** 19)).cast("decimal(20,0)")
    packed = (F.coalesce(F.col(major), F.lit(0)).cast("decimal(17,0)") * scale
              + F.col(minor).cast("decimal(19,0)")).cast("decimal(38,0)")
    best = (df.where(F.col(key).isNotNull()).select(key, packed.alias("_p"))
            .groupBy(key).agg(F.max("_p").alias("_p"))
            .select((F.col("_p") % scale).cast("bigint").alias("_minor")))
    return (df.join(best, F.col(minor) == F.col("_minor"), "left_semi")
            .select(key, *value_cols))
