"""Sums of doubles that do not depend on the order of the terms.

A double sum differs in its last digits with the partitioning of the rows. Here
every value goes into the bin of its exponent, 16 binary places wide, and is
cut there into three whole numbers of 24 bits, exactly. Whole numbers add up
the same in any order, map-side and in any number of steps, and may be
multiplied by a count; at the end a group's few bins are added from the
largest down in double-double arithmetic and rounded once.

Bounds: 2^38 rows a group (more raise under ANSI arithmetic). Infinite and
missing values behave as in a plain sum; a group without a value sums to NULL.
Sums below the normal range of doubles may be rounded twice.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BIN = 16      # binary places of a bin
SHIFT = 54    # a bin's unit is 2 ** (BIN * bin - SHIFT): below any bit of its values
PIECE = 24

PIECES = ("_p2", "_p1", "_p0")


def _scaled(x: str, power: str) -> str:
    """x * 2 ** power, in two steps so that no factor overflows."""
    return f"({x} * pow(2D, ({power}) div 2) * pow(2D, ({power}) - ({power}) div 2))"


def binned(df: DataFrame, column: str) -> DataFrame:
    """``df`` with ``column`` (a double) replaced by its parts."""
    others = [f"`{c}`" for c in df.columns if c != column]
    finite = f"abs(`{column}`) < double('Infinity')"  # false for NaN, which is the largest
    at = f"CASE WHEN `{column}` = 0 THEN 0 WHEN {finite} THEN int(floor(log2(abs(`{column}`)) / {BIN})) END"
    df = df.selectExpr(*others, f"`{column}` AS _x", f"{at} AS _bin",
                       f"CASE WHEN NOT ({finite}) THEN `{column}` END AS _odd")
    scaled = _scaled("_x", f"{SHIFT} - {BIN} * _bin")
    df = df.selectExpr(*others, "_bin", "_odd", f"CASE WHEN _bin IS NOT NULL THEN {scaled} END AS _n")
    df = df.selectExpr(*others, "_bin", "_odd", "_n", f"floor(_n / {1 << PIECE}D) AS _q")
    return df.selectExpr(*others, "_bin", "_odd", f"shiftright(_q, {PIECE}) AS _p2",
                         f"_q & {(1 << PIECE) - 1}L AS _p1",
                         f"floor(_n - _q * {1 << PIECE}D) AS _p0")


def added(df: DataFrame, keys: list, times: str | None = None) -> DataFrame:
    """Parts added up by ``keys`` (and bin); each row counts ``times``."""
    n = F.lit(1) if times is None else F.col(times)
    return df.groupBy(*keys, "_bin").agg(*[F.sum(F.col(p) * n).alias(p) for p in PIECES],
                                         F.sum("_odd").alias("_odd"))


def _terms() -> str:
    """A bin ``b`` as doubles that are exact: each piece in two."""
    out = []
    for i, p in enumerate(PIECES):
        power = f"{BIN} * b._bin - {SHIFT} + {PIECE * (2 - i)}"
        out += [_scaled(f"double(shiftright(b.{p}, 31))", f"{power} + 31"),
                _scaled(f"double(b.{p} & {(1 << 31) - 1}L)", power)]
    return ", ".join(out)


# The sum of the bins, from the largest down, as a double and what it lost.
_ROUNDED = f"""aggregate(
  flatten(transform(reverse(array_sort(_bins)), b -> array({_terms()}))),
  named_struct('high', 0D, 'low', 0D),
  (a, x) -> named_struct('high', a.high + x, 'low', a.low
    + ((a.high - ((a.high + x) - ((a.high + x) - a.high))) + (x - ((a.high + x) - a.high)))),
  a -> a.high + a.low)"""


def totals(df: DataFrame, keys: list, alias: str, *more: Column) -> DataFrame:
    """One row per ``keys``: the parts' sum as ``alias``, and ``more``
    aggregates. ``df`` holds few rows a group: parts that were added up by the
    keys, or by ids of which few have one name. A group has 135 bins at most."""
    bins = f"collect_list(CASE WHEN _p0 IS NOT NULL THEN struct(_bin, {', '.join(PIECES)}) END)"
    g = df.groupBy(*keys).agg(F.expr(bins).alias("_bins"), F.sum("_odd").alias("_odd"), *more)
    value = f"CASE WHEN _odd IS NOT NULL THEN _odd WHEN size(_bins) > 0 THEN {_ROUNDED} END AS `{alias}`"
    return g.selectExpr(*[f"`{c}`" for c in g.columns if c not in ("_bins", "_odd")], value)
