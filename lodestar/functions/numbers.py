"""Numeric helpers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from lodestar.functions.common import as_col
from lodestar.functions.text import strip

# Plain decimal or scientific notation, optional sign. Spark's own cast also
# accepts '1d', '1f', 'NaN' and 'Infinity'; the guard rejects them.
NUMBER_PATTERN = r"^[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?$"


def lenient_number(c) -> Column:
    """F8: text -> double, NULL when the text is not a finite number."""
    s = strip(as_col(c).cast("string"))
    parsed = F.when(s.rlike(NUMBER_PATTERN), s.try_cast("double"))
    return F.when(F.abs(parsed) != F.lit(float("inf")), parsed)


def percentage(part, whole) -> Column:
    """part / whole * 100; NULL when whole is 0."""
    return F.try_divide(as_col(part).cast("double"), as_col(whole).cast("double")) * F.lit(100.0)
