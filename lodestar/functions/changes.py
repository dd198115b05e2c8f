"""Change-description helpers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from lodestar.functions.common import as_col

NULL_TEXT = "NULL"


def differs_3valued(pairs) -> Column:
    """``a <> b OR c <> d ...`` with SQL NULL logic; NULL counts as no."""
    expr = None
    for a, b in pairs:
        term = as_col(a) != as_col(b)
        expr = term if expr is None else (expr | term)
    return F.coalesce(expr, F.lit(False))


def differs_null_safe(pairs) -> Column:
    """Any pair differs, NULL equal to NULL and unequal to a value."""
    expr = None
    for a, b in pairs:
        term = ~as_col(a).eqNullSafe(as_col(b))
        expr = term if expr is None else (expr | term)
    return expr


def change_text(label: str, old, new) -> Column:
    """``label: old → new`` when the values differ, else NULL."""
    o, n = as_col(old), as_col(new)
    text = F.concat(F.lit(f"{label}: "), F.coalesce(o.cast("string"), F.lit(NULL_TEXT)),
                    F.lit(" → "), F.coalesce(n.cast("string"), F.lit(NULL_TEXT)))
    return F.when(~o.eqNullSafe(n), text)


def join_changes(parts, sep: str = "; ") -> Column:
    """join the non-NULL parts."""
    return F.concat_ws(sep, *parts)
