"""Text helpers (F1-F6, F13) as built-in Column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from lodestar.functions.common import as_col

# Python's str.strip() removes every character for which str.isspace() is
# true; F.trim removes only spaces. The set is derived by that rule (all
# such characters lie below U+3001).
WHITESPACE = "".join(ch for ch in map(chr, range(0x3001)) if ch.isspace())


def strip(c) -> Column:
    """remove leading and trailing whitespace exactly as Python does.
    ``btrim`` with a character set is a plain codegen'd string scan."""
    return F.btrim(as_col(c), F.lit(WHITESPACE))


def title_case(c) -> Column:
    """Python-style title case, not ``initcap``.

    Every run of letters is capitalised on its own, so ``o'neil`` becomes
    ``O'Neil`` and ``3rd`` becomes ``3Rd``; runs of non-letters pass through.
    """
    runs = F.regexp_extract_all(F.lower(as_col(c)), F.lit(r"(\p{L}+|\P{L}+)"), 1)
    capitalised = F.transform(
        runs, lambda r: F.concat(F.upper(F.substring(r, 1, 1)), F.substring(r, 2, 1 << 30)))
    return F.when(as_col(c).isNull(), F.lit(None).cast("string")) \
        .otherwise(F.array_join(capitalised, ""))


def title_strip(c) -> Column:
    """F1 + F3."""
    return title_case(strip(c))


def text_cast(c, missing: str = "null") -> Column:
    """cast to text.

    ``missing="null"`` (default) keeps a missing value missing so a later
    required-column drop removes it. ``missing="literal"`` reproduces the
    pandas ``astype(str)`` reading in which a missing cell becomes the text
    ``nan`` (and so survives the drop as ``NAN`` / ``Nan``).
    """
    col = as_col(c).cast("string")
    if missing == "literal":
        return F.coalesce(col, F.lit("nan"))
    if missing != "null":
        raise ValueError(f"missing must be 'null' or 'literal', not {missing!r}")
    return col


def value_map(c, mapping: dict) -> Column:
    """whole-value replacement; unmapped values pass through."""
    col = as_col(c)
    if not mapping:
        return col
    expr = None
    for old, new in mapping.items():
        expr = (F.when(col == F.lit(old), F.lit(new)) if expr is None
                else expr.when(col == F.lit(old), F.lit(new)))
    return expr.otherwise(col)


def not_blank(c) -> Column:
    """P6 predicate: text that is not empty after stripping (NULL -> NULL)."""
    return strip(c) != F.lit("")
