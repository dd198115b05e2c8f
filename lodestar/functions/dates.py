"""Date helpers."""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column
from pyspark.sql import functions as F

from lodestar.functions.common import as_col
from lodestar.functions.text import strip

# The accepted date layouts, by the shape of a value. Month-first
# wins over day-first for an ambiguous value such as 03/04/2023. Two-digit years
# up to 68 are 20xx, the others 19xx. Month names are English, in any case.
#   year first:     yyyy-MM-dd, with HH:mm[:ss[.fraction]] after a space or T
#                   yyyy/MM/dd  yyyy.MM.dd  yyyyMMdd
#   numbers:        M/d/yyyy  d/M/yyyy  M/d/yy  d/M/yy, with H:mm[:ss]
#                   M-d-yyyy  d-M-yyyy
#   month names:    d-MMM-yyyy  d-MMM-yy  MMM d[,] yyyy  d MMM yyyy
#                   and the last two with the full name
MONTHS = ("january", "february", "march", "april", "may", "june", "july", "august", "september",
          "october", "november", "december")
_YEAR = "(?!0000)[0-9]{4}"
_ISO = f"^{_YEAR}" + "-[0-9]{2}-[0-9]{2}(?:[ T][0-9]{2}:[0-9]{2}(?::[0-9]{2}(?:[.][0-9]{1,9})?)?)?$"
_YEAR_FIRST = f"^({_YEAR})" + "([/.]?)([0-9]{2})\\2([0-9]{2})$"
_NUMBERS = "^[0-9]{1,2}[/-][0-9]{1,2}[/-][0-9]"
_TIME = "((?: [0-9]{1,2}:[0-9]{2}(?::[0-9]{2})?)?)$"
_NO_DASH_TIME = "^(?![^ ]*-.* )"
_MONTH_FIRST = _NO_DASH_TIME + "(0?[1-9]|1[0-2])([/-])([0-9]{1,2})\\2" + f"({_YEAR})" + _TIME
_DAY_FIRST = _NO_DASH_TIME + "([0-9]{1,2})([/-])([0-9]{1,2})\\2" + f"({_YEAR})" + _TIME
_SHORT_YEARS = (("20", "(?:[0-5][0-9]|6[0-8])"), ("19", "[0-9]{2}"))
_NAMED = (("^([0-9]{1,2})-([A-Za-z]{3})-" + f"({_YEAR})$", "$3-$2-$1"),
          ("^([A-Za-z]+) ([0-9]{1,2}),? " + f"({_YEAR})$", "$3-$1-$2"),
          ("^([0-9]{1,2}) ([A-Za-z]+) " + f"({_YEAR})$", "$3-$2-$1"))


def _full_year(text: Column, before: str, after: str) -> Column:
    """Two digits between the two patterns become four."""
    for century, digits in _SHORT_YEARS:
        text = F.regexp_replace(text, f"^({before})(?={digits}{after})", f"$1{century}")
    return text


def _from_numbers(s: Column) -> Column:
    s = _full_year(s, "[0-9]{1,2}/[0-9]{1,2}/", "(?: [0-9:]+)?$")
    return F.regexp_replace(F.regexp_replace(s, _MONTH_FIRST, "$4-$1-$3$5"), _DAY_FIRST, "$4-$3-$1$5")


def _from_names(s: Column) -> Column:
    s = _full_year(s, "[0-9]{1,2}-[A-Za-z]{3}-", "$")
    for pattern, fields in _NAMED:
        s = F.regexp_replace(s, pattern, fields)
    parts = F.split(s, "-")  # year, name, day
    name = F.lower(F.try_element_at(parts, F.lit(2)))
    number = F.greatest(F.array_position(F.array(*map(F.lit, MONTHS)), name),
                        F.array_position(F.array(*[F.lit(m[:3]) for m in MONTHS]), name))
    return F.concat_ws("-", F.try_element_at(parts, F.lit(1)), number, F.try_element_at(parts, F.lit(3)))


def lenient_timestamp(c) -> Column:
    """the value's shape decides which layouts can apply; it is rewritten
    year first and parsed once. NULL when no layout fits. No parser is tried
    on a value that it would reject with an exception, and the expression is
    short enough to stay in generated code."""
    s = strip(as_col(c).cast("string"))
    year_first = (F.when(s.rlike(_ISO), s)
                  .when(s.rlike(_NUMBERS), _from_numbers(s))
                  .when(s.rlike(_YEAR_FIRST), F.regexp_replace(s, _YEAR_FIRST, "$1-$3-$4"))
                  .when(s.rlike("[A-Za-z]{3}"), _from_names(s)))
    return year_first.try_cast("timestamp")


def date_key(d) -> Column:
    """date -> integer yyyyMMdd."""
    return F.date_format(as_col(d), "yyyyMMdd").cast("int")


def key_to_date(k) -> Column:
    """integer yyyyMMdd -> date, NULL for an impossible date."""
    return F.to_date(
        F.try_to_timestamp(as_col(k).cast("string"), F.lit("yyyyMMdd")))


def key_month(k) -> Column:
    """Integer yyyyMM of an integer yyyyMMdd key, NULL for an impossible date;
    integer arithmetic only, so a scan pays no text parsing."""
    k = as_col(k).cast("int")
    year, month, day = (k / 10000).cast("int"), (k / 100).cast("int") % 100, k % 100
    leap = ((year % 4 == 0) & (year % 100 != 0)) | (year % 400 == 0)
    days = (F.when(month == 2, F.when(leap, 29).otherwise(28))
            .when(month.isin(4, 6, 9, 11), 30).otherwise(31))
    good = year.between(1000, 9999) & month.between(1, 12) & day.between(1, days)
    return F.when(good, year * 100 + month)


def month_text(m) -> Column:
    """F11 for an integer yyyyMM: text yyyy-MM."""
    t = as_col(m).cast("string")
    return F.concat(F.substring(t, 1, 4), F.lit("-"), F.substring(t, 5, 2))


def month_of(d) -> Column:
    """monthly period as text yyyy-MM."""
    return F.date_format(as_col(d), "yyyy-MM")


def month_key(date_key_col) -> Column:
    """Integer yyyyMM from a yyyyMMdd key; the fact partition column."""
    return (as_col(date_key_col) / F.lit(100)).cast("int")


def as_of_literal(as_of) -> Column:
    """the run date is a parameter, never ``current_date()`` in a plan."""
    if isinstance(as_of, str):
        as_of = _dt.date.fromisoformat(as_of)
    return F.lit(as_of).cast("date")
