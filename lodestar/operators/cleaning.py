"""Rule-driven cleaning of a raw extract into a staging table.

A ``CleanSpec`` lists column names per rule; ``clean`` applies the rules in
the fixed order that decides the result (text, numbers, value maps, blank
filter, required columns, dates, full-row dedup, narrowing). Everything is a
built-in expression; the only extra job is the median for a median fill.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodestar.functions import (lenient_number, lenient_timestamp, not_blank, strip,
                                text_cast, title_case, value_map)
from lodestar.sources.schemas import RAW
from lodestar.operators.stats import approx_median, exact_median


@dataclass(frozen=True)
class CleanSpec:
    upper_text: tuple = ()          # strip + upper case
    title_text: tuple = ()          # strip + title case
    fill_const: dict = field(default_factory=dict)
    fill_median: tuple = ()         # median of the raw column, before any drop
    lenient_numbers: tuple = ()
    value_maps: dict = field(default_factory=dict)
    nonblank: tuple = ()            # all must be non-blank
    required: tuple = ()            # rows missing any are dropped
    dates: tuple = ()               # parsed; rows that fail are dropped
    narrow: dict = field(default_factory=dict)   # column -> type after dedup


# The rule sets of the three domains.
HR_SPEC = CleanSpec(
    upper_text=("Department",),
    fill_const={"Gender": "Unknown"},
    fill_median=("Salary",),
    lenient_numbers=("ManagerID",),
    required=("EmployeeID", "Department"),
    dates=("DateOfJoining",),
    narrow={"EmployeeID": "bigint", "ManagerID": "int", "Salary": "double",
            "DateOfJoining": "date"},
)
FINANCE_SPEC = CleanSpec(
    upper_text=("ExpenseType",),
    lenient_numbers=("ExpenseAmount", "ApprovedBy"),
    value_maps={"ExpenseType": {"TRAVELL": "TRAVEL"}},
    nonblank=("ExpenseType",),
    required=("EmployeeID", "ExpenseType", "ExpenseAmount"),
    dates=("ExpenseDate",),
    narrow={"EmployeeID": "bigint", "ExpenseAmount": "double", "ApprovedBy": "int",
            "ExpenseDate": "date"},
)
OPERATIONS_SPEC = CleanSpec(
    upper_text=("ProcessName", "Department"),
    title_text=("Location",),
    lenient_numbers=("DowntimeHours",),
    nonblank=("ProcessName", "Department", "Location"),
    required=("ProcessName", "Department", "Location", "DowntimeHours"),
    dates=("ProcessDate",),
    narrow={"DowntimeHours": "double", "ProcessDate": "date"},
)
SPECS = {"hr": HR_SPEC, "finance": FINANCE_SPEC, "operations": OPERATIONS_SPEC}


def medians(raw: DataFrame, spec: CleanSpec, approximate: bool = False) -> dict:
    pick = approx_median if approximate else exact_median
    return {c: pick(raw, c) for c in spec.fill_median}


def clean_before_dedup(raw: DataFrame, spec: CleanSpec, missing: str = "null",
                       fill_values: dict | None = None) -> DataFrame:
    """Steps 1-6: column rules, blank filter, required columns, dates."""
    exprs = {}
    for c in spec.upper_text:
        exprs[c] = F.upper(strip(text_cast(c, missing)))
    for c in spec.title_text:
        exprs[c] = title_case(strip(text_cast(c, missing)))
    for c, v in spec.fill_const.items():
        exprs[c] = F.coalesce(F.col(c), F.lit(v))
    fills = fill_values if fill_values is not None else medians(raw, spec)
    for c in spec.fill_median:
        m = fills.get(c)
        base = F.col(c).cast("double")
        base = F.when(~F.isnan(base), base)
        exprs[c] = base if m is None else F.coalesce(base, F.lit(float(m)))
    for c in spec.lenient_numbers:
        exprs[c] = lenient_number(c)
    for c, mapping in spec.value_maps.items():
        exprs[c] = value_map(exprs.get(c, F.col(c)), mapping)
    df = raw.select([exprs.get(c, F.col(f"`{c}`")).alias(c) for c in raw.columns])
    # A missing value passes the blank test here (as in pandas) and is then
    # removed by the required-column drop when the column is required.
    for c in spec.nonblank:
        df = df.where(F.col(c).isNull() | not_blank(c))
    if spec.required:
        df = df.na.drop(subset=list(spec.required))
    for c in spec.dates:
        df = df.withColumn(c, lenient_timestamp(c)).where(F.col(c).isNotNull())
    return df


def narrow(df: DataFrame, columns, spec: CleanSpec) -> DataFrame:
    """Step 8: the staging columns in their types; timestamps become dates
    and columns that are never loaded go here, after the dedup (D3, P8)."""
    out = []
    for c in columns:
        t = spec.narrow.get(c)
        if t == "date":
            out.append(F.to_date(F.col(c)).alias(c))
        elif t:
            out.append(F.col(c).cast(t).alias(c))
        else:
            out.append(F.col(c))
    return df.select(out)


def clean(raw: DataFrame, spec: CleanSpec, missing: str = "null",
          fill_values: dict | None = None, columns=None) -> DataFrame:
    """Raw extract -> staging rows (W1); ``columns`` are those to be loaded. Dedup is a distinct aggregate with a
    map-side partial step, so a large group of copies collapses before the
    shuffle."""
    df = clean_before_dedup(raw, spec, missing, fill_values).dropDuplicates()
    return narrow(df, columns or raw.columns, spec)


def clean_domain(raw: DataFrame, domain: str, missing: str = "null",
                 fill_values: dict | None = None) -> DataFrame:
    return clean(raw, SPECS[domain], missing, fill_values, RAW[domain].fieldNames())
