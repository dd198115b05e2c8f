"""Pipelines L1-L4 over the versioned warehouse.

Each domain load is clean -> stage (written, then read back so cleaning runs
once) -> dimensions -> facts, with one audit event per insert. ``run_all``
does HR, finance, operations and SCD2 in one transaction and commits once,
so a failed run changes nothing (D25). The audit rows are part of the same
commit.
"""

from __future__ import annotations

import datetime as _dt
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodestar.functions import as_of_literal
from lodestar.operators.audit import INCREMENTAL_INSERT, audit_rows
from lodestar.operators.cleaning import SPECS, clean_domain
from lodestar.operators.dimensions import OP, dim_merge_scd1, dim_new_members
from lodestar.operators.facts import (FACT_FINANCE, FACT_HR, FACT_OPERATIONS,
                                      PARTITION_COL, fact_append_rows)
from lodestar.operators.keys import max_key
from lodestar.operators.scd2 import latest_status, scd2_changes, scd2_input, scd2_rows
from lodestar.sources import schemas
from lodestar.sources.store import Transaction, Warehouse, key_bounds, range_of

SCD2_TABLE = "dim_employee_scd2"
STATUS_TABLE = "employee_status"
ROWS_PER_RANGE = 500_000  # of a table split by key, at its first load
MAX_RANGES = 1024


def _table(tx: Transaction, name: str) -> DataFrame:
    return tx.read(name, schemas.WAREHOUSE.get(name) or schemas.STAGING.get(name))


def stage(tx: Transaction, domain: str, raw: DataFrame, missing: str = "null"):
    """S2 + W1: clean the raw extract and refresh its staging table. Returns
    the staging table and the months of the batch, observed during the write
    (a calendar-bounded set) for the fact load to prune with."""
    name = f"staging_{domain}"
    d = F.col(SPECS[domain].dates[0])
    month = F.collect_set(F.year(d) * 100 + F.month(d)).alias("months")
    m = tx.write(name, clean_domain(raw, domain, missing), mode="overwrite", observe=[month])
    return _table(tx, name), sorted(int(x) for x in (m.get("months") or []))


def _max_key(tx, table, key_col):
    known = tx.max_key(table)
    return known if known is not None else max_key(_table(tx, table), key_col)


def _new_dim(tx, events, table, staging, source_col, nk, key_col):
    new = dim_new_members(_table(tx, table), staging, source_col, nk, key_col,
                          start=_max_key(tx, table, key_col))
    m = tx.write(table, new, "append", key_col=key_col)
    events.append((table, INCREMENTAL_INSERT, m["rows"]))


def _fact(tx, events, spec, staging, dim_names, months=None):
    dims = {d: _table(tx, d) for d in dim_names}
    rows = fact_append_rows(staging, _table(tx, spec.name), spec, dims,
                            start=_max_key(tx, spec.name, spec.key_col),
                            months=months)
    m = tx.write(spec.name, rows, "append", partition_by=[PARTITION_COL], key_col=spec.key_col)
    events.append((spec.name, INCREMENTAL_INSERT, m["rows"]))


def _ranges(rows: DataFrame, key: str, bounds: list) -> list:
    """The key ranges that hold a row; as many as the table has at most."""
    if not bounds:
        return [] if rows.isEmpty() else [0]
    found = rows.select(range_of(F.col(key), bounds).alias("r")).distinct().collect()
    return sorted(r["r"] for r in found)


def _employees(tx: Transaction, staging: DataFrame, events: list) -> None:
    """W3b + W4: reads the key ranges of the batch and writes those with a new
    or changed employee."""
    name, key = "dim_employee", "employeeid"
    bounds = tx.bounds(name)
    count = {"inserted": F.count_if(F.col(OP) == "insert"), "updated": F.count_if(F.col(OP) == "update")}
    if bounds is None:
        rows = tx.row_count("staging_hr") or 0
        bounds = key_bounds(staging, "EmployeeID", min(MAX_RANGES, rows // ROWS_PER_RANGE), rows)
        m = tx.write_ranges(name, dim_merge_scd1(_table(tx, name), staging), key, bounds,
                            observe=[c.alias(n) for n, c in count.items()], drop=[OP])
    else:
        at = range_of(F.col("EmployeeID"), bounds)
        near = _ranges(staging.where(F.col("EmployeeID").isNotNull()), "EmployeeID", bounds)
        merged = dim_merge_scd1(tx.read_ranges(name, near), staging)
        changed = (merged.where(F.col(OP) != "keep").groupBy(range_of(F.col(key), bounds).alias("r"))
                   .agg(*[c.alias(n) for n, c in count.items()]).collect())
        m = {n: sum(r[n] for r in changed) for n in count}
        if changed:
            touched = sorted(r["r"] for r in changed)
            again = dim_merge_scd1(tx.read_ranges(name, touched), staging.where(at.isin(touched)))
            tx.write_ranges(name, again, key, bounds, touched, drop=[OP])
            tx.metrics[name] |= m
        else:
            tx.unchanged(name, **m)
    events.append((name, INCREMENTAL_INSERT, m["inserted"]))


def _statuses(tx: Transaction) -> None:
    """Keeps the latest status of every employee: what was kept and the facts
    of this load, in the key ranges they touch. The whole fact is read only if
    nothing is kept yet."""
    key, schema = "employeeid", schemas.EMPLOYEE_STATUS
    bounds = tx.bounds("dim_employee") or []
    if tx.bounds(STATUS_TABLE) is None:
        tx.write_ranges(STATUS_TABLE, latest_status(_table(tx, "fact_hr")), key, bounds)
        return
    new = tx.last_segment("fact_hr")
    if new is None:
        return
    touched = _ranges(new, key, bounds)
    kept = tx.read_ranges(STATUS_TABLE, touched, schema)
    tx.write_ranges(STATUS_TABLE, latest_status(new, kept), key, bounds, touched)


def load_hr(tx: Transaction, staging: DataFrame, events: list, months=None) -> None:
    """L1 (without SCD2): dim_department, dim_employee (+ SCD1), fact_hr and
    the status kept of it."""
    _new_dim(tx, events, "dim_department", staging, "Department", "department", "departmentid")
    _employees(tx, staging, events)
    _fact(tx, events, FACT_HR, staging, ["dim_department"], months)
    _statuses(tx)


def load_finance(tx: Transaction, staging: DataFrame, events: list, months=None) -> None:
    """L2: dim_expensetype, fact_finance (needs dim_employee)."""
    _new_dim(tx, events, "dim_expensetype", staging, "ExpenseType", "expensetype",
             "expensetypeid")
    _fact(tx, events, FACT_FINANCE, staging, ["dim_expensetype", "dim_employee"], months)


def load_operations(tx: Transaction, staging: DataFrame, events: list,
                    months=None) -> None:
    """L3: dim_process, dim_location, fact_operations (needs dim_department)."""
    _new_dim(tx, events, "dim_process", staging, "ProcessName", "processname", "processid")
    _new_dim(tx, events, "dim_location", staging, "Location", "location", "locationid")
    _fact(tx, events, FACT_OPERATIONS, staging,
          ["dim_process", "dim_location", "dim_department"], months)


def run_scd2(tx: Transaction, as_of) -> dict:
    """W6 + W5: the key ranges with a new or changed employee are written
    anew, by ``iscurrent``: the current part replaces the previous one, closed
    versions are appended to history. Versions opened in this run are counted
    while writing."""
    key = "employeeid"
    if tx.bounds(STATUS_TABLE) is None:
        _statuses(tx)
    status = _read_kept(tx)
    incoming = scd2_input(_table(tx, "dim_employee"), status=status)
    opened = F.count(F.when((F.col("iscurrent") == 1) &
                            (F.col("startdate") == as_of_literal(as_of)), 1)).alias("opened")
    bounds, touched = tx.bounds(SCD2_TABLE), None
    if bounds is None:
        bounds = tx.bounds("dim_employee") or []
        current = _table(tx, SCD2_TABLE)
    else:
        touched = _ranges(scd2_changes(_table(tx, SCD2_TABLE), incoming, as_of), key, bounds)
        if not touched:
            return tx.unchanged(SCD2_TABLE, replaced=0, appended=0, opened=0)
        current = tx.read_ranges(SCD2_TABLE, touched)
        dim = tx.read_ranges("dim_employee", touched) if tx.bounds("dim_employee") == bounds \
            else _table(tx, "dim_employee").where(range_of(F.col(key), bounds).isin(touched))
        incoming = scd2_input(dim, status=status)
    return tx.write_ranges(SCD2_TABLE, scd2_rows(current, incoming, as_of), key, bounds, touched,
                           split=("iscurrent", 1, 0), observe=[opened])


def _read_kept(tx: Transaction) -> DataFrame:
    return tx.read(STATUS_TABLE, schemas.EMPLOYEE_STATUS)


# Optional audit operation types for SCD writes.
SCD1_UPDATE, SCD2_CLOSE, SCD2_OPEN = "SCD1_UPDATE", "SCD2_CLOSE", "SCD2_OPEN"


def _scd_events(tx: Transaction) -> list:
    events = []
    emp = tx.metrics.get("dim_employee")
    if emp is not None:
        events.append(("dim_employee", SCD1_UPDATE, emp.get("updated", 0)))
    hist = tx.metrics.get(SCD2_TABLE)
    if hist is not None:
        events.append((SCD2_TABLE, SCD2_CLOSE, hist.get("appended", 0)))
        events.append((SCD2_TABLE, SCD2_OPEN, hist.get("opened", 0)))
    return events


def _audit(tx: Transaction, events: list, stamp=None) -> None:
    first = _max_key(tx, "audit_log", "id") + 1
    tx.write("audit_log", audit_rows(tx.spark, events, first, stamp), "append", key_col="id")


DOMAIN_LOADS = {"hr": load_hr, "finance": load_finance, "operations": load_operations}


DOMAIN_ORDER = ("hr", "finance", "operations")


def run_domains(wh: Warehouse, raw: dict, domains=DOMAIN_ORDER, missing: str = "null",
                as_of=None, scd2: bool = False, stamp=None, parallel: bool = True,
                commit: bool = True, audit_scd: bool = False) -> list:
    """Run the given domain loads (and optionally SCD2) as one commit.
    Returns the audit events, in HR, finance, operations order.

    Only HR must go first: finance needs its dim_employee and operations its
    dim_department. Cleaning of every extract starts at once; after HR,
    finance, operations and SCD2 read only HR's output and write disjoint
    tables, so they are submitted as concurrent Spark jobs from separate
    threads (``parallel=False`` runs them one after another).
    ``commit=False`` does all the work but publishes nothing (a dry run).
    ``audit_scd=True`` also audits SCD1 updates and SCD2 closes/opens (D24);
    by default only the inserts are audited, as in the reference.
    """
    tx = wh.transaction()
    try:
        flat = _run(tx, raw, domains, missing, as_of, scd2, stamp, parallel, audit_scd)
        if commit:
            tx.commit()
        else:
            tx.abandon()
    except BaseException:
        tx.abandon()
        raise
    return flat


def _run(tx: Transaction, raw: dict, domains, missing, as_of, scd2, stamp, parallel,
         audit_scd) -> list:
    order = [d for d in DOMAIN_ORDER if d in domains]
    events: dict = {}

    def load(d, staged):
        st, months = staged.result() if hasattr(staged, "result") else staged
        ev: list = []
        DOMAIN_LOADS[d](tx, st, ev, months)
        return ev

    workers = 4 if parallel else 1
    with ThreadPoolExecutor(max_workers=workers) as pool:
        staged = {d: (pool.submit(stage, tx, d, raw[d], missing) if parallel
                      else None) for d in order}
        if not parallel:
            for d in order:
                events[d] = load(d, stage(tx, d, raw[d], missing))
            if scd2:
                run_scd2(tx, as_of or _dt.date.today())
        else:
            if "hr" in order:
                events["hr"] = load("hr", staged["hr"])
            later = {d: pool.submit(load, d, staged[d]) for d in order if d != "hr"}
            after = pool.submit(run_scd2, tx, as_of or _dt.date.today()) if scd2 else None
            for d, f in later.items():
                events[d] = f.result()
            if after is not None:
                after.result()
    flat = [e for d in order for e in events[d]]
    if audit_scd:
        flat += _scd_events(tx)
    _audit(tx, flat, stamp)
    return flat


def run_hr(wh: Warehouse, raw_hr: DataFrame, as_of=None, **kw) -> list:
    """L1: HR with SCD2 at its end."""
    return run_domains(wh, {"hr": raw_hr}, ("hr",), as_of=as_of, scd2=True, **kw)


def run_finance(wh: Warehouse, raw_finance: DataFrame, **kw) -> list:
    """L2."""
    return run_domains(wh, {"finance": raw_finance}, ("finance",), **kw)


def run_operations(wh: Warehouse, raw_operations: DataFrame, **kw) -> list:
    """L3."""
    return run_domains(wh, {"operations": raw_operations}, ("operations",), **kw)


def run_all(wh: Warehouse, raw: dict, as_of=None, missing: str = "null", stamp=None,
            **kw) -> list:
    """L4: HR -> finance -> operations -> SCD2, one commit."""
    return run_domains(wh, raw, ("hr", "finance", "operations"), missing=missing,
                       as_of=as_of, scd2=True, stamp=stamp, **kw)


def warehouse_tables(wh: Warehouse) -> dict:
    """All warehouse tables as DataFrames (for views, KPIs and checks)."""
    return {name: wh.read(name, schema) for name, schema in schemas.WAREHOUSE.items()}
