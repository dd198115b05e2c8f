"""DuckDB SQL for every registered query (the correctness oracle).

The SQL restates each operator directly - window ``row_number`` for keys and
winners, ``NOT EXISTS`` for anti joins, a plain fan-out join for the finance
KPI - over the same raw derivation, so it checks the Spark plans (range
partitioned keys, min/max-struct winners, pre-aggregated KPIs) against a
straightforward formulation. Views ``customer``, ``orders``, ``events`` ...
are provided by the caller.
"""

from __future__ import annotations

from types import SimpleNamespace as Rules

from lodestar.plans import scenarios as sc

# What each extract's cleaning and each fact's load ask for,
# written out here on their own, so a wrong rule in the operators shows.
CLEAN = {
    "hr": Rules(upper=["Department"], title=[], constant={"Gender": "Unknown"},
                median=["Salary"], number=["ManagerID"], mapping={}, nonblank=[],
                required=["EmployeeID", "Department"], date="DateOfJoining",
                types={"EmployeeID": "bigint", "ManagerID": "int", "Salary": "double",
                       "DateOfJoining": "date"}),
    "finance": Rules(upper=["ExpenseType"], title=[], constant={}, median=[],
                     number=["ExpenseAmount", "ApprovedBy"],
                     mapping={"ExpenseType": ("TRAVELL", "TRAVEL")}, nonblank=["ExpenseType"],
                     required=["EmployeeID", "ExpenseType", "ExpenseAmount"], date="ExpenseDate",
                     types={"EmployeeID": "bigint", "ExpenseAmount": "double",
                            "ApprovedBy": "int", "ExpenseDate": "date"}),
    "operations": Rules(upper=["ProcessName", "Department"], title=["Location"], constant={},
                        median=[], number=["DowntimeHours"], mapping={},
                        nonblank=["ProcessName", "Department", "Location"],
                        required=["ProcessName", "Department", "Location", "DowntimeHours"],
                        date="ProcessDate",
                        types={"DowntimeHours": "double", "ProcessDate": "date"}),
}
FACT_HR = Rules(
    name="fact_hr", key="hrid", date="DateOfJoining", known=None,
    lookups=[("dim_department", "Department", "department", "departmentid")],
    columns=["employeeid", "departmentid", "salary", "status"],
    source=["s.EmployeeID", "departmentid", "s.Salary", "s.Status"],
    load_keys=["employeeid", "datekey"])
FACT_FINANCE = Rules(
    name="fact_finance", key="financeid", date="ExpenseDate", known=("EmployeeID", "dim_employee"),
    lookups=[("dim_expensetype", "ExpenseType", "expensetype", "expensetypeid")],
    columns=["employeeid", "expensetypeid", "expenseamount", "approvedby"],
    source=["s.EmployeeID", "expensetypeid", "s.ExpenseAmount", "s.ApprovedBy"],
    load_keys=["employeeid", "expensetypeid", "datekey"])
FACT_OPERATIONS = Rules(
    name="fact_operations", key="operationsid", date="ProcessDate", known=None,
    lookups=[("dim_process", "ProcessName", "processname", "processid"),
             ("dim_location", "Location", "location", "locationid"),
             ("dim_department", "Department", "department", "departmentid")],
    columns=["processid", "locationid", "departmentid", "downtimehours"],
    source=["processid", "locationid", "departmentid", "s.DowntimeHours"],
    load_keys=["processid", "locationid", "departmentid", "datekey"])

# -- raw extracts (same derivation as lodestar.sources.fixtures) --------------

RAW_HR = """
WITH base AS (
  SELECT c_custkey AS k, c_name, c_mktsegment AS seg, c_nationkey AS nk, c_acctbal AS bal,
         CAST(2015 + c_custkey % 8 AS VARCHAR) AS yy,
         lpad(CAST(1 + c_custkey % 12 AS VARCHAR), 2, '0') AS mm,
         lpad(CAST(1 + c_custkey % 28 AS VARCHAR), 2, '0') AS dd
  FROM customer),
first_row AS (
  SELECT CASE WHEN k % 211 = 0 THEN NULL ELSE k END AS EmployeeID,
         c_name AS Name,
         CASE WHEN k % 13 = 0 THEN NULL WHEN k % 2 = 0 THEN 'Female' ELSE 'Male' END AS Gender,
         CASE WHEN k % 17 = 0 THEN 'n/a' ELSE CAST(nk AS VARCHAR) END AS ManagerID,
         CASE WHEN k % 23 = 0 THEN NULL WHEN k % 19 = 0 THEN concat('  ', lower(seg), ' ')
              ELSE seg END AS Department,
         CASE WHEN k % 11 = 0 THEN NULL ELSE bal END AS Salary,
         CASE WHEN k % 5 = 0 THEN 'Resigned' WHEN k % 7 = 0 THEN 'ACTIVE' ELSE 'Active' END AS Status,
         CASE WHEN k % 29 = 0 THEN 'not a date'
              WHEN k % 31 = 0 THEN concat(mm, '/', dd, '/', yy)
              ELSE concat(yy, '-', mm, '-', dd) END AS DateOfJoining,
         k
  FROM base),
second_job AS (
  SELECT k AS EmployeeID, c_name AS Name,
         CASE WHEN k % 2 = 0 THEN 'Female' ELSE 'Male' END AS Gender,
         CAST(nk AS VARCHAR) AS ManagerID, 'CONTRACTING' AS Department, bal + 100 AS Salary,
         'Active' AS Status, concat('2024', '-', mm, '-', dd) AS DateOfJoining
  FROM base WHERE k % 41 = 0 AND k % 211 <> 0)
SELECT EmployeeID, Name, Gender, ManagerID, Department, Salary, Status, DateOfJoining FROM first_row
UNION ALL
SELECT EmployeeID, Name, Gender, ManagerID, Department, Salary, Status, DateOfJoining
FROM first_row WHERE k % 37 = 0
UNION ALL
SELECT EmployeeID, Name, Gender, ManagerID, Department, Salary, Status, DateOfJoining FROM second_job
"""

RAW_FINANCE = """
WITH base AS (
  SELECT o_orderkey AS k, o_custkey, o_totalprice AS amt, substr(o_orderpriority, 3) AS pri,
         CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS d
  FROM orders),
rows_ AS (
  SELECT CASE WHEN k % 97 = 0 THEN NULL WHEN k % 101 = 0 THEN 1000000000 + o_custkey
              ELSE o_custkey END AS EmployeeID,
         CASE WHEN k % 53 = 0 THEN '   ' WHEN k % 43 = 0 THEN ' travell ' WHEN k % 47 = 0 THEN 'Travel'
              WHEN k % 67 = 0 THEN NULL ELSE pri END AS ExpenseType,
         CASE WHEN k % 59 = 0 THEN 'abc' ELSE CAST(amt AS VARCHAR) END AS ExpenseAmount,
         CASE WHEN k % 17 = 0 THEN 'n/a' ELSE CAST(k % 150 AS VARCHAR) END AS ApprovedBy,
         CASE WHEN k % 61 = 0 THEN '2023-02-30'
              WHEN k % 31 = 0 THEN concat(substr(d, 6, 2), '/', substr(d, 9, 2), '/', substr(d, 1, 4))
              ELSE d END AS ExpenseDate,
         k
  FROM base)
SELECT EmployeeID, ExpenseType, ExpenseAmount, ApprovedBy, ExpenseDate FROM rows_
UNION ALL
SELECT EmployeeID, ExpenseType, ExpenseAmount, ApprovedBy, ExpenseDate FROM rows_ WHERE k % 37 = 0
"""

RAW_OPERATIONS = """
WITH base AS (
  SELECT event_id AS k, event_type, user_id, value, CAST(CAST(ts AS DATE) AS VARCHAR) AS d
  FROM events),
rows_ AS (
  SELECT CASE WHEN k % 53 = 0 THEN ' ' WHEN k % 19 = 0 THEN concat(' ', event_type, ' ')
              ELSE event_type END AS ProcessName,
         CASE user_id % 6 WHEN 0 THEN 'building' WHEN 1 THEN 'FURNITURE ' WHEN 2 THEN 'Machinery'
              WHEN 3 THEN 'HOUSEHOLD' WHEN 4 THEN 'automobile' ELSE 'Facilities' END AS Department,
         CASE WHEN k % 71 = 0 THEN NULL ELSE
           CASE k % 4 WHEN 0 THEN 'new york' WHEN 1 THEN 'o''neil PARK' WHEN 2 THEN 'SAN-jose 3rd'
                ELSE ' boston ' END END AS Location,
         CASE WHEN k % 59 = 0 THEN 'n/a' ELSE CAST(value AS VARCHAR) END AS DowntimeHours,
         CASE WHEN k % 61 = 0 THEN 'unknown' ELSE d END AS ProcessDate,
         k
  FROM base)
SELECT ProcessName, Department, Location, DowntimeHours, ProcessDate FROM rows_
UNION ALL
SELECT ProcessName, Department, Location, DowntimeHours, ProcessDate FROM rows_ WHERE k % 37 = 0
"""

RAW_COLUMNS = {
    "hr": ["EmployeeID", "Name", "Gender", "ManagerID", "Department", "Salary", "Status",
           "DateOfJoining"],
    "finance": ["EmployeeID", "ExpenseType", "ExpenseAmount", "ApprovedBy", "ExpenseDate"],
    "operations": ["ProcessName", "Department", "Location", "DowntimeHours", "ProcessDate"],
}

# -- column expressions ---------------------------------------------------------

# The date layouts in DuckDB spelling, in the order of
# lodestar.functions.dates (optional parts written out).
SQL_DATE_FORMATS = (
    "%Y-%m-%d %H:%M:%S", "%Y-%m-%d", "%Y-%m-%d %H:%M", "%Y-%m-%d %H:%M:%S.%n",
    "%Y-%m-%dT%H:%M", "%Y-%m-%dT%H:%M:%S", "%Y-%m-%dT%H:%M:%S.%n", "%Y/%m/%d", "%Y.%m.%d",
    "%m/%d/%Y", "%d/%m/%Y", "%m/%d/%Y %H:%M", "%m/%d/%Y %H:%M:%S", "%d/%m/%Y %H:%M",
    "%d/%m/%Y %H:%M:%S", "%m/%d/%y", "%d/%m/%y", "%m/%d/%y %H:%M", "%m/%d/%y %H:%M:%S",
    "%d/%m/%y %H:%M", "%d/%m/%y %H:%M:%S", "%m-%d-%Y", "%d-%m-%Y", "%d-%b-%Y", "%d-%b-%y",
    "%b %d, %Y", "%B %d, %Y", "%b %d %Y", "%B %d %Y", "%d %b %Y", "%d %B %Y", "%Y%m%d")
NUMBER_RE = r"^[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?$"


def strip(e: str) -> str:
    return rf"regexp_replace({e}, '^\s+|\s+$', '', 'g')"


def num(e: str) -> str:
    s = strip(f"CAST({e} AS VARCHAR)")
    return (f"(CASE WHEN regexp_full_match({s}, '{NUMBER_RE}') AND NOT isinf(TRY_CAST({s} AS DOUBLE))"
            f" THEN TRY_CAST({s} AS DOUBLE) END)")


def ts(e: str) -> str:
    s = strip(f"CAST({e} AS VARCHAR)")
    return "coalesce(" + ", ".join(f"try_strptime({s}, '{f}')" for f in SQL_DATE_FORMATS) + ")"


def title(e: str) -> str:
    return (rf"array_to_string(list_transform(regexp_extract_all(lower({e}), '(\p{{L}}+|\P{{L}}+)'),"
            rf" lambda t: concat(upper(t[1]), t[2:])), '')")


def date_key(e: str) -> str:
    return f"CAST(strftime({e}, '%Y%m%d') AS INTEGER)"


def exact_total(select: str, keys: str, value: str, alias: str) -> str:
    """Sum of ``value`` by ``keys`` over ``select``: in whole units of 2^-60,
    which the amounts at hand are multiples of, rounded once, half to even."""
    units = f"SELECT {keys}, sum(CAST({value} * pow(2, 60) AS HUGEINT)) AS s FROM ({select}) GROUP BY ALL"
    bits = (f"SELECT *, abs(s) AS a, CAST(pow(2, greatest(0, length(ltrim(bin(abs(s)), '0')) - 53))"
            f" AS HUGEINT) AS p FROM ({units})")
    whole = (f"SELECT *, a // p + CASE WHEN 2 * (a % p) > p OR (2 * (a % p) = p AND (a // p) % 2 = 1)"
             f" THEN 1 ELSE 0 END AS q FROM ({bits})")
    return (f"SELECT {keys}, coalesce(CASE WHEN s < 0 THEN -1.0 ELSE 1.0 END * CAST(q AS DOUBLE)"
            f" * CAST(p AS DOUBLE) / pow(2, 60), 0.0) AS {alias} FROM ({whole})")


def order_by(cols) -> str:
    return ", ".join(f"{c} ASC NULLS LAST" for c in cols)


# -- cleaning -------------------------------------------------------------------

def median_sql(raw: str, col: str) -> str:
    return (f"SELECT (min(v) + max(v)) / 2 AS m FROM ("
            f"SELECT v, row_number() OVER (ORDER BY v) AS rn, count(*) OVER () AS n FROM ("
            f"SELECT CAST({col} AS DOUBLE) AS v FROM {raw} WHERE {col} IS NOT NULL "
            f"AND NOT isnan(CAST({col} AS DOUBLE)))) WHERE rn IN ((n + 1) // 2, (n + 2) // 2)")


def clean_steps(domain: str, raw: str, missing: str = "null", median_cte: str | None = None,
                extra: tuple = ()):
    """(before_dedup_sql, staging_sql) for a domain; ``extra`` columns count
    in the dedup only."""
    spec = CLEAN[domain]
    cols = RAW_COLUMNS[domain] + list(extra)

    def txt(c):
        return f"coalesce(CAST({c} AS VARCHAR), 'nan')" if missing == "literal" \
            else f"CAST({c} AS VARCHAR)"
    ex = {}
    for c in spec.upper:
        ex[c] = f"upper({strip(txt(c))})"
    for c in spec.title:
        ex[c] = title(strip(txt(c)))
    for c, v in spec.constant.items():
        ex[c] = f"coalesce({c}, '{v}')"
    for c in spec.median:
        ex[c] = (f"coalesce(CASE WHEN NOT isnan(CAST({c} AS DOUBLE)) THEN CAST({c} AS DOUBLE) END,"
                 f" (SELECT m FROM {median_cte}))")
    for c in spec.number:
        ex[c] = num(c)
    for c, (old, new) in spec.mapping.items():
        e = ex.get(c, c)
        ex[c] = f"(CASE WHEN {e} = '{old}' THEN '{new}' ELSE {e} END)"
    step1 = "SELECT " + ", ".join(f"{ex.get(c, c)} AS {c}" for c in cols) + f" FROM {raw}"
    conds = [f"({c} IS NULL OR {strip(c)} <> '')" for c in spec.nonblank]
    conds += [f"{c} IS NOT NULL" for c in spec.required]
    step2 = f"SELECT * FROM ({step1}) WHERE " + (" AND ".join(conds) or "TRUE")
    step3 = ("SELECT " + ", ".join(f"{ts(c)} AS {c}" if c == spec.date else c for c in cols)
             + f" FROM ({step2})")
    step3 = f"SELECT * FROM ({step3}) WHERE {spec.date} IS NOT NULL"
    narrowed = []
    for c in RAW_COLUMNS[domain]:
        t = spec.types.get(c)
        if t == "date":
            narrowed.append(f"CAST({c} AS DATE) AS {c}")
        elif t == "int":
            narrowed.append(f"CAST(trunc({c}) AS INTEGER) AS {c}")
        elif t == "bigint":
            narrowed.append(f"CAST({c} AS BIGINT) AS {c}")
        elif t == "double":
            narrowed.append(f"CAST({c} AS DOUBLE) AS {c}")
        else:
            narrowed.append(c)
    staging = f"SELECT {', '.join(narrowed)} FROM (SELECT DISTINCT * FROM ({step3}))"
    return step3, staging


# -- warehouse loads ------------------------------------------------------------

def dim_sql(staging: str, src: str, nk: str, key: str, prev: str | None = None) -> str:
    cand = f"SELECT DISTINCT {src} AS {nk} FROM {staging} WHERE {src} IS NOT NULL"
    if prev is None:
        return (f"SELECT CAST(row_number() OVER (ORDER BY {nk} ASC NULLS LAST) AS BIGINT) AS {key},"
                f" {nk} FROM ({cand})")
    return (f"SELECT {key}, {nk} FROM {prev} UNION ALL "
            f"SELECT CAST((SELECT coalesce(max({key}), 0) FROM {prev}) + "
            f"row_number() OVER (ORDER BY {nk} ASC NULLS LAST) AS BIGINT) AS {key}, {nk} "
            f"FROM ({cand}) WHERE {nk} NOT IN (SELECT {nk} FROM {prev})")


def employee_winner_sql(staging: str) -> str:
    return ("SELECT EmployeeID AS employeeid, Name AS name, Gender AS gender, ManagerID AS managerid"
            " FROM (SELECT *, row_number() OVER (PARTITION BY EmployeeID ORDER BY DateOfJoining DESC"
            " NULLS LAST, Name ASC NULLS LAST, Gender ASC NULLS LAST, ManagerID ASC NULLS LAST) AS rn"
            f" FROM {staging} WHERE EmployeeID IS NOT NULL) WHERE rn = 1")


def scd1_sql(dim: str, winners: str) -> str:
    changed = ("coalesce(d.name <> w.name OR d.gender <> w.gender OR d.managerid <> w.managerid,"
               " false)")
    take = f"(d.employeeid IS NULL OR {changed})"
    return (f"SELECT coalesce(d.employeeid, w.employeeid) AS employeeid, "
            + ", ".join(f"CASE WHEN {take} THEN w.{c} ELSE d.{c} END AS {c}"
                        for c in ("name", "gender", "managerid"))
            + f" FROM {dim} d FULL OUTER JOIN ({winners}) w ON d.employeeid = w.employeeid")


def fact_sql(spec: Rules, staging: str, dims: dict, prev: str | None = None) -> str:
    joins = " ".join(f"JOIN {dims[d]} AS {d} ON {d}.{nk} = s.{src}" for d, src, nk, _ in spec.lookups)
    owner = {key: f"{d}.{key}" for d, _, _, key in spec.lookups}
    sel = [f"{owner.get(e, e)} AS {c}" for c, e in zip(spec.columns, spec.source)]
    sel.append(f"{date_key('s.' + spec.date)} AS datekey")
    where = (f" WHERE s.{spec.known[0]} IN (SELECT employeeid FROM {dims[spec.known[1]]})"
             if spec.known else "")
    cand = f"SELECT {', '.join(sel)} FROM {staging} s {joins}{where}"
    cols = [*spec.columns, "datekey"]
    order = ["datekey"] + [k for k in spec.load_keys if k != "datekey"] + \
        [c for c in spec.columns if c not in spec.load_keys]
    if prev is None:
        new, start = cand, "0"
    else:
        match = " AND ".join(f"p.{k} = c.{k}" for k in spec.load_keys)
        new = f"SELECT * FROM ({cand}) c WHERE NOT EXISTS (SELECT 1 FROM {prev} p WHERE {match})"
        start = f"(SELECT coalesce(max({spec.key}), 0) FROM {prev})"
    keyed = (f"SELECT CAST({start} + row_number() OVER (ORDER BY {order_by(order)}) AS BIGINT)"
             f" AS {spec.key}, {', '.join(cols)} FROM ({new})")
    if prev is None:
        return keyed
    return f"SELECT {spec.key}, {', '.join(cols)} FROM {prev} UNION ALL {keyed}"


SCD2_COLS = ["employeeid", "name", "gender", "managerid", "startdate", "enddate", "iscurrent",
             "status"]
SCD2_ATTRS = ["name", "gender", "managerid", "status"]


def scd2_input_sql(dim: str, fact: str) -> str:
    return (f"SELECT e.employeeid, e.name, e.gender, e.managerid, st.status FROM {dim} e LEFT JOIN "
            f"(SELECT employeeid, status FROM (SELECT employeeid, status, row_number() OVER "
            f"(PARTITION BY employeeid ORDER BY datekey DESC, hrid DESC) AS rn FROM {fact}) "
            f"WHERE rn = 1) st ON e.employeeid = st.employeeid")


def scd2_step_sql(prev: str | None, inp: str, as_of) -> str:
    day = f"DATE '{as_of.isoformat()}'"
    if prev is None:
        return (f"SELECT employeeid, name, gender, managerid, {day} AS startdate, "
                f"CAST(NULL AS DATE) AS enddate, 1 AS iscurrent, status FROM {inp}")
    diff = " OR ".join(f"c.{a} IS DISTINCT FROM i.{a}" for a in SCD2_ATTRS)
    j = (f"SELECT coalesce(c.employeeid, i.employeeid) AS employeeid, "
         + ", ".join(f"c.{a} AS c_{a}, i.{a} AS i_{a}" for a in SCD2_ATTRS)
         + ", c.startdate AS c_start, c.enddate AS c_end, c.employeeid IS NOT NULL AS in_c, "
           "i.employeeid IS NOT NULL AS in_i, "
         + f"(c.employeeid IS NOT NULL AND i.employeeid IS NOT NULL AND ({diff})) AS diff "
         + f"FROM (SELECT * FROM {prev} WHERE iscurrent = 1) c FULL OUTER JOIN {inp} i "
           "ON c.employeeid = i.employeeid")
    c_cols = ", ".join(f"c_{a}" for a in ("name", "gender", "managerid"))
    i_cols = ", ".join(f"i_{a}" for a in ("name", "gender", "managerid"))
    return (f"SELECT {', '.join(SCD2_COLS)} FROM {prev} WHERE iscurrent = 0 "
            f"UNION ALL SELECT employeeid, {c_cols}, c_start, c_end, 1, c_status "
            f"FROM ({j}) WHERE in_c AND NOT diff "
            f"UNION ALL SELECT employeeid, {i_cols}, {day}, CAST(NULL AS DATE), 1, i_status "
            f"FROM ({j}) WHERE in_i AND (NOT in_c OR diff) "
            f"UNION ALL SELECT employeeid, {c_cols}, c_start, {day}, 0, c_status "
            f"FROM ({j}) WHERE diff AND c_start < {day}")


def _ctes(pairs) -> str:
    return "WITH " + ",\n".join(f"{n} AS ({s})" for n, s in pairs)


def base_ctes(missing: str = "null") -> list:
    """Raw extracts through one full load and SCD2 day 1."""
    ctes = [("raw_hr", RAW_HR), ("raw_finance", RAW_FINANCE), ("raw_operations", RAW_OPERATIONS),
            ("hr_med", median_sql("raw_hr", "Salary"))]
    for d in ("hr", "finance", "operations"):
        pre, st = clean_steps(d, f"raw_{d}", missing=missing, median_cte="hr_med")
        ctes += [(f"pre_{d}", pre), (f"staging_{d}", st)]
    ctes += [
        ("dim_department", dim_sql("staging_hr", "Department", "department", "departmentid")),
        ("dim_employee", employee_winner_sql("staging_hr")),
        ("dim_expensetype", dim_sql("staging_finance", "ExpenseType", "expensetype",
                                    "expensetypeid")),
        ("dim_process", dim_sql("staging_operations", "ProcessName", "processname", "processid")),
        ("dim_location", dim_sql("staging_operations", "Location", "location", "locationid")),
    ]
    dims = {n: n for n in ("dim_department", "dim_employee", "dim_expensetype", "dim_process",
                           "dim_location")}
    ctes += [("fact_hr", fact_sql(FACT_HR, "staging_hr", dims)),
             ("fact_finance", fact_sql(FACT_FINANCE, "staging_finance", dims)),
             ("fact_operations", fact_sql(FACT_OPERATIONS, "staging_operations", dims)),
             ("scd2_in", scd2_input_sql("dim_employee", "fact_hr")),
             ("scd2_first", scd2_step_sql(None, "scd2_in", sc.DAY1))]
    return ctes


def with_base(select: str, extra=()) -> str:
    return _ctes(base_ctes() + list(extra)) + "\n" + select


def incremental_ctes() -> list:
    """Load 1 (HR, finance and operations before their cutoffs), then load 2
    with the full extracts."""
    ctes = [
        ("raw_finance_1", f"SELECT * FROM raw_finance WHERE {ts('ExpenseDate')} < "
                          f"TIMESTAMP '{sc.FINANCE_CUTOFF.isoformat()} 00:00:00'"),
        ("raw_operations_1", f"SELECT * FROM raw_operations WHERE {ts('ProcessDate')} < "
                             f"TIMESTAMP '{sc.OPERATIONS_CUTOFF.isoformat()} 00:00:00'"),
    ]
    for d in ("finance", "operations"):
        _, st = clean_steps(d, f"raw_{d}_1")
        ctes.append((f"staging_{d}_1", st))
    ctes += [
        ("dim_expensetype_1", dim_sql("staging_finance_1", "ExpenseType", "expensetype",
                                      "expensetypeid")),
        ("dim_process_1", dim_sql("staging_operations_1", "ProcessName", "processname",
                                  "processid")),
        ("dim_location_1", dim_sql("staging_operations_1", "Location", "location", "locationid")),
        ("dim_department_2", dim_sql("staging_hr", "Department", "department", "departmentid",
                                     prev="dim_department")),
        ("dim_expensetype_2", dim_sql("staging_finance", "ExpenseType", "expensetype",
                                      "expensetypeid", prev="dim_expensetype_1")),
        ("dim_process_2", dim_sql("staging_operations", "ProcessName", "processname", "processid",
                                  prev="dim_process_1")),
        ("dim_location_2", dim_sql("staging_operations", "Location", "location", "locationid",
                                   prev="dim_location_1")),
    ]
    d1 = {"dim_department": "dim_department", "dim_employee": "dim_employee",
          "dim_expensetype": "dim_expensetype_1", "dim_process": "dim_process_1",
          "dim_location": "dim_location_1"}
    d2 = {"dim_department": "dim_department_2", "dim_employee": "dim_employee",
          "dim_expensetype": "dim_expensetype_2", "dim_process": "dim_process_2",
          "dim_location": "dim_location_2"}
    ctes += [
        ("fact_hr_1", fact_sql(FACT_HR, "staging_hr", d1)),
        ("fact_finance_1", fact_sql(FACT_FINANCE, "staging_finance_1", d1)),
        ("fact_operations_1", fact_sql(FACT_OPERATIONS, "staging_operations_1", d1)),
        ("fact_hr_2", fact_sql(FACT_HR, "staging_hr", d2, prev="fact_hr_1")),
        ("fact_finance_2", fact_sql(FACT_FINANCE, "staging_finance", d2, prev="fact_finance_1")),
        ("fact_operations_2", fact_sql(FACT_OPERATIONS, "staging_operations", d2,
                                       prev="fact_operations_1")),
    ]
    return ctes


def drift_ctes() -> list:
    """Ids of 19 digits; finance rows with and without a receipt number."""
    other = {d: ", ".join(c for c in RAW_COLUMNS[d] if c != "EmployeeID") for d in ("hr", "finance")}
    raw = {d: f"SELECT EmployeeID + {sc.DRIFT_ID} AS EmployeeID, {other[d]} FROM raw_{d}" for d in other}
    ctes = [("raw_hr_d", raw["hr"]),
            ("raw_finance_d", f"SELECT *, CAST(NULL AS VARCHAR) AS ReceiptNo FROM ({raw['finance']})"
                              " UNION ALL SELECT *, concat('R-', coalesce(ExpenseAmount, 'none'))"
                              f" FROM ({raw['finance']})"),
            ("staging_hr_d", clean_steps("hr", "raw_hr_d", median_cte="hr_med")[1]),
            ("staging_finance_d", clean_steps("finance", "raw_finance_d", extra=("ReceiptNo",))[1]),
            ("dim_employee_d", employee_winner_sql("staging_hr_d")),
            ("dim_expensetype_d", dim_sql("staging_finance_d", "ExpenseType", "expensetype",
                                          "expensetypeid"))]
    dims = {"dim_employee": "dim_employee_d", "dim_expensetype": "dim_expensetype_d"}
    return ctes + [("fact_finance_d", fact_sql(FACT_FINANCE, "staging_finance_d", dims))]


def scd2_ctes() -> list:
    s = sc
    return [
        ("scd2_in2", "SELECT employeeid, "
                     f"CASE WHEN employeeid % 10 = 0 THEN concat(name, '{s.RENAME_SUFFIX_DAY2}') "
                     "ELSE name END AS name, gender, "
                     "CASE WHEN employeeid % 9 = 0 THEN CAST(NULL AS INTEGER) ELSE managerid END"
                     " AS managerid, CASE WHEN employeeid % 8 = 0 THEN 'Resigned' ELSE status END"
                     " AS status FROM scd2_in"),
        ("scd2_in2b", "SELECT employeeid, "
                      f"CASE WHEN employeeid % 20 = 0 THEN concat(name, '{s.RENAME_SUFFIX_AGAIN}')"
                      " ELSE name END AS name, gender, managerid, status FROM scd2_in2"),
        ("scd2_in3", "SELECT * FROM scd2_in2b WHERE employeeid % 7 <> 0"),
        ("scd2_second", scd2_step_sql("scd2_first", "scd2_in2", s.DAY2)),
        ("scd2_same_day", scd2_step_sql("scd2_second", "scd2_in2b", s.DAY2)),
        ("scd2_missing", scd2_step_sql("scd2_same_day", "scd2_in3", s.DAY3)),
    ]


# -- per-query SQL ----------------------------------------------------------------

def _q_literal_counts() -> str:
    ctes = [("raw_hr", RAW_HR), ("raw_finance", RAW_FINANCE), ("raw_operations", RAW_OPERATIONS),
            ("hr_med", median_sql("raw_hr", "Salary"))]
    parts = []
    for d in ("hr", "finance", "operations"):
        _, st = clean_steps(d, f"raw_{d}", missing="literal", median_cte="hr_med")
        ctes.append((f"lit_{d}", st))
        parts.append(f"SELECT '{d}' AS domain, count(*) AS rows FROM lit_{d}")
    return _ctes(ctes) + "\n" + " UNION ALL ".join(parts)


def _by_raw(source, table, col, parsed) -> str:
    return (f"SELECT '{source}' AS source, raw_value, {parsed} , n FROM (SELECT CAST({col} AS VARCHAR)"
            f" AS raw_value, count(*) AS n FROM {table} GROUP BY 1)")


def _q_lenient_number() -> str:
    p = f"{num('raw_value')} AS value"
    return with_base(" UNION ALL ".join([
        _by_raw("ManagerID", "raw_hr", "ManagerID", p),
        _by_raw("ExpenseAmount", "raw_finance", "ExpenseAmount", p),
        _by_raw("ApprovedBy", "raw_finance", "ApprovedBy", p),
        _by_raw("DowntimeHours", "raw_operations", "DowntimeHours", p)]))


def _q_lenient_date() -> str:
    p = f"CAST({ts('raw_value')} AS DATE) AS parsed"
    return with_base(" UNION ALL ".join([
        _by_raw("DateOfJoining", "raw_hr", "DateOfJoining", p),
        _by_raw("ExpenseDate", "raw_finance", "ExpenseDate", p),
        _by_raw("ProcessDate", "raw_operations", "ProcessDate", p)]))


def _q_dedup_rows() -> str:
    return with_base(" UNION ALL ".join(
        f"SELECT '{d}' AS domain, (SELECT count(*) FROM pre_{d}) AS rows_before, "
        f"(SELECT count(*) FROM (SELECT DISTINCT * FROM pre_{d})) AS rows_after"
        for d in ("hr", "finance", "operations")))


def _month(table_alias="f") -> str:
    return f"CAST(try_strptime(CAST({table_alias}.datekey AS VARCHAR), '%Y%m%d') AS DATE)"


def _q_expense(latest: bool) -> str:
    hr = ("(SELECT employeeid, departmentid FROM (SELECT employeeid, departmentid, row_number() OVER"
          " (PARTITION BY employeeid ORDER BY datekey DESC, hrid DESC) AS rn FROM fact_hr)"
          " WHERE rn = 1)") if latest else "(SELECT employeeid, departmentid FROM fact_hr)"
    return with_base(exact_total(
        f"SELECT strftime(d, '%Y-%m') AS month, dd.department, e.expensetype, f.expenseamount "
        f"FROM (SELECT *, {_month()} AS d FROM fact_finance f) f "
        f"LEFT JOIN dim_expensetype e ON f.expensetypeid = e.expensetypeid "
        f"LEFT JOIN {hr} h ON f.employeeid = h.employeeid "
        f"LEFT JOIN dim_department dd ON h.departmentid = dd.departmentid "
        f"WHERE f.d IS NOT NULL AND dd.department IS NOT NULL AND e.expensetype IS NOT NULL",
        "month, department, expensetype", "expenseamount", "total_expense"))


def star_sql(fact: str, columns: str, *dims: tuple[str, str]) -> str:
    """A fact with the dimensions its foreign keys lead to."""
    return f"SELECT {columns} FROM {fact} " + " ".join(
        f"JOIN {d} USING ({key})" for d, key in dims)


EMPLOYEE, DEPARTMENT = ("dim_employee", "employeeid"), ("dim_department", "departmentid")
VIEW_HR = star_sql(
    "fact_hr", "hrid, employeeid, name, gender, managerid, department, salary, status, datekey",
    EMPLOYEE, DEPARTMENT)
VIEW_FINANCE = star_sql(
    "fact_finance", "financeid, employeeid, name, expensetype, expenseamount, approvedby, datekey",
    EMPLOYEE, ("dim_expensetype", "expensetypeid"))
VIEW_OPERATIONS = star_sql(
    "fact_operations", "operationsid, processname, location, department, downtimehours, datekey",
    ("dim_process", "processid"), ("dim_location", "locationid"), DEPARTMENT)
VIEW_SUPER = (
    "SELECT 'HR' AS Source, hrid AS ID, employeeid, name, gender, managerid, department,"
    " salary AS Amount, status, datekey FROM (" + VIEW_HR + ")"
    " UNION ALL SELECT 'FINANCE', financeid, employeeid, name, CAST(NULL AS VARCHAR),"
    " CAST(NULL AS INTEGER), CAST(NULL AS VARCHAR), expenseamount, CAST(NULL AS VARCHAR), datekey"
    " FROM (" + VIEW_FINANCE + ")"
    " UNION ALL SELECT 'OPERATIONS', operationsid, CAST(NULL AS BIGINT), CAST(NULL AS VARCHAR),"
    " CAST(NULL AS VARCHAR), CAST(NULL AS INTEGER), department, downtimehours,"
    " CAST(NULL AS VARCHAR), datekey FROM (" + VIEW_OPERATIONS + ")")

DOWNTIME = exact_total(
    "SELECT p.processname, dd.department, o.downtimehours FROM fact_operations o LEFT JOIN dim_process p ON"
    " o.processid = p.processid LEFT JOIN dim_department dd ON o.departmentid ="
    " dd.departmentid WHERE p.processname IS NOT NULL AND dd.department IS NOT NULL",
    "processname, department", "downtimehours", "total_downtime")

AUDIT_ORDER = [("dim_department", "dim_department"), ("dim_employee", "dim_employee"),
               ("fact_hr", "fact_hr"), ("dim_expensetype", "dim_expensetype"),
               ("fact_finance", "fact_finance"), ("dim_process", "dim_process"),
               ("dim_location", "dim_location"), ("fact_operations", "fact_operations")]

PKS = [("dim_employee", ["employeeid"], "dim_employee"),
       ("dim_department", ["departmentid"], "dim_department"),
       ("dim_expensetype", ["expensetypeid"], "dim_expensetype"),
       ("dim_process", ["processid"], "dim_process"),
       ("dim_location", ["locationid"], "dim_location"),
       ("fact_hr", ["hrid"], "fact_hr"),
       ("fact_finance", ["financeid"], "fact_finance"),
       ("fact_operations", ["operationsid"], "fact_operations"),
       ("dim_employee_scd2", ["employeeid", "startdate"], "scd2_first")]
FKS = [("fact_hr", "employeeid", "dim_employee", "employeeid"),
       ("fact_hr", "departmentid", "dim_department", "departmentid"),
       ("fact_finance", "employeeid", "dim_employee", "employeeid"),
       ("fact_finance", "expensetypeid", "dim_expensetype", "expensetypeid"),
       ("fact_operations", "processid", "dim_process", "processid"),
       ("fact_operations", "locationid", "dim_location", "locationid"),
       ("fact_operations", "departmentid", "dim_department", "departmentid")]


def _q_change_report() -> str:
    parts = ", ".join(
        f"CASE WHEN o.{c} IS DISTINCT FROM n.{c} THEN concat('{c}: ', "
        f"coalesce(CAST(o.{c} AS VARCHAR), 'NULL'), ' → ', coalesce(CAST(n.{c} AS VARCHAR), 'NULL'))"
        " END" for c in ("name", "gender", "managerid"))
    return with_base(
        f"SELECT employeeid, changes, status FROM (SELECT o.employeeid, concat_ws('; ', {parts})"
        " AS changes, n.status FROM (SELECT * FROM scd2_missing WHERE iscurrent = 0) o"
        " JOIN (SELECT * FROM scd2_missing WHERE iscurrent = 1) n ON o.employeeid = n.employeeid)"
        " WHERE changes <> ''", scd2_ctes())


def _q_audit_listing() -> str:
    """Three loads: what the first put in, what the second added, nothing."""
    before = {"dim_department": "dim_department", "dim_employee": "dim_employee"}
    rows = []
    for load in (1, 2, 3):
        for name, _ in AUDIT_ORDER:
            one, two = before.get(name, f"{name}_1"), f"{name}_2"
            n = {1: f"(SELECT count(*) FROM {one})", 3: "0",
                 2: "0" if name == "dim_employee"
                    else f"(SELECT count(*) FROM {two}) - (SELECT count(*) FROM {one})"}[load]
            rows.append(f"SELECT {len(rows) + 1} AS id, 'INCREMENTAL_INSERT' AS operation_type, "
                        f"'{name}' AS table_name, {n} AS row_count, "
                        f"TIMESTAMP '2024-01-0{load} 12:00:00' AS timestamp")
    return with_base("SELECT *, row_number() OVER (ORDER BY timestamp DESC, id DESC) AS place FROM ("
                     + " UNION ALL ".join(rows) + ")", incremental_ctes())


def _q_dim_date() -> str:
    return with_base(
        "SELECT CAST(strftime(d, '%Y%m%d') AS INTEGER) AS datekey, CAST(d AS DATE) AS full_date,"
        " CAST(year(d) AS INTEGER) AS year, CAST(quarter(d) AS INTEGER) AS quarter,"
        " CAST(month(d) AS INTEGER) AS month, CAST(day(d) AS INTEGER) AS day,"
        " CAST(isodow(d) AS INTEGER) AS isodow, strftime(d, '%Y-%m') AS month_label"
        " FROM (SELECT unnest(generate_series(lo, hi, INTERVAL 1 DAY)) AS d FROM ("
        "SELECT CAST(strptime(CAST(min(k) AS VARCHAR), '%Y%m%d') AS DATE) AS lo,"
        " CAST(strptime(CAST(max(k) AS VARCHAR), '%Y%m%d') AS DATE) AS hi FROM ("
        "SELECT datekey AS k FROM fact_hr UNION ALL SELECT datekey FROM fact_finance"
        " UNION ALL SELECT datekey FROM fact_operations)))")


def _q_literal_load_counts() -> str:
    tables = ["staging_hr", "staging_finance", "staging_operations", "dim_employee",
              "dim_department", "dim_expensetype", "dim_process", "dim_location", "fact_hr",
              "fact_finance", "fact_operations"]
    parts = [f"SELECT '{t}' AS table_name, count(*) AS row_count FROM {t}" for t in tables]
    return _ctes(base_ctes(missing="literal")) + "\n" + " UNION ALL ".join(parts)


def _q_master_load_counts() -> str:
    tables = ["staging_hr", "staging_finance", "staging_operations", "dim_employee",
              "dim_department", "dim_expensetype", "dim_process", "dim_location", "fact_hr",
              "fact_finance", "fact_operations"]
    parts = [f"SELECT '{t}' AS table_name, count(*) AS row_count FROM {t}" for t in tables]
    parts.append("SELECT 'dim_employee_scd2', count(*) FROM scd2_first")
    parts.append("SELECT 'audit_log', CAST(8 AS BIGINT)")
    return with_base(" UNION ALL ".join(parts))


def oracle_sql() -> dict:
    dims_second = " UNION ALL ".join(
        f"SELECT '{n}' AS dimension, {k} AS id, {v} AS value FROM {n}_2"
        for n, k, v in [("dim_department", "departmentid", "department"),
                        ("dim_expensetype", "expensetypeid", "expensetype"),
                        ("dim_process", "processid", "processname"),
                        ("dim_location", "locationid", "location")])
    reload_empty = " UNION ALL ".join(
        f"SELECT '{spec.name}' AS table_name, (SELECT count(*) FROM ("
        f"{fact_sql(spec, st, d2)}) c WHERE NOT EXISTS (SELECT 1 FROM {spec.name}_2 p WHERE "
        + " AND ".join(f"p.{k} = c.{k}" for k in spec.load_keys) + ")) AS inserted"
        for spec, st in [(FACT_HR, "staging_hr"), (FACT_FINANCE, "staging_finance"),
                         (FACT_OPERATIONS, "staging_operations")]
        for d2 in [{"dim_department": "dim_department_2", "dim_employee": "dim_employee",
                    "dim_expensetype": "dim_expensetype_2", "dim_process": "dim_process_2",
                    "dim_location": "dim_location_2"}])
    scd1 = scd1_sql("dim_employee", employee_winner_sql(
        "(SELECT EmployeeID, CASE WHEN EmployeeID % 10 = 0 THEN concat(Name, "
        f"'{sc.SCD1_RENAME_SUFFIX}') ELSE Name END AS Name, Gender, "
        f"coalesce(ManagerID, {sc.SCD1_NULL_MANAGER}) AS ManagerID, Department, Salary, Status,"
        " DateOfJoining FROM staging_hr)"))
    dup = " UNION ALL ".join(
        f"SELECT '{name}' AS table_name, '{','.join(cols)}' AS key_columns, (SELECT count(*) FROM"
        f" (SELECT {', '.join(cols)} FROM {src} GROUP BY {', '.join(cols)} HAVING count(*) > 1))"
        " AS duplicate_keys" for name, cols, src in PKS)
    orph = " UNION ALL ".join(
        f"SELECT '{c}' AS table_name, '{col}' AS column_name, '{p}' AS parent_table,"
        f" (SELECT count(*) FROM {c} x WHERE x.{col} IS NOT NULL AND NOT EXISTS"
        f" (SELECT 1 FROM {p} y WHERE y.{pc} = x.{col})) AS orphan_rows"
        for c, col, p, pc in FKS)
    audit = " UNION ALL ".join(
        f"SELECT CAST({i} AS BIGINT) AS id, 'INCREMENTAL_INSERT' AS operation_type,"
        f" '{t}' AS table_name, (SELECT count(*) FROM {src}) AS row_count"
        for i, (t, src) in enumerate(AUDIT_ORDER, start=1))
    scd2_cols = ", ".join(SCD2_COLS)
    by_gender = ("SELECT e.gender, h.salary FROM fact_hr h JOIN dim_employee e"
                 " ON h.employeeid = e.employeeid WHERE e.gender IS NOT NULL")
    return {
        "clean_hr": with_base("SELECT * FROM staging_hr"),
        "clean_finance": with_base("SELECT * FROM staging_finance"),
        "clean_operations": with_base("SELECT * FROM staging_operations"),
        "clean_literal_counts": _q_literal_counts(),
        "salary_median_fill": with_base("SELECT m AS salary_median FROM hr_med"),
        "title_case": with_base(
            f"SELECT raw_location, {title(strip('raw_location'))} AS location, n FROM ("
            "SELECT Location AS raw_location, count(*) AS n FROM raw_operations GROUP BY 1)"),
        "lenient_number": _q_lenient_number(),
        "lenient_date": _q_lenient_date(),
        "value_map": with_base(
            "SELECT raw_value, CASE WHEN upper(" + strip("raw_value") + ") = 'TRAVELL' THEN 'TRAVEL'"
            " ELSE upper(" + strip("raw_value") + ") END AS expensetype, n FROM ("
            "SELECT ExpenseType AS raw_value, count(*) AS n FROM raw_finance GROUP BY 1)"),
        "dedup_rows": _q_dedup_rows(),
        "dim_department": with_base("SELECT * FROM dim_department"),
        "dim_employee": with_base("SELECT * FROM dim_employee"),
        "dim_expensetype": with_base("SELECT * FROM dim_expensetype"),
        "dim_process": with_base("SELECT * FROM dim_process"),
        "dim_location": with_base("SELECT * FROM dim_location"),
        "dim_second_load": with_base(dims_second, incremental_ctes()),
        "scd1_update": with_base(scd1),
        "fact_hr": with_base("SELECT * FROM fact_hr"),
        "fact_finance": with_base("SELECT * FROM fact_finance"),
        "fact_operations": with_base("SELECT * FROM fact_operations"),
        "fact_second_load": with_base("SELECT * FROM fact_finance_2", incremental_ctes()),
        "fact_reload_empty": with_base(reload_empty, incremental_ctes()),
        # the stream's two runs are the same two finance loads
        "stream_incremental_finance": with_base("SELECT * FROM fact_finance_2",
                                                incremental_ctes()),
        "scd2_first": with_base(f"SELECT {scd2_cols} FROM scd2_first"),
        "scd2_second": with_base(f"SELECT {scd2_cols} FROM scd2_second", scd2_ctes()),
        "scd2_same_day": with_base(f"SELECT {scd2_cols} FROM scd2_same_day", scd2_ctes()),
        "scd2_missing_id": with_base(f"SELECT {scd2_cols} FROM scd2_missing", scd2_ctes()),
        "scd2_change_report": _q_change_report(),
        "kpi_headcount": with_base(
            "SELECT count(DISTINCT CASE WHEN lower(status) = 'active' THEN employeeid END)"
            " AS headcount FROM fact_hr"),
        "kpi_attrition": with_base(
            "SELECT resigned, employees, round(CAST(resigned AS DOUBLE) / CAST(employees AS DOUBLE)"
            " * 100.0, 2) AS attrition_rate FROM (SELECT count(DISTINCT CASE WHEN lower(status) ="
            " 'resigned' THEN employeeid END) AS resigned, count(DISTINCT employeeid) AS employees"
            " FROM fact_hr)"),
        "kpi_salary_by_gender": with_base(
            "SELECT gender, CASE WHEN fact_rows > 0 THEN s / fact_rows END AS avg_salary, fact_rows FROM ("
            + exact_total(by_gender, "gender", "salary", "s") + ") JOIN (SELECT gender, count(salary)"
            f" AS fact_rows FROM ({by_gender}) GROUP BY gender) USING (gender)"),
        "kpi_expense_month_dept_type": _q_expense(latest=False),
        "kpi_expense_latest_assignment": _q_expense(latest=True),
        "kpi_expense_month_type": with_base(exact_total(
            f"SELECT strftime(d, '%Y-%m') AS month, e.expensetype, f.expenseamount FROM (SELECT *, {_month()}"
            " AS d FROM fact_finance f) f LEFT JOIN dim_expensetype e ON f.expensetypeid ="
            " e.expensetypeid WHERE f.d IS NOT NULL AND e.expensetype IS NOT NULL",
            "month, expensetype", "expenseamount", "total_expense")),
        "kpi_downtime": with_base(DOWNTIME),
        "kpi_downtime_sorted": with_base(
            "SELECT *, row_number() OVER (ORDER BY processname, department) AS place"
            f" FROM ({DOWNTIME})"),
        "view_hr": with_base(VIEW_HR),
        "view_finance": with_base(VIEW_FINANCE),
        "view_operations": with_base(VIEW_OPERATIONS),
        "view_super": with_base(VIEW_SUPER),
        "audit_rows": with_base(audit),
        "audit_listing": _q_audit_listing(),
        "view_super_sql": with_base(
            "SELECT Source, count(*) AS n, count(employeeid) AS with_employee, min(datekey)"
            f" AS first_key, max(datekey) AS last_key FROM ({VIEW_SUPER}) GROUP BY Source"),
        "hr_load_alone_scd2": with_base(f"SELECT {scd2_cols} FROM scd2_first"),
        "finance_load_alone": with_base("SELECT * FROM fact_finance"),
        "operations_load_alone": with_base("SELECT * FROM fact_operations"),
        "csv_load_finance": with_base("SELECT * FROM fact_finance"),
        "drift_load_employee": with_base("SELECT * FROM dim_employee_d", drift_ctes()),
        "drift_load_finance": with_base("SELECT * FROM fact_finance_d", drift_ctes()),
        "stream_hr_scd2": with_base(f"SELECT {scd2_cols} FROM scd2_first"),
        "check_orphans": with_base(orph),
        "check_duplicate_keys": with_base(dup),
        "dim_date": _q_dim_date(),
        "master_load_row_counts": _q_master_load_counts(),
        "literal_load_row_counts": _q_literal_load_counts(),
    }
