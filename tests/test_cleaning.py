"""W1 goldens (FIXTURES.md §3) and aggregate edge cases."""

import pytest

from conftest import SF_SMALL
from lodestar.operators.cleaning import SPECS, clean_domain, medians
from lodestar.operators.kpi import expense_by_month_type
from lodestar.operators.stats import exact_median
from lodestar.sources.fixtures import raw_extracts


@pytest.fixture(scope="module")
def raw(spark):
    return raw_extracts(spark, SF_SMALL)


def test_raw_counts(raw):
    assert {k: v.count() for k, v in raw.items()} == {
        "hr": 158, "finance": 1541, "operations": 1028}


def test_median_of_raw_salary(raw):
    assert medians(raw["hr"], SPECS["hr"]) == {"Salary": pytest.approx(4353.24)}


@pytest.mark.parametrize("missing,expected", [
    ("null", {"hr": 141, "finance": 1385, "operations": 935}),
    ("literal", {"hr": 147, "finance": 1407, "operations": 949}),
])
def test_staging_counts(raw, missing, expected):
    got = {d: clean_domain(raw[d], d, missing=missing).count() for d in raw}
    assert got == expected


def test_clean_locations(raw):
    locs = {r[0] for r in clean_domain(raw["operations"], "operations")
            .select("Location").distinct().collect()}
    assert locs == {"Boston", "New York", "O'Neil Park", "San-Jose 3Rd"}
    lit = {r[0] for r in clean_domain(raw["operations"], "operations", missing="literal")
           .select("Location").distinct().collect()}
    assert lit == locs | {"Nan"}


def test_staging_types(raw):
    st = clean_domain(raw["hr"], "hr")
    assert dict(st.dtypes) == {"EmployeeID": "bigint", "Name": "string", "Gender": "string",
                               "ManagerID": "int", "Department": "string",
                               "Salary": "double", "Status": "string", "DateOfJoining": "date"}


def test_exact_median_edges(spark):
    df = spark.createDataFrame([(1.0,), (2.0,), (None,), (10.0,), (20.0,)], "v double")
    assert exact_median(df, "v") == 6.0
    assert exact_median(df.where("v < 15"), "v") == 2.0
    assert exact_median(df.where("v > 100"), "v") is None


def test_exact_median_hot_value_many_partitions(spark):
    # a third of all rows share one value; result equals the sorted-list median
    vals = [7.0] * 400 + [float(i) for i in range(800)]
    df = spark.createDataFrame([(v,) for v in vals], "v double").repartition(6)
    s = sorted(vals)
    n = len(s)
    want = (s[(n - 1) // 2] + s[n // 2]) / 2
    assert exact_median(df, "v", num_partitions=5) == want
    assert exact_median(df.where("v <> 5"), "v", num_partitions=5) \
        == sorted(x for x in vals if x != 5)[(n - 2) // 2]


def test_dedup_keeps_one_of_null_equal_rows(spark):
    df = spark.createDataFrame([(1, None), (1, None), (2, "a")], "a int, b string")
    assert df.dropDuplicates().count() == 2


def test_group_keys_and_all_null_sum(spark):
    fin = spark.createDataFrame(
        [(1, 1, None, 20230105), (2, None, 5.0, 20230105), (3, 1, None, 20230230)],
        "employeeid long, expensetypeid long, expenseamount double, datekey int")
    types = spark.createDataFrame([(1, "A")], "expensetypeid long, expensetype string")
    rows = expense_by_month_type(fin, types).collect()
    # NULL type key excluded; an impossible date key dropped; all-NULL sum -> 0.0
    assert [tuple(r) for r in rows] == [("2023-01", "A", 0.0)]


def test_nan_salary_is_filled(spark):
    df = spark.createDataFrame(
        [(1, "A", None, None, "x", float("nan"), "s", "2023-01-05"),
         (2, "B", "F", "1", "x", 10.0, "s", "2023-01-05")],
        "EmployeeID long, Name string, Gender string, ManagerID string, Department string, "
        "Salary double, Status string, DateOfJoining string")
    assert {r.Salary for r in clean_domain(df, "hr").collect()} == {10.0}


def test_kpi_sums_take_any_value(spark):
    fin = spark.createDataFrame([(1, 1, 1e15, 20230105), (1, 2, 0.00004, 20230105)] +
                                [(1, 2, 0.00004, 20230105)] * 99_999,
                                "employeeid long, expensetypeid long, expenseamount double, datekey int")
    types = spark.createDataFrame([(1, "A"), (2, "B")], "expensetypeid long, expensetype string")
    got = {r.expensetype: r.total_expense for r in expense_by_month_type(fin, types).collect()}
    assert got["A"] == 1e15 and abs(got["B"] - 4.0) < 1e-6


def test_month_of_a_key(spark):
    from lodestar.functions import key_month, month_text
    keys = [20230105, 20230230, 20240229, 20230229, 20231301, 20230400, 0, None, 19000229, 20000229]
    df = spark.createDataFrame([(k,) for k in keys], "k int")
    got = [r[0] for r in df.select(month_text(key_month("k"))).collect()]
    assert got == ["2023-01", None, "2024-02", None, None, None, None, None, None, "2000-02"]
