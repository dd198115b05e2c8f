"""S1 extract files and the incremental file-source stream."""

import os

import pytest

from conftest import SF_SMALL
from lodestar.operators.cleaning import clean_domain
from lodestar.plans import scenarios as sc
from lodestar.plans.loads import run_domains
from lodestar.sources.extracts import read_extract, write_extract
from lodestar.sources.fixtures import raw_extracts
from lodestar.sources.store import Warehouse
from lodestar.streaming.incremental import load_new_extracts


@pytest.mark.parametrize("fmt", ["csv", "json", "parquet"])
def test_extract_round_trip(spark, tmp_root, fmt):
    raw = raw_extracts(spark, SF_SMALL)["finance"]
    path = os.path.join(tmp_root, f"finance.{fmt}")
    write_extract(raw, path, fmt)
    back = read_extract(spark, path, "finance", fmt)
    assert back.count() == 1541
    assert clean_domain(back, "finance").count() == 1385


def test_landed_files_are_even_when_one_row_group_holds_the_table(spark, tmp_root):
    from pyspark.sql import functions as F
    from lodestar.sources.fixtures import land_extracts
    sf = os.path.join(tmp_root, "sf")
    k = spark.range(8000).select(F.col("id").alias("k"))
    for name, cols in {
            "customer": ["k AS c_custkey", "concat('c', k) AS c_name", "'BUILDING' AS c_mktsegment",
                         "k % 25 AS c_nationkey", "k / 7 AS c_acctbal"],
            "orders": ["k AS o_orderkey", "k % 900 AS o_custkey", "k / 3 AS o_totalprice",
                       "'1-URGENT' AS o_orderpriority", "timestamp'1995-01-01' AS o_orderdate"],
            "events": ["k AS event_id", "'click' AS event_type", "k % 50 AS user_id", "k / 9 AS value",
                       "timestamp'2024-01-01' AS ts"]}.items():
        k.selectExpr(*cols).coalesce(1).write.parquet(f"{sf}/{name}.parquet")
    old = {c: spark.conf.get(c) for c in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", "4k")
        spark.conf.set("spark.sql.files.openCostInBytes", "1k")
        landed = land_extracts(spark, sf, os.path.join(tmp_root, "landed"))
        assert {d: df.count() for d, df in landed.items()} == {
            d: df.count() for d, df in raw_extracts(spark, sf).items()}
    finally:
        for c, v in old.items():
            spark.conf.set(c, v)
    for df in landed.values():
        sizes = [r["count"] for r in df.groupBy(F.input_file_name().alias("f")).count().collect()]
        assert len(sizes) >= 4 and max(sizes) < 3 * sum(sizes) / len(sizes)


def test_stream_loads_only_new_files(spark, tmp_root):
    raw = raw_extracts(spark, SF_SMALL)
    root = os.path.join(tmp_root, "wh")
    run_domains(Warehouse(spark, root, new=True), {"hr": raw["hr"]}, ("hr",))
    landing = os.path.join(tmp_root, "landing")
    ckpt = os.path.join(tmp_root, "ckpt")
    write_extract(sc.before(raw["finance"], "ExpenseDate", sc.FINANCE_CUTOFF),
                  os.path.join(landing, "batch1"), "parquet")
    ev1 = load_new_extracts(spark, os.path.join(landing, "*"), "finance", root, ckpt)
    assert Warehouse(spark, root).read("fact_finance").count() == 564
    write_extract(raw["finance"], os.path.join(landing, "batch2"), "parquet")
    ev2 = load_new_extracts(spark, os.path.join(landing, "*"), "finance", root, ckpt)
    assert Warehouse(spark, root).read("fact_finance").count() == 1247
    assert dict((t, n) for t, _, n in ev2)["fact_finance"] == 1247 - 564
    # nothing new: the stream consumes no file and commits nothing
    assert load_new_extracts(spark, os.path.join(landing, "*"), "finance", root, ckpt) == []
    assert ev1


def test_command_line_load_and_reports(spark, tmp_root, capsys):
    from lodestar.__main__ import main
    for d, df in raw_extracts(spark, SF_SMALL).items():
        write_extract(df, os.path.join(tmp_root, "landing", d), "csv")
    wh = os.path.join(tmp_root, "wh")
    assert main(["load", "--landing", os.path.join(tmp_root, "landing"), "--warehouse", wh,
                 "--as-of", "2024-01-01"]) == 0
    out = capsys.readouterr().out
    assert "fact_finance         1247" in out and "version 1" in out
    for cmd in (["kpi", "--warehouse", wh, "hr"], ["view", "--warehouse", wh, "--role", "Super"],
                ["audit", "--warehouse", wh], ["check", "--warehouse", wh],
                ["scd2-report", "--warehouse", wh]):
        assert main(["--limit", "3"] + cmd) == 0
    assert Warehouse(spark, wh).read("dim_employee").count() == 138


def test_csv_binds_by_name_and_keeps_extra_columns(spark, tmp_root):
    path = os.path.join(tmp_root, "x")
    os.makedirs(path)
    with open(os.path.join(path, "a.csv"), "w") as f:
        f.write("ExpenseType,ReceiptNo,EmployeeID,ExpenseDate,ApprovedBy,ExpenseAmount\n"
                "TRAVEL,r1,12.0,2023-01-05,3,5\n"
                "TRAVEL,r2,12.0,2023-01-05,3,5\n"       # differs in a column not loaded
                "TRAVEL,r2,12.0,2023-01-05,3,5\n"
                "N/A,r3,7,2023-01-05,3,5\n"             # missing marker: required, dropped
                "FOOD,r4,,2023-01-05,3,5\n")            # blank id: dropped, not an error
    raw = read_extract(spark, path, "finance", "csv")
    st = clean_domain(raw, "finance")
    assert "ReceiptNo" in raw.columns and "ReceiptNo" not in st.columns
    assert [(r.EmployeeID, r.ExpenseType) for r in st.collect()] == [(12, "TRAVEL")] * 2


def test_ids_and_salaries_must_be_numbers(spark, tmp_root):
    for i, (emp, salary, ok) in enumerate([("abc", "1", False), ("1", "much", False),
                                           ("9007199254740993", "", True)]):
        path = os.path.join(tmp_root, str(i))
        os.makedirs(path)
        with open(os.path.join(path, "a.csv"), "w") as f:
            f.write("EmployeeID,Name,Gender,ManagerID,Department,Salary,Status,DateOfJoining\n"
                    f"{emp},n,F,1,D,{salary},Active,2023-01-05\n")
        df = read_extract(spark, path, "hr", "csv")
        if ok:
            assert df.first().EmployeeID == int(emp) and df.first().Salary is None
        else:
            with pytest.raises(Exception, match="is not a number"):
                df.collect()
    with pytest.raises(ValueError, match="lacks"):
        read_extract(spark, path, "finance", "csv")


def test_two_landed_files_are_one_load(spark, tmp_root):
    raw = raw_extracts(spark, SF_SMALL)
    schema = "EmployeeID long, ExpenseType string, ExpenseAmount string, ApprovedBy string, " \
             "ExpenseDate string"
    who = clean_domain(raw["hr"], "hr").first().EmployeeID
    rows = [(who, "TRAVEL", "10", "1", "2023-01-05"), (who, "TRAVEL", "20", "1", "2023-01-05")]
    got = []
    for files in (1, 2):
        root, land = (os.path.join(tmp_root, f"{x}{files}") for x in ("wh", "land"))
        run_domains(Warehouse(spark, root, new=True), {"hr": raw["hr"]}, ("hr",))
        for i in range(files):
            part = rows if files == 1 else rows[i:i + 1]
            write_extract(spark.createDataFrame(part, schema).coalesce(1),
                          os.path.join(land, f"b{i}"), "parquet")
        load_new_extracts(spark, os.path.join(land, "*"), "finance", root,
                          os.path.join(tmp_root, f"ckpt{files}"))
        got.append(sorted(r.expenseamount for r in Warehouse(spark, root).read("fact_finance").collect()))
    assert got == [[10.0, 20.0]] * 2


def test_stream_of_an_empty_folder_loads_nothing(spark, tmp_root):
    assert load_new_extracts(spark, os.path.join(tmp_root, "none"), "hr",
                             os.path.join(tmp_root, "wh"), os.path.join(tmp_root, "c")) == []


TEXT = "EmployeeID string, ExpenseType string, ExpenseAmount string, ApprovedBy string, ExpenseDate string"


def _drifting(spark, root):
    row = ("1234567890123456789", "TRAVEL", "5", "1", "2023-01-05")
    write_extract(spark.createDataFrame([row, row], TEXT).coalesce(1), f"{root}/one", "parquet")
    write_extract(spark.createDataFrame([(*row, "r1"), (*row, "r2"), (*row, "r2")], TEXT + ", ReceiptNo string")
                  .coalesce(1), f"{root}/two", "parquet")


def test_parquet_files_of_different_columns_are_united_by_name(spark, tmp_root):
    _drifting(spark, f"{tmp_root}/land")
    raw = read_extract(spark, f"{tmp_root}/land/*", "finance", "parquet")
    assert sorted(str(r.ReceiptNo) for r in raw.collect()) == ["None", "None", "r1", "r2", "r2"]
    st = clean_domain(raw, "finance")
    assert [r.EmployeeID for r in st.collect()] == [1234567890123456789] * 3


def test_parquet_files_of_different_types_are_bound_apart(spark, tmp_root):
    _drifting(spark, f"{tmp_root}/land")
    for name, kind, who in (("three", "long", 12), ("four", "double", 7.0)):
        write_extract(spark.createDataFrame([(who, "FOOD", 2.5, "1", "2023-01-05", 9)],
                      TEXT.replace("EmployeeID string", f"EmployeeID {kind}")
                      .replace("ExpenseAmount string", "ExpenseAmount double") + ", Page int"),
                      f"{tmp_root}/land/{name}", "parquet")
    raw = read_extract(spark, f"{tmp_root}/land/*", "finance", "parquet")
    assert set(raw.columns) >= {"ReceiptNo", "Page"}
    st = clean_domain(raw, "finance")
    assert sorted((r.EmployeeID, r.ExpenseAmount) for r in st.collect()) == \
        [(7, 2.5), (12, 2.5), *[(1234567890123456789, 5.0)] * 3]


def test_stream_reads_the_columns_of_all_its_files(spark, tmp_root):
    root, land = f"{tmp_root}/wh", f"{tmp_root}/land"
    hr = spark.createDataFrame([("1234567890123456789", "n", "F", "1", "D", "5", "Active", "2023-01-05")],
                               "EmployeeID string, Name string, Gender string, ManagerID string, "
                               "Department string, Salary string, Status string, DateOfJoining string")
    write_extract(hr, f"{tmp_root}/hr", "parquet")
    run_domains(Warehouse(spark, root, new=True),
                {"hr": read_extract(spark, f"{tmp_root}/hr", "hr", "parquet")}, ("hr",))
    _drifting(spark, land)
    load_new_extracts(spark, f"{land}/*", "finance", root, f"{tmp_root}/ckpt")
    got = Warehouse(spark, root).read("fact_finance").collect()
    assert [r.employeeid for r in got] == [1234567890123456789] * 3


def test_ids_are_exact_up_to_64_bits(spark):
    from lodestar.sources.extracts import bind
    def bound(v):
        return bind(spark.createDataFrame([(v, "", "", "", "")], TEXT), "finance").first()[0]

    for text, want in [("9223372036854775807", (1 << 63) - 1), ("-9223372036854775808", -(1 << 63)),
                       ("1234567890123456789.75", 1234567890123456789), ("-1.9", -1), ("1.5e3", 1500),
                       (" 12.0 ", 12), ("+7", 7), ("1e-3", 0), ("", None), ("NA", None)]:
        assert bound(text) == want
    for text in ("9223372036854775808", "1e19", "1" * 42):
        with pytest.raises(Exception, match="beyond 64 bits"):
            bound(text)
