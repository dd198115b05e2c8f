"""Store concurrency, fact pruning edges and the date dimension."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from lodestar.operators.dimensions import date_dimension
from lodestar.operators.facts import FACT_FINANCE, fact_new_rows
from lodestar.sources.store import Warehouse

CAND = "employeeid long, expensetypeid long, expenseamount double, approvedby int, datekey int"


def test_two_writers_cannot_commit_the_same_version(spark, tmp_root):
    wh1 = Warehouse(spark, tmp_root, new=True)
    wh2 = Warehouse(spark, tmp_root, new=True)
    df = spark.createDataFrame([(1, "A")], "departmentid long, department string")
    tx1, tx2 = wh1.transaction(), wh2.transaction()
    tx1.write("dim_department", df)
    tx2.write("dim_department", df)
    assert tx1.commit() == 1
    with pytest.raises(Exception):
        tx2.commit()                    # version 1 exists: no silent overwrite
    assert Warehouse(spark, tmp_root).read("dim_department").count() == 1


def test_fact_new_rows_month_lists(spark):
    existing = spark.createDataFrame([(1, 1, 5.0, 1, 20240105, 202401)],
                                     CAND + ", datemonth int")
    cand = spark.createDataFrame([(1, 1, 9.0, 2, 20240105), (1, 1, 9.0, 2, 20240205)], CAND)
    # exact months, a superset, and no month list (derived from the batch)
    for months in ([202401, 202402], [202312, 202401, 202402, 202403], None):
        got = [r.datekey for r in fact_new_rows(cand, existing, FACT_FINANCE, months).collect()]
        assert got == [20240205]
    # an empty batch reads nothing from the fact
    assert fact_new_rows(cand.limit(0), existing, FACT_FINANCE, []).count() == 0


def test_date_dimension(spark):
    keys = spark.createDataFrame([(20231230,), (20240102,)], "datekey int")
    rows = {r.datekey: r for r in date_dimension(keys).collect()}
    assert sorted(rows) == [20231230, 20231231, 20240101, 20240102]
    d = rows[20240101]
    assert (d.full_date, d.year, d.quarter, d.month, d.day, d.isodow, d.month_label) == \
        (dt.date(2024, 1, 1), 2024, 1, 1, 1, 1, "2024-01")


def test_concurrent_commits_have_one_winner(spark, tmp_root):
    import threading
    df = spark.createDataFrame([(1, "A")], "departmentid long, department string")
    for n in range(8):
        root, barrier, won, lost = f"{tmp_root}/{n}", threading.Barrier(2), [], []
        txs = [Warehouse(spark, root, new=True).transaction() for _ in range(2)]
        for tx in txs:
            tx.write("dim_department", df)

        def commit(tx):
            barrier.wait()
            try:
                won.append(tx.commit())
            except RuntimeError:
                lost.append(tx)

        threads = [threading.Thread(target=commit, args=(tx,)) for tx in txs]
        for t in threads:
            t.start()
        for t in threads:
            t.join()
        assert won == [1] and len(lost) == 1
        assert Warehouse(spark, root).read("dim_department").count() == 1
        # the loser's segment is gone, one manifest stands
        from lodestar.sources import files
        assert len(files.names(spark, f"{root}/_manifest")) == 1
        assert len([x for x in files.names(spark, f"{root}/dim_department")
                    if x.startswith("seg=")]) == 1


def test_cluster_without_checkpoint_folder_raises(monkeypatch):
    from lodestar import session

    class Context:
        master = "spark://host:7077"

        def getCheckpointDir(self):
            return None

        def getConf(self):
            return {"spark.checkpoint.dir": None}

    class Session:
        sparkContext = Context()

    with pytest.raises(RuntimeError):
        session.checkpoint_root(Session())
