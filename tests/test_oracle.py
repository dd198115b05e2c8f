"""Every registered query against its DuckDB oracle at sf0.001."""

import math

import duckdb
import pytest

from conftest import SF_SMALL

import __spark_entry__ as se
from lodestar.plans.oracle import oracle_sql
from lodestar.plans.registry import QUERIES

TABLES = ["customer", "orders", "events"]


def norm(v):
    if isinstance(v, float):
        return None if math.isnan(v) else round(v, 6)
    return v


def rows(cols, data):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted((tuple(norm(r[i]) for i in order) for r in data), key=repr)


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return c


def test_every_query_has_oracle():
    assert set(QUERIES) == set(oracle_sql())
    assert set(QUERIES) <= set(se.queries()) and set(oracle_sql()) <= set(se.oracle_sql())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, con, name):
    sdf = se.queries()[name](spark, SF_SMALL)
    rel = con.sql(se.oracle_sql()[name])
    assert sorted(sdf.columns) == sorted(rel.columns)
    assert rows(sdf.columns, sdf.collect()) == rows(rel.columns, rel.fetchall())


def test_entry_smoke(spark):
    df = se.entry(spark)
    assert df.count() == 949
