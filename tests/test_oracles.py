"""Every registered query that has a SQL oracle, against DuckDB on the small tables."""

import re

import duckdb
import pytest

import __spark_entry__ as contract
import workload
from helpers import canonical

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"


@pytest.fixture(scope="module")
def duck(sf_dir):
    con = duckdb.connect()
    for name in TABLES.split():
        con.sql(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


@pytest.mark.parametrize("key", sorted(contract.queries()))
def test_query(spark, duck, sf_dir, key):
    df = contract.queries()[key](spark, sf_dir)
    rows = df.collect()
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan
    if key in workload.QUERIES:
        assert not re.search("Python|MapInArrow|MapInPandas", plan)
    sql = contract.oracle_sql().get(key)
    if sql is None:
        assert df.columns
        return
    want = duck.sql(sql)
    assert sorted(df.columns) == sorted(want.columns)
    assert canonical(df.columns, rows) == canonical(want.columns, want.fetchall())


def test_contract(spark):
    assert set(contract.oracle_sql()) <= set(contract.queries())
    assert contract.entry(spark).count() > 0
