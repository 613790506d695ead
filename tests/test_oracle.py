"""Every registered query against its SQL in DuckDB, whole results."""

from __future__ import annotations

import glob
import os

import duckdb
import pytest

import __spark_entry__ as entry
from oracles import duckdb_sql
from salesloom.registry import QUERIES

ORACLE = duckdb_sql.oracle_sql()


@pytest.fixture(scope="module")
def duck(sf_dir):
    connection = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        connection.sql(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return connection


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLE)
    assert set(QUERIES) <= set(entry.queries()) and set(ORACLE) <= set(entry.oracle_sql())


@pytest.mark.parametrize("name", QUERIES)
def test_query(spark, duck, sf_dir, name):
    df = QUERIES[name](spark, sf_dir)
    plan = df._jdf.queryExecution().executedPlan().toString()
    for slow in ("CartesianProduct", "NestedLoopJoin", "PythonUDF", "InPandas"):
        assert slow not in plan

    found, expected = df.toArrow(), duck.sql(ORACLE[name]).to_arrow_table()
    columns = sorted(found.column_names)
    assert columns == sorted(expected.column_names)
    assert [found.schema.field(c).type for c in columns] == [
        expected.schema.field(c).type for c in columns
    ]

    def rows(table):
        return sorted(repr([r[c] for c in columns]) for r in table.to_pylist())

    assert rows(found) == rows(expected)


def test_entry(spark):
    assert entry.entry(spark).count() > 0
