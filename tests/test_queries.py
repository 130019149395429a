"""Every registered query against DuckDB on the same tables."""

from __future__ import annotations

import math
import os

import duckdb
import pytest

import __spark_entry__ as contract
from weftgraph.plans import table_queries
from weftgraph.plans.table_graph import TABLES

FOLDER = os.environ.get("CHECK_SF_DIR", "/root/testdata/sf0.01")

# Spark type names and what DuckDB calls them.
SAME_TYPE = {"bigint": "BIGINT", "int": "INTEGER", "string": "VARCHAR", "double": "DOUBLE", "boolean": "BOOLEAN"}


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{FOLDER}/{name}.parquet'")
    return connection


def ordered(rows):
    def key(row):
        return [(v is None, "" if v is None else str(type(v)), 0 if v is None else v) for v in row]

    return sorted((tuple(r) for r in rows), key=key)


def same(a, b):
    if isinstance(a, float) and isinstance(b, float):
        return math.isclose(a, b, rel_tol=1e-12) or (math.isnan(a) and math.isnan(b))
    return a == b


@pytest.mark.parametrize("name", list(table_queries.queries()))
def test_query_agrees_with_sql(spark, duck, name):
    frame = contract.queries()[name](spark, FOLDER)
    relation = duck.sql(contract.oracle_sql()[name])
    columns = sorted(frame.columns)
    assert columns == sorted(relation.columns)
    types = {f.name: f.dataType.simpleString() for f in frame.schema}
    expected = {c: str(t) for c, t in zip(relation.columns, relation.types)}
    assert {c: SAME_TYPE[types[c]] for c in columns} == expected
    got = ordered(frame.select(*columns).collect())
    want = ordered(duck.sql(f"SELECT {', '.join(f'\"{c}\"' for c in columns)} FROM ({contract.oracle_sql()[name]})").fetchall())
    assert len(got) == len(want)
    assert got
    for g, w in zip(got, want):
        assert all(same(a, b) for a, b in zip(g, w)), (g, w)


def test_every_query_has_sql_and_is_registered():
    assert set(table_queries.queries()) == set(table_queries.oracle_sql())
    assert set(table_queries.queries()) <= set(contract.queries())
    assert set(table_queries.oracle_sql()) <= set(contract.oracle_sql()) <= set(contract.queries())


def test_entry(spark):
    rows = contract.entry(spark).collect()
    assert sum(r["orders"] for r in rows) == spark.read.parquet("/root/testdata/sf0.001/orders.parquet").count()
