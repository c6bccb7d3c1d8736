"""Every registered query against DuckDB over the same files."""

import os

import pytest

import __spark_entry__ as entry_module
from verification.queries import all_queries
from verification.compare import actual_rows, connect, expected_rows

SF = "/root/testdata/sf0.001"

pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no test data")

QUERIES, ORACLES = entry_module.queries(), entry_module.oracle_sql()
TYPES = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR",
         "date": "DATE"}


@pytest.fixture(scope="module")
def duckdb_connection():
    return connect(SF)


def test_every_query_has_its_statement():
    """Those of the operators for training data that SQL cannot state have other tests."""
    assert all_queries().keys() <= ORACLES.keys() <= QUERIES.keys()


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query(spark, duckdb_connection, name):
    df = QUERIES[name](spark, SF)
    columns, types, expected = expected_rows(duckdb_connection, ORACLES[name])
    assert sorted(df.columns) == sorted(columns)
    assert len(set(df.columns)) == len(df.columns)
    wanted = dict(zip(columns, types))
    assert {c: TYPES.get(t, t.upper()) for c, t in df.dtypes} == wanted
    assert actual_rows(df) == expected


def test_entry(spark):
    assert 0 < entry_module.entry(spark).count() <= 10
