"""Compare Spark results with DuckDB over the same files."""

from __future__ import annotations

import datetime
import decimal
import glob
import os

import duckdb
from pyspark.sql import DataFrame


def _plain(value):
    if isinstance(value, datetime.datetime):
        return value.date() if value.time() == datetime.time() else value
    if isinstance(value, decimal.Decimal):
        return float(value)
    return value


def _rows(columns: list[str], rows) -> list[tuple]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    plain = [tuple(_plain(row[i]) for i in order) for row in rows]
    return sorted(plain, key=lambda row: tuple((v is not None, str(v)) for v in row))


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        table = os.path.basename(path).removesuffix(".parquet")
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{path}'")
    return connection


def expected_rows(connection: duckdb.DuckDBPyConnection,
                  statement: str) -> tuple[list[str], list[str], list[tuple]]:
    cursor = connection.execute(statement)
    names = [d[0] for d in cursor.description]
    types = [str(d[1]) for d in cursor.description]
    return names, types, _rows(names, cursor.fetchall())


def actual_rows(df: DataFrame) -> list[tuple]:
    return _rows(df.columns, df.collect())
