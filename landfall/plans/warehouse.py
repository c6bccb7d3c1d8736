"""Catalog tables of the warehouse."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, types as T

from landfall import schemas
from landfall.session import exists, remove


def _column(spec: schemas.TableSpec, field: T.StructField) -> str:
    # A varchar column makes Spark refuse longer text on insert.
    limit = spec.lengths.get(field.name)
    dtype = f"VARCHAR({limit})" if limit else field.dataType.simpleString()
    return f"`{field.name}` {dtype}"


def create_table(spark: SparkSession, database: str, spec: schemas.TableSpec,
                 folder: str | None = None) -> None:
    """A table, in `folder` with the rows already there or else empty in the database's."""
    columns = ", ".join(_column(spec, field) for field in spec.schema)
    partitions = (f" PARTITIONED BY ({', '.join(spec.partitioned_by)})"
                  if spec.partitioned_by else "")
    place = f" LOCATION '{folder}'" if folder else ""
    spark.sql(f"CREATE TABLE {database}.{spec.name} ({columns}) USING parquet{partitions}{place}")


def create_warehouse(spark: SparkSession, database: str, location: str | None = None) -> None:
    """All staging, dimension and fact tables, empty; older ones are dropped.

    With a location, tables that an earlier process left there are dropped as well, though
    this session's catalog may not know them.
    """
    root = _create_database(spark, database, location)
    for spec in schemas.TABLES.values():
        spark.sql(f"DROP TABLE IF EXISTS {database}.{spec.name}")
        if location:
            remove(spark, f"{root}/{spec.name}")
        create_table(spark, database, spec)


def attach_warehouse(spark: SparkSession, database: str, location: str | None) -> None:
    """Make the tables of an earlier process known to this session's catalog.

    Tables that the catalog has already stay as they are; those never set up stay unknown.
    Partitions are found by listing their folders once.
    """
    if not location:
        return
    root = _create_database(spark, database, location)
    for spec in schemas.TABLES.values():
        name, folder = f"{database}.{spec.name}", f"{root}/{spec.name}"
        if spark.catalog.tableExists(name) or not exists(spark, folder):
            continue
        create_table(spark, database, spec, folder)
        if spec.partitioned_by:
            spark.catalog.recoverPartitions(name)


def _create_database(spark: SparkSession, database: str, location: str | None) -> str:
    place = f" LOCATION '{location}'" if location else ""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}{place}")
    return spark.catalog.getDatabase(database).locationUri.rstrip("/")


def tables_of(spark: SparkSession, database: str) -> dict[str, DataFrame]:
    """Current state of every table."""
    return {name: spark.table(f"{database}.{name}") for name in schemas.TABLES}
