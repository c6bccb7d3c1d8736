"""Sinks: sorted extracts, catalog tables, and batches that are checked before they show."""

from __future__ import annotations

from collections.abc import Iterable
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, functions as F

from landfall.session import remove
from landfall.sources import publish


def write_sorted(df: DataFrame, path: str, *by: str) -> None:
    """Overwrite with a globally ordered copy.

    The other columns extend the order, so rows that share the leading key can
    be spread over several tasks.
    """
    rest = [c for c in df.columns if c not in by]
    df.orderBy(*by, *rest).write.mode("overwrite").parquet(path)


def append_to(df: DataFrame, table: str) -> None:
    """INSERT INTO table, columns matched by name."""
    columns = df.sparkSession.table(table).columns
    df.select(*[F.col(f"`{c}`") for c in columns]).write.mode("append").insertInto(table)


def write_staging(df: DataFrame, table: str, truncate: bool) -> None:
    """Load a staging table, replacing its rows or adding to them."""
    columns = df.sparkSession.table(table).columns
    ordered = df.select(*[F.col(f"`{c}`") for c in columns])
    ordered.write.insertInto(table, overwrite=truncate)


def location_of(spark: SparkSession, table: str) -> str:
    """The folder of a table."""
    described = spark.sql(f"DESCRIBE TABLE EXTENDED {table}").where("col_name = 'Location'")
    return described.first()["data_type"].rstrip("/")


@dataclass(frozen=True)
class StagedBatch:
    """Rows of a batch below their table's folder, not yet part of the table."""

    table: str
    root: str
    name: str
    rows: DataFrame


def stage_batch(df: DataFrame, table: str) -> StagedBatch:
    """Write a batch aside in the table's partitions, to be checked and published."""
    spark = df.sparkSession
    root = location_of(spark, table)
    if publish.recover(spark, root):
        spark.sql(f"MSCK REPAIR TABLE {table} SYNC PARTITIONS")
    target = spark.table(table).schema
    keys = [f.name for f in spark.catalog.listColumns(table) if f.isPartition]
    columns = [F.col(f"`{f.name}`").cast(f.dataType).alias(f.name) for f in target]
    name = publish.staged_name()
    df.select(*columns).write.options(**publish.COMMIT).partitionBy(*keys).parquet(f"{root}/{name}")
    return StagedBatch(table, root, name, spark.read.schema(target).parquet(f"{root}/{name}"))


def discard_batch(spark: SparkSession, staged: StagedBatch) -> None:
    remove(spark, f"{staged.root}/{staged.name}")


def publish_batch(spark: SparkSession, staged: StagedBatch, key: str,
                  values: Iterable[str]) -> None:
    """Replace the table's folders `key`=value by the staged ones, stray partitions included.

    Only the listed values are touched; of the others no more than the names of their
    folders is read. The catalog learns of the partitions in two statements, whatever their
    number, once the folders are in place; those dropped have no folder by then.
    """
    values = set(values)

    def partitions(root: str, folders: Iterable[str]) -> set[str]:
        with ThreadPoolExecutor(16) as pool:
            inner = pool.map(lambda f: publish.folders(spark, f"{root}/{f}", 1), folders)
        return {f"{f}/{sub}" for f, subs in zip(folders, inner, strict=True) for sub in subs}

    folder = f"{staged.root}/{staged.name}"
    new = publish.folders(spark, folder, 1)
    unknown = {f.split("=", 1)[1] for f in new} - values
    if unknown:
        raise ValueError(f"staged rows of other batches: {sorted(unknown)[:5]}")
    before = [f for f in publish.folders(spark, staged.root, 1) if f.split("=", 1)[1] in values]
    arrive, old = partitions(folder, new), partitions(staged.root, before)
    publish.publish(spark, staged.root, staged.name, new, set(before) - set(new))
    for verb, some in (("DROP IF EXISTS", old - arrive), ("ADD IF NOT EXISTS", arrive - old)):
        if some:
            spark.sql(f"ALTER TABLE {staged.table} {verb} "
                      + (", " if verb[0] == "D" else " ").join(map(_partition, sorted(some))))
    spark.catalog.refreshTable(staged.table)


def _partition(folder: str) -> str:
    values = dict(part.split("=", 1) for part in folder.split("/"))
    shown = {k: "NULL" if v == "__HIVE_DEFAULT_PARTITION__" else f"'{v}'"
             for k, v in values.items()}
    return "PARTITION (" + ", ".join(f"`{k}` = {v}" for k, v in shown.items()) + ")"
