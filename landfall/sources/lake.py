"""Writes to the lake: staged in one pass, counted where they are staged, published by folder.

A row carries the run that wrote it (the raw file it came from) in a column that readers
of the lake pass over. What a run writes again replaces exactly the months it wrote before
or writes now: days that a corrected file no longer has go, and rows that other runs filed
under the same months stay. `_runs` below the lake records the months of each run; months
without a record belong to whoever writes them.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from landfall import schemas, session
from landfall.sources import publish
from landfall.sources.readers import with_load_day

RUN = "run"
DEFAULT_RUN = "extract"
_RECORDS = "_runs"
#: Levels of the folders that are replaced.
LEVELS = {"month": 2, "day": 3}


@dataclass(frozen=True)
class LakeCounts:
    """What a staged write holds: all rows, those of no existing day, those whose folder is
    another day than their arrival, and the (run, year, month) that have rows."""

    rows: int
    undated: int
    strays: int
    months: frozenset[tuple[str, int | None, int | None]]


@dataclass(frozen=True)
class StagedLake:
    """Rows below the lake that no reader sees yet."""

    path: str
    name: str
    runs: tuple[str, ...]
    counts: LakeCounts
    apart: bool

    @property
    def folder(self) -> str:
        return f"{self.path}/{self.name}"

    @property
    def below(self) -> str:
        return "dated=true/" if self.apart else ""


def stage(clean: DataFrame, path: str, runs: Iterable[str] = (DEFAULT_RUN,),
          apart: bool = False) -> StagedLake:
    """Write `clean` aside below the lake, in one pass over it.

    A column `run` names the run of each row; without it all are of the one run given.
    `apart` keeps rows whose filed day does not exist in a folder of their own.
    The rebalance hint brings the rows of a day together and lets adaptive execution split
    a day that is too big for one task.
    """
    spark, runs = clean.sparkSession, tuple(runs)
    publish.recover(spark, path)
    rows = with_load_day(clean if RUN in clean.columns
                         else clean.withColumn(RUN, F.lit(runs[0])))
    parts = (["dated"] if apart else []) + [*schemas.LAKE_PARTITIONS]
    dealt = rows.withColumn("dated", F.col("load_day").isNotNull()).hint("rebalance", *parts)
    name = publish.staged_name()
    (dealt.select(*[c for c in schemas.CLEAN_ARRIVALS.fieldNames() if c not in parts], RUN, *parts)
     .write.options(**publish.COMMIT).partitionBy(*parts).parquet(f"{path}/{name}"))
    return StagedLake(path, name, runs, _counts(spark, f"{path}/{name}"), apart)


def _counts(spark: SparkSession, folder: str) -> LakeCounts:
    """The counts of a staged folder, from the run, the arrival and the folder names of its
    rows. Observed by the write they would cost each row more than its sort does."""
    # A write of no rows may leave no folder.
    if not session.exists(spark, folder):
        return LakeCounts(0, 0, 0, frozenset())
    rows, dated = with_load_day(_rows(spark, [folder], folder)), F.col("load_day").isNotNull()
    found = rows.groupBy(RUN, "year", "month").agg(
        F.count("*").alias("rows"), F.count_if(~dated).alias("undated"),
        F.count_if(dated & ~F.col("load_day").eqNullSafe(F.col("arrival_date"))).alias("strays"),
    ).collect()
    return LakeCounts(*[sum(m[c] for m in found) for c in ("rows", "undated", "strays")],
                      frozenset((m[RUN], m["year"], m["month"]) for m in found))


def discard(spark: SparkSession, staged: StagedLake) -> None:
    session.remove(spark, staged.folder)


def undated_rows(spark: SparkSession, staged: StagedLake) -> DataFrame:
    """The staged rows that belong to no day."""
    return _rows(spark, [f"{staged.folder}/dated=false"], f"{staged.folder}/dated=false")


def _rows(spark: SparkSession, paths: list[str], base: str) -> DataFrame:
    schema = T.StructType([*schemas.CLEAN_ARRIVALS, T.StructField(RUN, T.StringType())])
    return spark.read.schema(schema).option(
        "basePath", base).parquet(*paths)


def _record(run: str) -> str:
    """The file with a run's months; its name holds no character of the run's."""
    return f"{_RECORDS}/{hashlib.sha256(run.encode()).hexdigest()[:24]}.json"


def owned_months(spark: SparkSession, path: str) -> dict[str, set[str]]:
    """The month folders in which each run has rows, from the records."""
    found = {}
    for file in session.list_paths(spark, f"{path}/{_RECORDS}/*.json"):
        record = json.loads(session.read_text(spark, file))
        found[record["run"]] = set(record["months"])
    return found


def _folder(year: int | None, month: int | None) -> str:
    none = "__HIVE_DEFAULT_PARTITION__"
    return f"year={none if year is None else year}/month={none if month is None else month}"


def commit(spark: SparkSession, staged: StagedLake, replace: str = "month") -> None:
    """Publish a staged write.

    `replace` says what the rows take the place of: the 'month's that its runs have
    written, the 'day's it has rows for, or all of the 'lake'. Rows of other runs in these
    months or days are copied to the staged folder first, in one job; usually there are none.
    """
    if replace not in (*LEVELS, "lake"):
        raise ValueError(f"replace must be 'month', 'day' or 'lake', not {replace!r}")
    path, runs = staged.path, set(staged.runs)
    owned = owned_months(spark, path)
    written = {run: set() for run in runs}
    for run, year, month in staged.counts.months:
        written.setdefault(run, set()).add(_folder(year, month))
    depth = LEVELS.get(replace, 2)
    new = publish.folders(spark, f"{staged.folder}/{staged.below}".rstrip("/"), depth)
    if replace == "lake":
        gone = set(publish.folders(spark, path, 2)) - set(new)
        records = {run: set() for run in owned} | written
    else:
        before = set().union(*(owned.get(r, set()) for r in runs)) if replace == "month" else set()
        gone = before - set(new)
        touched = {"/".join(f.split("/")[:2]) for f in (*new, *gone)}
        others = {r: months & touched for r, months in owned.items()
                  if r not in runs and months & touched}
        if others:
            _keep(spark, staged, sorted(set().union(*others.values())), new, gone, depth)
            new = publish.folders(
                spark, f"{staged.folder}/{staged.below}".rstrip("/"), depth)
            gone -= set(new)
        kept = {r: owned.get(r, set()) if replace == "day" else set() for r in runs}
        records = {r: written.get(r, set()) | kept.get(r, set()) for r in (*runs, *written)}
    publish.publish(
        spark, path, staged.name, new, gone, below=staged.below,
        records={_record(r): json.dumps({"run": r, "months": sorted(m)})
                 for r, m in records.items()})


def _keep(spark: SparkSession, staged: StagedLake, months: list[str], new: list[str],
          gone: set[str], depth: int) -> None:
    """Copy the rows of other runs in the folders to be replaced into the staged ones."""
    there = [f"{staged.path}/{m}" for m in months if session.exists(spark, f"{staged.path}/{m}")]
    if not there:
        return
    rows = _rows(spark, there, staged.path).where(
        ~F.coalesce(F.col(RUN), F.lit(DEFAULT_RUN)).isin(*staged.runs))
    if depth == 3:
        days = [dict(p.split("=") for p in f.split("/")) for f in (*new, *gone)]
        rows = rows.where(F.struct(*schemas.LAKE_PARTITIONS).isin([
            F.struct(*[F.lit(d[c]).cast("int") for c in schemas.LAKE_PARTITIONS])
            for d in days if "__HIVE_DEFAULT_PARTITION__" not in d.values()]))
    parts = schemas.LAKE_PARTITIONS
    (rows.hint("rebalance", *parts)
     .select(*[c for c in schemas.CLEAN_ARRIVALS.fieldNames() if c not in parts], RUN, *parts)
     .write.mode("append").options(**publish.COMMIT).partitionBy(*parts)
     .parquet(f"{staged.folder}/{staged.below}".rstrip("/")))


def write_lake(df: DataFrame, path: str, replace: str = "month",
               run: str = DEFAULT_RUN) -> LakeCounts:
    """Write Parquet by year, month and arrival day and publish it; runs Spark jobs.

    Written again, a run replaces its months, so it cannot duplicate rows and leaves no
    stale day.
    """
    staged = stage(df, path, [run])
    commit(df.sparkSession, staged, replace)
    return staged.counts
