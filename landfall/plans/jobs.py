"""The four jobs: extract, setup, load of one day, load of many days."""

from __future__ import annotations

import datetime
from collections.abc import Iterable
from dataclasses import dataclass, field
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from landfall import schemas
from landfall.functions import days
from landfall.operators import dimensions, quality
from landfall.operators.clean import clean_arrivals
from landfall.operators.fact import FactCounts, fact_counts, observed_batch
from landfall.operators.latest import latest_city_temps, latest_country_temps
from landfall.operators.quality import DataQualityError
from landfall.plans.warehouse import attach_warehouse, create_warehouse
from landfall.session import list_paths, remove, scratch, settle
from landfall.sources import lake, readers, writers


@dataclass(frozen=True)
class JobConfig:
    """Where the jobs read and write.

    `lookups` maps a staging table to its CSV file and separator. `in_batch` and
    `null_safe` choose the upsert rule (see insert_if_absent); `constraints`
    checks keys, NOT NULL and lengths of what a batch added. With `null_safe` a
    re-run of a day adds no rows whose key holds NULL a second time; without it such
    rows conflict with nothing and every load adds them again.

    `raw` is a file or folder; `raw_months` names monthly ones below it, and `raw_year`
    stands for the twelve of a year, each of which must be there, once. An extract replaces
    what the same files left in the lake, or all of it with `whole_lake`.

    Arrivals whose filed day does not exist belong to no batch. They make the extract
    fail, unless `undated` names a folder: they then take the place of those that the same
    files left there. Arrivals filed under another day make it fail with `refuse_strays`.

    `checks` are run on each load before it shows (see quality.check_sql). Of the arrivals
    of a batch a share of `most_unmatched` may have codes that the lookups lack; any if None.

    The tables lie below `warehouse_location`; a load in another process finds them there,
    with any catalog. Without it they are known to the session's catalog alone.
    """

    database: str
    lake: str
    raw: str = ""
    raw_format: str = "parquet"
    raw_months: list[str] | None = None
    raw_year: int | None = None
    raw_suffix: str = ""
    city_temps_csv: str = ""
    country_temps_csv: str = ""
    city_temps: str = ""
    country_temps: str = ""
    lookups: dict[str, tuple[str, str]] = field(default_factory=dict)
    warehouse_location: str | None = None
    in_batch: str = "first"
    null_safe: bool = True
    constraints: bool = True
    undated: str = ""
    refuse_strays: bool = False
    most_unmatched: float | None = None
    checks: list[dict] = field(default_factory=list)
    whole_lake: bool = False
    allow_empty_days: bool = False

    def table(self, name: str) -> str:
        return f"{self.database}.{name}"


def _raw(spark: SparkSession, cfg: JobConfig) -> tuple[DataFrame, list[str]]:
    """Raw arrivals with the run of each row, and all runs."""
    months = list(cfg.raw_months or ())
    if cfg.raw_year is not None:
        months = [path.rsplit("/", 1)[1] for path in
                  readers.month_paths(cfg.raw, cfg.raw_year, suffix=cfg.raw_suffix)]
    if months:
        return readers.read_months(spark, cfg.raw, months, cfg.raw_format), months
    run = cfg.raw.rstrip("/").rsplit("/", 1)[-1]
    raw = readers.read_raw_arrivals(spark, cfg.raw, cfg.raw_format)
    return raw.withColumn(lake.RUN, F.lit(run)), [run]


def _check_extract(cfg: JobConfig, runs: list[str], counts: lake.LakeCounts) -> None:
    if counts.undated and not cfg.undated:
        raise DataQualityError(f"existing day of arrival: {counts.undated} arrivals have none")
    if counts.strays and cfg.refuse_strays:
        raise DataQualityError(
            f"partition date: {counts.strays} arrivals are filed under another day")
    for run in runs:
        month = readers.month_of_file(run)
        if month and (run, *month) not in counts.months:
            raise DataQualityError(f"{run}: no arrivals of its month")


def _set_aside(spark: SparkSession, cfg: JobConfig, staged: lake.StagedLake) -> None:
    """The undated rows of the runs take the place of those of earlier extracts."""
    for path in list_paths(spark, f"{cfg.undated}/{lake.RUN}=*"):
        if unquote(path.rsplit("=", 1)[1]) in staged.runs:
            remove(spark, path)
    if staged.counts.undated:
        lake.undated_rows(spark, staged).write.mode("append").partitionBy(lake.RUN).parquet(
            cfg.undated)


def extract_job(spark: SparkSession, cfg: JobConfig) -> lake.LakeCounts:
    """Raw arrivals to the lake; latest temperatures to two sorted extracts.

    The raw input is read once: what the checks need is counted while the lake's new
    folders are written aside. They are published when the checks hold, and replace what
    the same files left there before.
    """
    raw, runs = _raw(spark, cfg)
    staged = lake.stage(clean_arrivals(raw, [lake.RUN]), cfg.lake, runs, apart=True)
    try:
        _check_extract(cfg, runs, staged.counts)
    except DataQualityError:
        lake.discard(spark, staged)
        raise
    if cfg.undated:
        _set_aside(spark, cfg, staged)
    lake.commit(spark, staged, "lake" if cfg.whole_lake else "month")
    with scratch(spark):
        if cfg.country_temps_csv:
            history = readers.read_temps(spark, cfg.country_temps_csv, schemas.COUNTRY_TEMPS)
            writers.write_sorted(latest_country_temps(history), cfg.country_temps, "Country")
        if cfg.city_temps_csv:
            history = readers.read_temps(spark, cfg.city_temps_csv, schemas.CITY_TEMPS)
            writers.write_sorted(latest_city_temps(history), cfg.city_temps, "City")
    return staged.counts


def setup_job(spark: SparkSession, cfg: JobConfig) -> None:
    """Empty warehouse tables, then the lookups and temperatures in staging.

    A lookup that breaks its table's NOT NULL or length rules ends the job before anything
    changes.
    """
    lookups = readers.read_lookups(spark, cfg.lookups)
    if cfg.constraints:
        for table, lookup in lookups.items():
            quality.check_table(lookup, schemas.TABLES[table], {}, unique=False)
    create_warehouse(spark, cfg.database, cfg.warehouse_location)
    for table, lookup in lookups.items():
        writers.write_staging(lookup, cfg.table(table), truncate=True)
    for table, path in (("staging_city_temperatures", cfg.city_temps),
                        ("staging_country_temperatures", cfg.country_temps)):
        if path:
            extract = readers.stage_parquet(spark, path, schemas.TABLES[table].schema)
            writers.write_staging(extract, cfg.table(table), truncate=True)


class _Batch:
    """The tables as a batch would leave them: nothing shows before `publish`."""

    def __init__(self, spark: SparkSession, cfg: JobConfig):
        self.spark, self.cfg = spark, cfg
        self.added: dict[str, DataFrame] = {}
        self.replaced: dict[str, DataFrame] = {}

    def table(self, name: str) -> DataFrame:
        if name in self.replaced:
            return self.replaced[name]
        stored = self.spark.table(self.cfg.table(name))
        return stored.unionByName(self.added[name]) if name in self.added else stored

    def add(self, rows: DataFrame, name: str) -> None:
        """Check the dimension as it would become. The 'keep' rule admits repeated keys;
        unique keys are then not checked."""
        rows = settle(rows, name)
        # Most days add nothing; an empty append would leave an empty file.
        if rows.isEmpty():
            return
        if self.cfg.constraints:
            spec = schemas.TABLES[name]
            parents = {fk.parent: self.table(fk.parent) for fk in spec.foreign_keys}
            quality.check_table(self.table(name).unionByName(rows), spec, parents,
                                unique=self.cfg.in_batch == "first")
        self.added[name] = rows

    def add_dimensions(self, staging: DataFrame, codes: DataFrame) -> None:
        """What the batch adds to each dimension, in the order of their references."""
        cfg, table, add = self.cfg, self.table, self.add
        add(dimensions.build_ports(
            codes, table("staging_ports"), table("staging_city_temperatures"),
            table("dim_ports"), cfg.in_batch), "dim_ports")
        add(dimensions.build_airports(
            table("staging_airports"), table("dim_ports"), table("dim_airports"),
            cfg.in_batch), "dim_airports")
        add(dimensions.build_demographics(
            table("dim_ports"), table("staging_demographics"), codes,
            table("dim_demographics"), cfg.in_batch, cfg.null_safe), "dim_demographics")
        add(dimensions.build_time(staging, table("dim_time"), cfg.in_batch), "dim_time")
        add(dimensions.build_countries(
            codes, table("staging_countries"), table("staging_country_temperatures"),
            table("dim_countries"), cfg.in_batch), "dim_countries")

    def stage_fact(self, staging: DataFrame, codes: DataFrame, mine: Column) -> FactCounts:
        """Write the batch's fact rows aside; `mine` are the stored rows that they replace."""
        name = "fact_immigration"
        stored = self.table(name)
        rows, seen = observed_batch(
            staging, self.table("dim_countries"), self.table("dim_ports"), codes)
        self.fact = writers.stage_batch(rows, self.cfg.table(name))
        self.replaced[name] = stored.where(~mine).unionByName(self.fact.rows)
        return fact_counts(seen)

    def check_fact(self) -> None:
        """Constraints of the fact rows of a batch, in one pass over them. Their ids are
        unique by construction; checking that would shuffle the whole fact."""
        spec = schemas.TABLES["fact_immigration"]
        if self.cfg.constraints:
            parents = {fk.parent: self.table(fk.parent) for fk in spec.foreign_keys}
            quality.check_table(self.fact.rows, spec, parents, unique=False)
        else:
            # What a table's VARCHAR columns refuse on insert.
            quality.check_lengths(self.fact.rows, spec.lengths)

    def check_as_asked(self, staging: DataFrame, start: datetime.date,
                       end: datetime.date) -> None:
        tables = {name: self.table(name) for name in schemas.TABLES} | {"staging": staging}
        for asked in self.cfg.checks:
            quality.check_sql(self.spark, asked, tables, start=start, end=end)

    def publish(self, days_: Iterable[datetime.date]) -> None:
        for name, rows in self.added.items():
            writers.append_to(rows, self.cfg.table(name))
        writers.publish_batch(self.spark, self.fact, "load_day", (d.isoformat() for d in days_))

    def discard(self) -> None:
        if hasattr(self, "fact"):
            writers.discard_batch(self.spark, self.fact)


def _days(start: datetime.date, end: datetime.date) -> list[datetime.date]:
    return [start + datetime.timedelta(days=n) for n in range((end - start).days + 1)]


def load_day(spark: SparkSession, cfg: JobConfig, day: datetime.date) -> FactCounts:
    """One arrival day from the lake to the warehouse; may be run again.

    The order is that of the references between the tables. Everything is written aside
    and checked first: a check that fails raises DataQualityError and leaves the
    dimensions and the fact as they were.
    """
    attach_warehouse(spark, cfg.database, cfg.warehouse_location)
    with scratch(spark):
        writers.write_staging(readers.read_day(spark, cfg.lake, day),
                              cfg.table("staging_immigration"), truncate=True)
        staging = spark.table(cfg.table("staging_immigration")).withColumn(
            "load_day", F.lit(day))
        quality.check_staged(staging)
        if cfg.constraints:
            spec = schemas.TABLES["staging_immigration"]
            quality.check_table(staging, spec, {}, unique=False)
        return _load(spark, cfg, staging, day, day)


def _load(spark: SparkSession, cfg: JobConfig, staging: DataFrame, start: datetime.date,
          end: datetime.date, allow_empty_days: bool = False) -> FactCounts:
    """Write, audit and publish the batch of the days from `start` to `end`."""
    batch = _Batch(spark, cfg)
    first, last = F.lit(start), F.lit(end)
    try:
        codes = settle(dimensions.code_counts(staging), "codes")
        quality.check_staged(codes)
        if not allow_empty_days:
            wanted = (end - start).days + 1
            quality.check(codes.agg(F.count_distinct("load_day").alias("days")),
                          lambda found: found == wanted, f"days with arrivals of {wanted}")
        batch.add_dimensions(staging, codes)
        counts = batch.stage_fact(staging, codes, F.col("load_day").between(first, last))
        batch.check_fact()
        fact, time = batch.table("fact_immigration"), batch.table("dim_time")
        arrived = fact.where(
            F.col("arrdate").between(days.day_number(first), days.day_number(last)))
        differing = quality.reconciliation(
            codes, batch.table("dim_countries"), batch.table("dim_ports"), arrived, time
        ).agg(F.count_if(F.col("difference") != 0).alias("days"))
        quality.check(differing, lambda number: number == 0, f"staging to fact, {start} to {end}")
        _check_counts(cfg, counts)
        batch.check_as_asked(staging, start, end)
    except BaseException:
        batch.discard()
        raise
    batch.publish(_days(start, end))
    return counts


def _check_counts(cfg: JobConfig, counts: FactCounts) -> None:
    """Each arrival is loaded or has a cause, and not too many have one. Under the 'keep'
    rule an arrival can be loaded more than once."""
    if counts.arrivals != counts.loaded + counts.no_country + counts.no_port:
        raise DataQualityError(f"arrivals without a cause: {counts}")
    lost = counts.no_country + counts.no_port
    if cfg.most_unmatched is not None and lost > cfg.most_unmatched * counts.arrivals:
        raise DataQualityError(f"unmatched arrivals: {lost} of {counts.arrivals}")


def backfill(spark: SparkSession, cfg: JobConfig, start: datetime.date,
             end: datetime.date) -> list[FactCounts]:
    """The days one after another, as scheduled runs would load them."""
    return [load_day(spark, cfg, day) for day in _days(start, end)]


def load_range(spark: SparkSession, cfg: JobConfig, start: datetime.date, end: datetime.date,
               allow_empty_days: bool | None = None) -> FactCounts:
    """All days of a range as one batch: the number of Spark jobs is that of a
    single day, on a first run and on later ones. With `null_safe` the dimensions and the
    fact equal those of `backfill` up to surrogate keys; without it `backfill` adds rows
    with NULL in a key once a day. Only `load_day` fills staging_immigration.

    The lake is read in place instead of being copied to staging, three times in
    all and only the columns needed: for the codes, the days and the fact. Its
    files hold one day each, so the fact is written without a shuffle.
    """
    attach_warehouse(spark, cfg.database, cfg.warehouse_location)
    with scratch(spark):
        staging = readers.read_days(spark, cfg.lake, start, end)
        return _load(spark, cfg, staging, start, end, cfg.allow_empty_days
                     if allow_empty_days is None else allow_empty_days)
