"""One Spark query per operator; each callable takes (spark, sf_dir)."""

from __future__ import annotations

import datetime
import zlib
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from landfall import schemas
from landfall.functions import codes, days
from landfall.operators import dimensions, fact as facts, latest, quality, upsert
from landfall.operators.clean import clean_arrivals
from landfall.plans import jobs, reports, warehouse
from landfall.session import exists, move, new_path, settle
from landfall.sources import lake, publish, readers, writers
from verification.tables import spark_view

Query = Callable[[SparkSession, str], DataFrame]

YEAR, MONTH = 1996, 12
DAY = datetime.date(1996, 12, 24)
# The arrivals before this day are the first batch, the others the second.
SECOND_BATCH = datetime.date(1998, 1, 1)
# The arrivals before this day are one raw file, the others another.
BOUNDARY = datetime.date(1996, 1, 1)

_QUERIES: dict[str, Query] = {}


# Integers that can be NULL; client libraries disagree on how to hold those.
_NULLABLE_INTEGERS = {"age", "birth_year", "depdate", "early_day"}


def _comparable(df: DataFrame) -> DataFrame:
    """Dates as text, decimals and nullable integers as doubles, so that no client
    library decides whether equal values look alike. The tests check the types."""
    def shown(name: str, dtype: str) -> Column:
        if dtype == "date":
            return F.col(name).cast("string").alias(name)
        if dtype.startswith("decimal") or (dtype == "int" and name in _NULLABLE_INTEGERS):
            return F.col(name).cast("double").alias(name)
        return F.col(name)

    return df.select(*[shown(name, dtype) for name, dtype in df.dtypes])


def _register(query: Query) -> Query:
    name = query.__name__.removesuffix("_query")
    _QUERIES[name] = lambda spark, sf_dir: _comparable(query(spark, sf_dir))
    return query


def all_queries() -> dict[str, Query]:
    return dict(_QUERIES)


# Inputs


def _staging(spark: SparkSession, sf: str) -> DataFrame:
    return readers.with_load_day(clean_arrivals(spark_view(spark, sf, "raw_arrivals")))


def _batches(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    staging = _staging(spark, sf)
    earlier = F.col("arrival_date") < F.lit(SECOND_BATCH)
    return staging.where(earlier), staging.where(~earlier)


def _city_temps(spark: SparkSession, sf: str) -> DataFrame:
    return latest.latest_city_temps(spark_view(spark, sf, "city_temps"))


def _country_temps(spark: SparkSession, sf: str) -> DataFrame:
    return latest.latest_country_temps(spark_view(spark, sf, "country_temps"))


def _ports(spark: SparkSession, sf: str) -> DataFrame:
    return dimensions.build_ports(
        _staging(spark, sf), spark_view(spark, sf, "lookup_ports"), _city_temps(spark, sf))


def _countries(spark: SparkSession, sf: str) -> DataFrame:
    return dimensions.build_countries(
        _staging(spark, sf), spark_view(spark, sf, "lookup_countries"),
        _country_temps(spark, sf))


# Tables as a load leaves them: stored once per session and shared by the queries
# that start from a loaded warehouse.

_stored: dict[tuple[str, str, str], str] = {}


def _store(spark: SparkSession, sf: str, name: str, write: Callable[[str], None]) -> str:
    key = (spark.sparkContext.applicationId, sf, name)
    if key not in _stored:
        path = new_path(spark, name)
        write(path)
        _stored[key] = path
    return _stored[key]


def _build(spark: SparkSession, sf: str, name: str) -> DataFrame:
    if name == "dim_ports":
        return _ports(spark, sf)
    if name == "dim_countries":
        return _countries(spark, sf)
    if name == "dim_time":
        return dimensions.build_time(_staging(spark, sf))
    ports = _dim(spark, sf, "dim_ports")
    if name == "dim_airports":
        return dimensions.build_airports(spark_view(spark, sf, "airports"), ports)
    return dimensions.build_demographics(
        ports, spark_view(spark, sf, "demographics"), _staging(spark, sf))


def _dim(spark: SparkSession, sf: str, name: str) -> DataFrame:
    path = _store(spark, sf, name, lambda to: _build(spark, sf, name).write.parquet(to))
    return spark.read.schema(schemas.TABLES[name].schema).parquet(path)


def _fact(spark: SparkSession, sf: str) -> DataFrame:
    return facts.build_fact(
        _staging(spark, sf), _dim(spark, sf, "dim_countries"), _dim(spark, sf, "dim_ports"))


def _loaded_fact(spark: SparkSession, sf: str) -> DataFrame:
    """The fact as a load leaves it: a catalog table partitioned by batch and arrival day."""
    name = f"landfall_fact_{zlib.crc32(sf.encode())}"

    def write(to: str) -> None:
        rows = facts.batch_fact(
            _staging(spark, sf), _dim(spark, sf, "dim_countries"), _dim(spark, sf, "dim_ports"))
        (rows.hint("rebalance", "load_day", "arrdate").write.mode("overwrite")
         .partitionBy(*schemas.TABLES["fact_immigration"].partitioned_by)
         .option("path", to).saveAsTable(name))

    _store(spark, sf, "fact_immigration", write)
    return spark.table(name)


def _lake(spark: SparkSession, sf: str) -> str:
    raw = spark_view(spark, sf, "raw_arrivals")
    return _store(spark, sf, "lake", lambda to: lake.write_lake(clean_arrivals(raw), to))


def _extracts(spark: SparkSession, sf: str) -> tuple[str, str]:
    """Three extracts to one lake, and the folder of what they counted: the arrivals before
    BOUNDARY filed late, those after it filed late, and the first ones again, corrected."""
    base = _store(spark, sf, "extracts", lambda to: None)
    if not exists(spark, f"{base}/counts"):
        early = F.col("arrdate") < days.day_number(F.lit(BOUNDARY))
        wrong, right = (spark_view(spark, sf, v) for v in ("raw_arrivals_late", "raw_arrivals"))
        steps = []
        for rows, folder in ((wrong.where(early), "early"), (wrong.where(~early), "later"),
                             (right.where(early), "early")):
            rows.write.mode("overwrite").parquet(f"{base}/{folder}")
            counts = jobs.extract_job(spark, jobs.JobConfig(
                database="", raw=f"{base}/{folder}", lake=f"{base}/lake",
                undated=f"{base}/undated"))
            aside = spark.read.parquet(f"{base}/undated").count()
            steps.append((len(steps) + 1, folder, counts.rows, counts.undated, counts.strays,
                          aside))
        spark.createDataFrame(
            steps, "step int, run string, rows long, undated long, strays long, aside long"
        ).write.parquet(f"{base}/counts")
    return f"{base}/lake", f"{base}/counts"


def _lake_days(spark: SparkSession, folder: str) -> tuple[datetime.date, datetime.date]:
    """First and last arrival day of the lake, from its partition columns."""
    days = readers.with_load_day(spark.read.parquet(folder))
    return tuple(days.agg(F.min("load_day"), F.max("load_day")).first())


def shared_inputs() -> dict[str, Callable[[SparkSession, str], object]]:
    """Stored tables that several queries start from, in the order in which to make them."""
    dims = {name: lambda spark, sf, name=name: _dim(spark, sf, name)
            for name in ("dim_countries", "dim_ports", "dim_time", "dim_airports",
                         "dim_demographics")}
    return {"lake": _lake, **dims, "fact_immigration": _loaded_fact, "extracts": _extracts}


# Scans


@_register
def raw_arrivals_scan(spark, sf):
    path = new_path(spark, "raw")
    spark_view(spark, sf, "raw_arrivals").write.parquet(path)
    return readers.read_raw_arrivals(spark, path)


@_register
def stage_ports_csv(spark, sf):
    path = new_path(spark, "ports-csv")
    (spark_view(spark, sf, "lookup_ports")
     .write.option("header", True).option("sep", ";").csv(path))
    return readers.stage_csv(spark, path, schemas.TABLES["staging_ports"].schema, sep=";")


@_register
def day_partition_scan(spark, sf):
    return readers.read_day(spark, _lake(spark, sf), DAY)


@_register
def lake_rewrite(spark, sf):
    """Rows per folder of a lake that two raw files fill, one of them a second time,
    corrected: no stale day of it stays, and all of the other's, in shared months too."""
    folder, _ = _extracts(spark, sf)
    return readers.read_lake(spark, folder).groupBy("year", "month", "arrival_day").agg(
        F.count("*").alias("rows"))


@_register
def extract_observed(spark, sf):
    """What each extract counted on its way, and the undated rows set aside after it."""
    return spark.read.parquet(_extracts(spark, sf)[1])


@_register
def month_files_scan(spark, sf):
    """Rows of all monthly raw files, each attributed to its file."""
    base = new_path(spark, "months")
    name = F.concat(F.lit("i94_"), F.lower(F.date_format(
        days.sas_date(F.col("arrdate")), "MMMyy")), F.lit("_sub"))
    (spark_view(spark, sf, "raw_arrivals").withColumn("file", name).hint("rebalance", "file")
     .write.partitionBy("file").parquet(f"{base}/written"))
    months = [f.removeprefix("file=") for f in publish.folders(spark, f"{base}/written", 1)]
    for month in months:
        move(spark, f"{base}/written/file={month}", f"{base}/raw/{month}")
    rows = readers.read_months(spark, f"{base}/raw", months)
    return rows.groupBy("run").agg(
        F.count("*").alias("rows"), F.min("arrdate").alias("first"), F.max("arrdate").alias("last"))


@_register
def temps_csv_scan(spark, sf):
    path = new_path(spark, "temps-csv")
    spark_view(spark, sf, "city_temps").write.option("header", True).csv(path)
    return readers.read_temps(spark, path, schemas.CITY_TEMPS)


@_register
def staged_parquet_scan(spark, sf):
    """A folder of Parquet files, by wildcard."""
    path = new_path(spark, "demographics")
    rows = spark_view(spark, sf, "demographics")
    rows.write.parquet(path)
    return readers.stage_parquet(spark, f"{path}/*.parquet", rows.schema).select(
        "City", "Race", F.col("Total Population").alias("total_population"))


@_register
def staged_json_scan(spark, sf):
    path = new_path(spark, "airports")
    rows = spark_view(spark, sf, "airports")
    rows.write.json(path)
    return readers.stage(spark, path, "json", rows.schema)


@_register
def lookups_scan(spark, sf):
    """Rows and distinct codes of each lookup, from delimited text."""
    base, found = new_path(spark, "lookups"), {}
    for table, view, sep in (
            ("staging_countries", "lookup_countries", ","), ("staging_ports", "lookup_ports", ";")):
        spark_view(spark, sf, view).write.option("header", True).option("sep", sep).csv(
            f"{base}/{table}")
        found[table] = (f"{base}/{table}", sep)
    countries, ports = readers.read_lookups(spark, found).values()
    return countries.agg(
        F.lit("countries").alias("lookup"), F.count("*").alias("rows"),
        F.count_distinct("country_code").alias("codes")
    ).union(ports.agg(F.lit("ports"), F.count("*"), F.count_distinct("port_code")))


@_register
def sorted_extract(spark, sf):
    """The ordered extract of the latest city temperatures, and the places, within its
    files and between them, at which it is out of order."""
    path = new_path(spark, "sorted")
    writers.write_sorted(_city_temps(spark, sf), path, "City")
    stored = spark.read.parquet(path)
    order = ["City", *[c for c in stored.columns if c != "City"]]
    breaks = quality.unordered(stored, order).agg(F.count("*").alias("breaks"))
    return stored.agg(
        F.count("*").alias("rows"), F.min("City").alias("first"), F.max("City").alias("last")
    ).join(F.broadcast(breaks), F.lit(True))


# Projections and functions


@_register
def clean_arrivals_query(spark, sf):
    return clean_arrivals(spark_view(spark, sf, "raw_arrivals"))


@_register
def sas_dates(spark, sf):
    raw = spark_view(spark, sf, "raw_arrivals")
    before_epoch = F.col("i94bir") - F.col("arrdate") / 8
    return raw.select(
        "arrdate", "depdate",
        days.sas_date(F.col("arrdate")).alias("arrival_date"),
        days.sas_day_of_month(F.col("arrdate")).alias("arrival_day"),
        days.sas_date(F.col("depdate")).alias("departure_date"),
        days.sas_date(before_epoch).alias("early_date"),
        days.sas_day_of_month(before_epoch).alias("early_day"))


@_register
def decode_mode(spark, sf):
    raw = spark_view(spark, sf, "raw_arrivals")
    return (raw.groupBy("i94mode", codes.decode_mode(F.col("i94mode")).alias("mode"))
            .agg(F.count("*").alias("arrivals")))


@_register
def decode_visa(spark, sf):
    raw = spark_view(spark, sf, "raw_arrivals")
    return (raw.groupBy("i94visa", codes.decode_visa(F.col("i94visa")).alias("visa_category"))
            .agg(F.count("*").alias("arrivals")))


@_register
def arrivals_by_month_filter(spark, sf):
    rows = reports.arrivals_on(
        _loaded_fact(spark, sf), _dim(spark, sf, "dim_time"), YEAR, MONTH)
    return rows.select("country_id", "port_id", "age", "travel_mode", "arrdate", "depdate",
                       "year", "month", "day", "day_of_week")


# Joins


@_register
def seen_countries(spark, sf):
    return dimensions.seen_codes(
        _staging(spark, sf), spark_view(spark, sf, "lookup_countries"), "country_code")


@_register
def seen_ports(spark, sf):
    return dimensions.seen_codes(
        _staging(spark, sf), spark_view(spark, sf, "lookup_ports"), "port_code")


@_register
def country_temp_enrich(spark, sf):
    return dimensions.enrich_ci(
        spark_view(spark, sf, "lookup_countries"), _country_temps(spark, sf), "country",
        "Country", ["AverageTemperature"])


@_register
def port_temp_enrich(spark, sf):
    return dimensions.enrich_ci(
        spark_view(spark, sf, "lookup_ports"), _city_temps(spark, sf), "city", "City",
        ["AverageTemperature"])


@_register
def new_keys_antijoin(spark, sf):
    first, second = _batches(spark, sf)
    lookup = spark_view(spark, sf, "lookup_ports")
    existing = dimensions.seen_codes(first, lookup, "port_code")
    seen = dimensions.seen_codes(second, lookup, "port_code").drop("first_seen")
    return upsert.absent(seen, existing, ["port_code"])


@_register
def ports_in_batch(spark, sf):
    first, _ = _batches(spark, sf)
    return dimensions.ports_in_batch(_dim(spark, sf, "dim_ports"), first)


@_register
def port_demographics_join(spark, sf):
    return dimensions.ports_x_demographics(
        _dim(spark, sf, "dim_ports"), spark_view(spark, sf, "demographics"))


@_register
def port_airports_join(spark, sf):
    return dimensions.ports_x_airports(
        spark_view(spark, sf, "airports"), _dim(spark, sf, "dim_ports"))


@_register
def fact_arrivals(spark, sf):
    return _fact(spark, sf)


@_register
def fact_arrivals_shuffled(spark, sf):
    """The star join as it runs when no dimension can be broadcast, hot codes salted."""
    staging = _staging(spark, sf)
    codes = settle(dimensions.code_counts(staging), "codes")
    return facts.observed_fact(
        staging, _dim(spark, sf, "dim_countries"), _dim(spark, sf, "dim_ports"), codes,
        shuffled=True)[0]


@_register
def new_demographics_antijoin(spark, sf):
    first, _ = _batches(spark, sf)
    ports, rows = _dim(spark, sf, "dim_ports"), spark_view(spark, sf, "demographics")
    existing = dimensions.ports_x_demographics(dimensions.ports_in_batch(ports, first), rows)
    return upsert.absent(
        dimensions.ports_x_demographics(ports, rows).distinct(), existing, ["port_id", "race"])


# Aggregation, distinct, latest rows


@_register
def staging_count(spark, sf):
    return quality.count_rows(_staging(spark, sf))


@_register
def staging_fact_diff(spark, sf):
    return quality.staging_fact_diff(
        _staging(spark, sf), _dim(spark, sf, "dim_countries"), _dim(spark, sf, "dim_ports"),
        _loaded_fact(spark, sf), _dim(spark, sf, "dim_time"), DAY)


@_register
def latest_city_temps(spark, sf):
    return _city_temps(spark, sf)


@_register
def latest_country_temps(spark, sf):
    return _country_temps(spark, sf)


@_register
def distinct_days_union(spark, sf):
    return dimensions.distinct_days(_staging(spark, sf))


# Upserts, dimensions


def _countries_after_first_batch(spark, sf, in_batch):
    first, second = _batches(spark, sf)
    lookup, temps = spark_view(spark, sf, "lookup_countries"), _country_temps(spark, sf)
    existing = settle(dimensions.build_countries(first, lookup, temps, in_batch=in_batch))
    return dimensions.build_countries(second, lookup, temps, existing, in_batch)


@_register
def insert_if_absent_first(spark, sf):
    return _countries_after_first_batch(spark, sf, "first")


@_register
def insert_if_absent_keep(spark, sf):
    return _countries_after_first_batch(spark, sf, "keep")


@_register
def dim_countries(spark, sf):
    return _countries(spark, sf)


@_register
def dim_ports(spark, sf):
    return _ports(spark, sf)


@_register
def dim_airports(spark, sf):
    return _build(spark, sf, "dim_airports")


@_register
def dim_demographics(spark, sf):
    return _build(spark, sf, "dim_demographics")


@_register
def dim_time(spark, sf):
    return _build(spark, sf, "dim_time")


# Quality


@_register
def unique_violations(spark, sf):
    """Natural keys of the inputs that repeat, one block per key."""
    inputs = [
        ("country", spark_view(spark, sf, "lookup_countries"), ["country"]),
        ("ident", spark_view(spark, sf, "airports"), ["ident"]),
        ("city_state_race", spark_view(spark, sf, "demographics"),
         ["City", "State Code", "Race"]),
    ]
    blocks = [
        quality.unique_violations(df, keys).select(
            F.lit(name).alias("constraint_name"),
            F.concat_ws("|", *[F.col(f"`{k}`") for k in keys]).alias("key_value"),
            "occurrences")
        for name, df, keys in inputs
    ]
    return blocks[0].union(blocks[1]).union(blocks[2])


@_register
def fk_orphans(spark, sf):
    """Orphans of the six foreign keys, and of the codes in the arrivals."""
    tables = {name: _dim(spark, sf, name) for name in (
        "dim_ports", "dim_countries", "dim_time", "dim_airports", "dim_demographics")}
    tables["fact_immigration"] = _loaded_fact(spark, sf)
    links = [
        (f"{name}.{fk.column}", tables[name], fk.column, tables[fk.parent], fk.parent_column)
        for name in ("dim_airports", "dim_demographics", "fact_immigration")
        for fk in schemas.TABLES[name].foreign_keys
    ]
    staging = _staging(spark, sf)
    links += [
        ("arrivals.country_code", staging, "country_code",
         spark_view(spark, sf, "lookup_countries"), "country_code"),
        ("arrivals.port_code", staging, "port_code",
         spark_view(spark, sf, "lookup_ports"), "port_code"),
    ]
    return quality.fk_orphan_counts(links)


@_register
def null_violations(spark, sf):
    return quality.null_counts(_staging(spark, sf), schemas.CLEAN_ARRIVALS.fieldNames())


@_register
def length_violations(spark, sf):
    return quality.length_counts(
        spark_view(spark, sf, "airports"), {"ident": 3, "type": 8, "name": 256, "iata_code": 2})


@_register
def partition_mismatch(spark, sf):
    return quality.partition_mismatch(
        clean_arrivals(spark_view(spark, sf, "raw_arrivals_late")))


@_register
def unmatched_codes(spark, sf):
    staging = _staging(spark, sf)
    countries = quality.unmatched_codes(
        staging, spark_view(spark, sf, "lookup_countries"), "country_code")
    ports = quality.unmatched_codes(
        staging, spark_view(spark, sf, "lookup_ports"), "port_code")
    return (
        countries.select(F.lit("country").alias("kind"), F.col("country_code").alias("code"),
                         "arrivals")
        .union(ports.select(F.lit("port"), "port_code", "arrivals")))


@_register
def extract_accounting(spark, sf):
    """Every arrival is loaded or has a cause, with some filed under a wrong or no day."""
    filed = (
        clean_arrivals(spark_view(spark, sf, "raw_arrivals"))
        .withColumn("month", F.when(F.col("age") % 7 == 0, 2).otherwise(F.col("month")))
        .withColumn("arrival_day", F.when(F.col("age") % 11 != 0, F.col("arrival_day"))))
    return quality.accounting(
        readers.with_load_day(filed), spark_view(spark, sf, "lookup_countries"),
        spark_view(spark, sf, "lookup_ports"))


@_register
def fact_ids(spark, sf):
    """Ids of the loaded fact: how many rows, distinct ids and NULLs."""
    return _loaded_fact(spark, sf).agg(
        F.count("*").alias("fact_rows"), F.count_distinct("immigration_id").alias("ids"),
        F.count_if(F.col("immigration_id").isNull()).alias("nulls"))


@_register
def user_checks(spark, sf):
    """Checks given as data, over the loaded tables: which of them hold."""
    tables = {"fact_immigration": _loaded_fact(spark, sf),
              "dim_ports": _dim(spark, sf, "dim_ports"),
              "dim_time": _dim(spark, sf, "dim_time")}
    asked = [
        {"name": "loaded", "sql": "SELECT count(*) FROM {fact_immigration} WHERE load_day = :day",
         "expect": "not_zero"},
        {"name": "no age", "sql": "SELECT count(*) FROM {fact_immigration} WHERE age IS NULL",
         "expect": "zero"},
        {"name": "age", "sql": "SELECT max(age) FROM {fact_immigration}", "expect": "between",
         "values": [19, 68]},
        {"name": "few ports", "sql": "SELECT count(*) FROM {dim_ports}", "expect": "at_most",
         "values": [3]},
        {"name": "calendar", "sql": "SELECT bool_and(month <= :months) FROM {dim_time}",
         "expect": "true", "parameters": {"months": 12}},
    ]

    def holds(check: dict) -> bool:
        try:
            quality.check_sql(spark, check, tables, day=DAY)
        except quality.DataQualityError:
            return False
        return True

    return spark.createDataFrame([(c["name"], holds(c)) for c in asked], "name string, held boolean")


# Jobs


@_register
def load_day_counts(spark, sf):
    """The range load of all days, from lake to warehouse tables, then the rows
    staged and loaded per batch day."""
    cfg = _warehouse(spark, sf, "landfall_check")
    first, last = _lake_days(spark, cfg.lake)
    jobs.load_range(spark, cfg, first, last, allow_empty_days=True)
    tables = warehouse.tables_of(spark, cfg.database)
    codes = dimensions.code_counts(readers.read_days(spark, cfg.lake, first, last))
    return quality.reconciliation(
        codes, tables["dim_countries"], tables["dim_ports"], tables["fact_immigration"],
        tables["dim_time"])


def _warehouse(spark: SparkSession, sf: str, database: str) -> jobs.JobConfig:
    """A warehouse as after setup, over the whole lake."""
    cfg = jobs.JobConfig(database=database, lake=_lake(spark, sf),
                         warehouse_location=new_path(spark, "warehouse"))
    spark.sql(f"DROP DATABASE IF EXISTS {database} CASCADE")
    jobs.setup_job(spark, cfg)
    for table, view in (
            ("staging_countries", "lookup_countries"), ("staging_ports", "lookup_ports"),
            ("staging_airports", "airports"), ("staging_demographics", "demographics")):
        writers.write_staging(spark_view(spark, sf, view), cfg.table(table), truncate=True)
    writers.write_staging(
        _city_temps(spark, sf), cfg.table("staging_city_temperatures"), truncate=True)
    writers.write_staging(
        _country_temps(spark, sf), cfg.table("staging_country_temperatures"), truncate=True)
    return cfg


def _loaded_twice(spark, cfg, load) -> DataFrame:
    """What the second of two equal loads counted, with the rows and ids it left, per table
    state the same as after the first."""
    def state() -> tuple:
        t = warehouse.tables_of(spark, cfg.database)
        fact = t["fact_immigration"].agg(F.count("*"), F.count_distinct("immigration_id")).first()
        return (*fact, t["dim_ports"].count(), t["dim_countries"].count(), t["dim_time"].count())

    load()
    before = state()
    counts, after = load(), state()
    return spark.createDataFrame(
        [(counts.arrivals, counts.no_country, counts.no_port, counts.loaded, after[0], after[1],
          before == after)],
        "arrivals long, no_country long, no_port long, loaded long, fact_rows long, ids long, "
        "unchanged boolean")


@_register
def load_day_rerun(spark, sf):
    """One day loaded twice: written aside, audited, published by partition."""
    cfg = _warehouse(spark, sf, "landfall_day")
    return _loaded_twice(spark, cfg, lambda: jobs.load_day(spark, cfg, DAY))


@_register
def range_rerun(spark, sf):
    """A month loaded twice as one batch."""
    cfg = _warehouse(spark, sf, "landfall_range")
    first, last = datetime.date(YEAR, MONTH, 1), datetime.date(YEAR, MONTH, 31)
    return _loaded_twice(
        spark, cfg, lambda: jobs.load_range(spark, cfg, first, last, allow_empty_days=True))


# Reports


@_register
def top_countries(spark, sf):
    return reports.top_countries(
        _loaded_fact(spark, sf), _dim(spark, sf, "dim_countries"), _dim(spark, sf, "dim_time"),
        YEAR, MONTH)


@_register
def top_ports(spark, sf):
    return reports.top_ports(
        _loaded_fact(spark, sf), _dim(spark, sf, "dim_ports"), _dim(spark, sf, "dim_time"),
        YEAR, MONTH)


@_register
def arrivals_by_dow(spark, sf):
    return reports.arrivals_by_dow(
        _loaded_fact(spark, sf), _dim(spark, sf, "dim_ports"), _dim(spark, sf, "dim_time"),
        YEAR, MONTH)


@_register
def port_country_counts(spark, sf):
    return reports.port_country_counts(
        _loaded_fact(spark, sf), _dim(spark, sf, "dim_ports"), _dim(spark, sf, "dim_countries"))


@_register
def demographics_by_origin(spark, sf):
    return reports.demographics_by_origin(
        _loaded_fact(spark, sf), _dim(spark, sf, "dim_ports"), _dim(spark, sf, "dim_countries"),
        _dim(spark, sf, "dim_demographics"))


@_register
def temp_correlation(spark, sf):
    return reports.temp_correlation(
        _loaded_fact(spark, sf), _dim(spark, sf, "dim_ports"), _dim(spark, sf, "dim_countries"))


@_register
def seasonality(spark, sf):
    return reports.seasonality(
        _loaded_fact(spark, sf), _dim(spark, sf, "dim_ports"), _dim(spark, sf, "dim_time"))

