"""Scans: raw monthly arrivals, delimited text, Parquet and the day-partitioned lake."""

from __future__ import annotations

import datetime
import re
from collections.abc import Iterable, Sequence
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from landfall import schemas
from landfall.functions import days
from landfall.session import list_paths

# Month part of the raw file names.
MONTHS = ("jan", "feb", "mar", "apr", "may", "jun", "jul", "aug", "sep", "oct", "nov", "dec")


def month_paths(base: str, year: int, months: Iterable[int] = range(1, 13),
                suffix: str = "") -> list[str]:
    """One path per month below `base`, such as base/i94_jan16_sub."""
    return [f"{base}/i94_{MONTHS[m - 1]}{year % 100:02d}_sub{suffix}" for m in months]


def read_raw_arrivals(spark: SparkSession, path: str | list[str], fmt: str = "parquet",
                      months: list[str] | None = None, **options) -> DataFrame:
    """Raw arrivals in one scan; `months` names the files below `path` to read."""
    paths = [f"{path}/{month}" for month in months] if months else path
    return spark.read.schema(schemas.RAW_ARRIVALS).format(fmt).options(**options).load(paths)


def check_months(spark: SparkSession, base: str, months: Sequence[str]) -> None:
    """Each monthly file is named once and is there, once."""
    twice = sorted({m for m in months if months.count(m) > 1})
    if twice:
        raise ValueError(f"months named twice: {twice}")
    for month in months:
        stem = month.split(".", 1)[0]
        there = {path.rsplit("/", 1)[1]
                 for pattern in (stem, f"{stem}.*")
                 for path in list_paths(spark, f"{base}/{pattern}")}
        if month not in there:
            raise FileNotFoundError(f"no file {month} below {base}")
        if len(there) > 1:
            raise ValueError(f"a month in several files: {sorted(there)}")


def read_months(spark: SparkSession, base: str, months: Sequence[str], fmt: str = "parquet",
                **options) -> DataFrame:
    """Raw arrivals of the monthly files `months` below `base`, with a column `run` that
    names the file of each row, in one scan.

    A month that is missing, named twice or there in two files is an error. A source that
    does not tell the file of a row is read file by file.
    """
    check_months(spark, base, months)
    together = read_raw_arrivals(spark, base, fmt, list(months), **options)
    place = f".*/{re.escape(base.rstrip('/').rsplit('/', 1)[1])}/([^/]+)"
    try:
        return together.select("*", F.regexp_extract("_metadata.file_path", place, 1).alias("run"))
    except AnalysisException:
        single = [read_raw_arrivals(spark, base, fmt, [m], **options).withColumn("run", F.lit(m))
                  for m in months]
        return reduce(DataFrame.unionByName, single)


def month_of_file(name: str) -> tuple[int, int] | None:
    """(year, month) of a raw file by its name; years are of this century from 60 down."""
    found = re.match(r"i94_([a-z]{3})(\d\d)_sub", name)
    if not found or found[1] not in MONTHS:
        return None
    year = int(found[2])
    return year + (2000 if year < 60 else 1900), MONTHS.index(found[1]) + 1


def stage_csv(spark: SparkSession, path: str, schema: T.StructType, sep: str = ",",
              multiline: bool = False) -> DataFrame:
    """Delimited text with a header row and columns by position.

    As in a bulk COPY, a doubled quote stands for a quote, an empty field is NULL
    but a quoted empty one is not, and a malformed line fails the load. `multiline`
    admits line breaks inside quotes, at the price of one task per file.
    """
    return (
        spark.read.schema(schema)
        .option("header", True).option("sep", sep)
        .option("quote", '"').option("escape", '"')
        # Spark also takes "" for NULL as long as the NULL mark is empty text.
        .option("nullValue", "\0").option("emptyValue", "")
        .option("multiLine", multiline).option("mode", "FAILFAST")
        .csv(path)
    )


def read_temps(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Temperature history by city or by country."""
    return stage_csv(spark, path, schema)


def stage(spark: SparkSession, path: str, fmt: str, schema: T.StructType | None = None,
          **options) -> DataFrame:
    """Load of any format Spark knows; avro needs its package on the cluster."""
    reader = spark.read.format(fmt).options(**options)
    return (reader.schema(schema) if schema else reader).load(path)


def stage_parquet(spark: SparkSession, path: str,
                  schema: T.StructType | None = None) -> DataFrame:
    """A Parquet directory or a wildcard such as dir/*.parquet."""
    return stage(spark, path, "parquet", schema)


def read_lake(spark: SparkSession, lake: str) -> DataFrame:
    return spark.read.schema(schemas.CLEAN_ARRIVALS).parquet(lake)


def read_day(spark: SparkSession, lake: str, day: datetime.date) -> DataFrame:
    """One day of the lake, read by its directory.

    Only that directory is listed, so the cost does not grow with the number of
    days in the lake. A day without a directory is an empty batch.
    """
    path = f"{lake}/year={day.year}/month={day.month}/arrival_day={day.day}"
    reader = spark.read.schema(schemas.CLEAN_ARRIVALS).option("basePath", lake)
    try:
        return reader.parquet(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schemas.CLEAN_ARRIVALS)


def lake_days(spark: SparkSession, lake: str, start: datetime.date,
              end: datetime.date) -> list[str]:
    """Folders of the days from `start` to `end` that are there. Only the months of the
    range are listed, those of a year in one call."""
    found = []
    for year in range(start.year, end.year + 1):
        first = start.month if year == start.year else 1
        last = end.month if year == end.year else 12
        months = ",".join(str(m) for m in range(first, last + 1))
        for path in list_paths(spark, f"{lake}/year={year}/month={{{months}}}/arrival_day=*"):
            month, day = re.search(r"month=(\d+)/arrival_day=(\w+)$", path).groups()
            if not day.isdigit():
                continue
            if (start.month, start.day) > (int(month), int(day)) and year == start.year:
                continue
            if (end.month, end.day) < (int(month), int(day)) and year == end.year:
                continue
            found.append(f"{lake}/year={year}/month={month}/arrival_day={day}")
    return found


def read_days(spark: SparkSession, lake: str, start: datetime.date,
              end: datetime.date) -> DataFrame:
    """The days from `start` to `end`, both included, with their `load_day`.

    The days are read by their directories, so the rest of the lake is not listed.
    """
    paths = lake_days(spark, lake, start, end)
    if paths:
        rows = spark.read.schema(schemas.CLEAN_ARRIVALS).option("basePath", lake).parquet(*paths)
    else:
        rows = spark.createDataFrame([], schemas.CLEAN_ARRIVALS)
    # A folder may name no real day, such as the 31st of a short month.
    return with_load_day(rows).where(F.col("load_day").between(F.lit(start), F.lit(end)))


def with_load_day(clean: DataFrame) -> DataFrame:
    """Adds the batch a row belongs to: its lake partition as a date."""
    return clean.withColumn(
        "load_day",
        days.date_of_parts(F.col("year"), F.col("month"), F.col("arrival_day")))


def read_lookups(spark: SparkSession, paths: dict[str, tuple[str, str]]) -> dict[str, DataFrame]:
    """Static lookups as {table: (path, separator)}, with the schema of each table."""
    return {
        table: stage_csv(spark, path, schemas.TABLES[table].schema, sep)
        for table, (path, sep) in paths.items()
    }
