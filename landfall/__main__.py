"""Command line: python -m landfall JOB --config FILE, also through spark-submit.

The file is JSON with the fields of JobConfig. Load jobs take --day, or --start
and --end; extract takes --year. What a job counted is printed.
"""

from __future__ import annotations

import argparse
import dataclasses
import datetime
import json
from collections.abc import Sequence

from pyspark.sql import SparkSession

from landfall.plans import jobs

_DATE = datetime.date.fromisoformat


def read_config(path: str) -> jobs.JobConfig:
    with open(path) as file:
        fields = json.load(file)
    lookups = {table: tuple(source) for table, source in fields.pop("lookups", {}).items()}
    return jobs.JobConfig(lookups=lookups, **fields)


def main(arguments: Sequence[str] | None = None) -> None:
    parser = argparse.ArgumentParser(prog="landfall")
    commands = parser.add_subparsers(dest="job", required=True)
    for name in ("extract", "setup", "load-day", "backfill", "load-range"):
        command = commands.add_parser(name)
        command.add_argument("--config", required=True)
        if name == "extract":
            command.add_argument("--year", type=int, help="the monthly files of this year")
        if name == "load-range":
            command.add_argument("--allow-empty-days", action="store_true")
        if name == "load-day":
            command.add_argument("--day", type=_DATE, required=True)
        if name in ("backfill", "load-range"):
            command.add_argument("--start", type=_DATE, required=True)
            command.add_argument("--end", type=_DATE, required=True)
    given = parser.parse_args(arguments)

    spark = SparkSession.builder.appName(f"landfall {given.job}").getOrCreate()
    cfg = read_config(given.config)
    if given.job == "extract":
        if given.year is not None:
            cfg = dataclasses.replace(cfg, raw_year=given.year)
        print(jobs.extract_job(spark, cfg))
    elif given.job == "setup":
        jobs.setup_job(spark, cfg)
    elif given.job == "load-day":
        print(jobs.load_day(spark, cfg, given.day))
    elif given.job == "backfill":
        for counts in jobs.backfill(spark, cfg, given.start, given.end):
            print(counts)
    else:
        print(jobs.load_range(spark, cfg, given.start, given.end,
                              given.allow_empty_days or None))


if __name__ == "__main__":
    main()
