import dataclasses
import datetime
import json
import os
import subprocess
import sys
import uuid

import pytest
from pyspark.sql import functions as F

from conftest import rows
from landfall import schemas
from landfall.functions import days
from landfall.operators.clean import clean_arrivals
from landfall.operators.quality import DataQualityError
from landfall.operators.fact import day_start
from landfall.plans import jobs, reports, warehouse
from landfall.session import settle
from landfall.sources import lake as lakes, readers, writers

D = datetime.date
ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
START, END = D(2016, 1, 1), D(2016, 1, 4)

# (arrival day, country, port, days stayed): MEX's name has two codes, 583 first
# arrives on day 2 and 407 on day 3; ports appear one by one; some codes are unknown.
ARRIVALS = [
    (1, 582, "NYC", 4), (1, 582, "NYC", None), (1, 124, "NYC", 40), (1, 999, "NYC", 1),
    (2, 583, "KET", 2), (2, 582, "KET", None), (2, 582, "???", 1),
    (3, 407, "NYC", 5), (3, 407, "5KE", None), (3, 124, "5KE", 366),
    (4, 124, "NYC", 3), (4, 583, "5KE", 3),
]


def raw(spark, arrivals):
    data = []
    for day, country, port, stay in arrivals:
        number = float((D(2016, 1, day) - days.EPOCH).days)
        data.append((2016.0, 1.0, float(country), port, number, 1.0,
                     None if stay is None else number + stay, 30.0, 2.0, 1986.0, "F", "B2"))
    return spark.createDataFrame(data, schemas.RAW_ARRIVALS)


def csv(path, name, header, *lines):
    target = path(name)
    with open(target, "w") as out:
        out.write("\n".join([header, *lines]) + "\n")
    return target


@pytest.fixture(scope="module")
def extracted(spark, tmp_path_factory):
    """Inputs on disk and the lake and extracts made of them."""
    folder = tmp_path_factory.mktemp("jobs")

    def path(name):
        return str(folder / name)

    raw(spark, ARRIVALS).write.parquet(path("raw"))
    config = jobs.JobConfig(
        database="", raw=path("raw"), lake=path("lake"),
        city_temps_csv=csv(
            path, "city.csv", "dt,AverageTemperature,AverageTemperatureUncertainty,City,Country,"
            "Latitude,Longitude", "2013-08-01,20.5,0.1,New York,United States,40N,74W",
            "2013-07-01,25.5,0.1,New York,United States,40N,74W",
            "2013-08-01,19.5,0.1,New York,United States,41N,75W",
            "2013-08-01,1.0,0.1,Ketchikan,Canada,55N,131W"),
        country_temps_csv=csv(
            path, "country.csv", "dt,AverageTemperature,AverageTemperatureUncertainty,Country",
            "2013-08-01,15.25,0.1,Norway", "2013-09-01,,,Norway"),
        city_temps=path("city_temps"), country_temps=path("country_temps"),
        lookups={
            "staging_countries": (csv(path, "countries.csv", "Code,Country", "582,MEXICO",
                                      "124,NORWAY", "583,INVALID: UNITED STATES",
                                      "407,INVALID: UNITED STATES"), ","),
            "staging_ports": (csv(path, "ports.csv", "Code,City,State", "NYC,NEW YORK,NY",
                                  "KET,KETCHIKAN,AK", "5KE,KETCHIKAN,AK", "XXX,NONE,ZZ"), ","),
            "staging_airports": (csv(
                path, "airports.csv", "ident,type,name,elevation_ft,continent,iso_country,"
                "iso_region,municipality,gps_code,iata_code,local_code,coordinates",
                'KET,small,Ketchikan Intl,89,NA,US,US-AK,Ketchikan,KET,KTN,KTN,"55.3, -131.7"',
                'JFK,large,Kennedy,13,NA,US,US-NY,New York,KJFK,JFK,JFK,"40.6, -73.7"'), ","),
            "staging_demographics": (csv(
                path, "demographics.csv", "City;State;Median Age;Male;Female;Total;Veterans;"
                "Foreign;Household;Code;Race;Count",
                "New York;New York;36.0;1;2;3;4;5;2.68;NY;White;100",
                "New York;New York;36.0;1;2;3;4;5;2.68;NY;Asian;50",
                "Ketchikan;Alaska;35.0;1;2;3;4;5;2.50;ak;White;10"), ";"),
        })
    jobs.extract_job(spark, config)
    return config


@pytest.fixture
def cfg(spark, extracted):
    """A warehouse of its own for each test."""
    config = dataclasses.replace(extracted, database=f"wh_{uuid.uuid4().hex[:8]}")
    jobs.setup_job(spark, config)
    yield config
    spark.sql(f"DROP DATABASE IF EXISTS {config.database} CASCADE")


def contents(spark, cfg):
    """Tables with natural keys in place of the surrogate ones."""
    t = warehouse.tables_of(spark, cfg.database)
    ports = t["dim_ports"].select("port_id", "port_code")
    countries = t["dim_countries"].select("country_id", "country_code")
    return {
        "countries": rows(t["dim_countries"].drop("country_id")),
        "ports": rows(t["dim_ports"].drop("port_id")),
        "airports": rows(t["dim_airports"].join(ports, "port_id").drop("port_id", "airport_id")),
        "demographics": rows(t["dim_demographics"].join(ports, "port_id")
                             .drop("port_id", "demographics_id")),
        "time": rows(t["dim_time"]),
        "fact": rows(t["fact_immigration"].join(ports, "port_id").join(countries, "country_id")
                     .drop("port_id", "country_id", "immigration_id")),
    }


def ids(spark, cfg):
    return [r[0] for r in spark.table(cfg.table("fact_immigration"))
            .select("immigration_id").collect()]


def test_setup_loads_lookups_and_extracts(spark, cfg):
    t = warehouse.tables_of(spark, cfg.database)
    assert {n: t[n].count() for n in t} == {
        "staging_immigration": 0, "staging_countries": 4, "staging_ports": 4,
        "staging_airports": 2, "staging_demographics": 3, "staging_city_temperatures": 2,
        "staging_country_temperatures": 1, "dim_countries": 0, "dim_ports": 0,
        "dim_airports": 0, "dim_demographics": 0, "dim_time": 0, "fact_immigration": 0}
    jobs.setup_job(spark, cfg)
    assert spark.table(cfg.table("staging_ports")).count() == 4


def test_extract_again_does_not_duplicate(spark, cfg):
    jobs.extract_job(spark, cfg)
    assert spark.read.parquet(cfg.lake).count() == len(ARRIVALS)


def test_load_day(spark, cfg):
    jobs.load_day(spark, cfg, START)
    got = contents(spark, cfg)
    assert [c[:2] for c in got["countries"]] == [("124", "NORWAY"), ("582", "MEXICO")]
    assert [str(c[2]) for c in got["countries"]] == ["15.250", "None"]
    assert [(p[0], str(p[3])) for p in got["ports"]] == [("NYC", "19.500")]
    assert got["airports"] == [] and len(got["demographics"]) == 2
    assert len(got["fact"]) == 3
    # Day numbers of all staged arrivals, also of the one with an unknown country.
    assert [t[0] for t in got["time"]] == [20454, 20455, 20458, 20494]
    assert spark.table(cfg.table("staging_immigration")).count() == 4


def test_a_day_loaded_twice_equals_once(spark, cfg):
    jobs.load_day(spark, cfg, START)
    jobs.load_day(spark, cfg, D(2016, 1, 2))
    before, numbers = contents(spark, cfg), ids(spark, cfg)
    jobs.load_day(spark, cfg, START)
    assert contents(spark, cfg) == before
    assert sorted(ids(spark, cfg)) == sorted(numbers) and len(set(numbers)) == len(numbers)


def test_an_empty_day_fails(spark, cfg):
    with pytest.raises(DataQualityError, match="staging row count"):
        jobs.load_day(spark, cfg, D(2016, 1, 5))
    with pytest.raises(DataQualityError, match="days with arrivals"):
        jobs.load_range(spark, cfg, START, D(2016, 1, 5))


def test_range_equals_backfill(spark, cfg):
    jobs.backfill(spark, cfg, START, END)
    one_by_one, numbers = contents(spark, cfg), ids(spark, cfg)
    assert len(set(numbers)) == len(numbers) == len(one_by_one["fact"])
    # Code 407 comes a day after 583, which has taken the name.
    assert [c[0] for c in one_by_one["countries"]] == ["124", "582", "583"]
    jobs.setup_job(spark, cfg)
    jobs.load_range(spark, cfg, START, END)
    assert contents(spark, cfg) == one_by_one
    assert len(set(ids(spark, cfg))) == len(numbers)


def test_reports_on_the_loaded_tables(spark, cfg):
    """Counted by hand from ARRIVALS: of twelve, one has an unknown port, one an unknown
    country, and the two of code 407 have a name that code 583 took before."""
    jobs.load_range(spark, cfg, START, END)
    t = warehouse.tables_of(spark, cfg.database)
    fact, ports, countries = t["fact_immigration"], t["dim_ports"], t["dim_countries"]
    time = t["dim_time"]
    us = "INVALID: UNITED STATES"
    assert [tuple(r) for r in reports.top_countries(
        fact, countries, time, 2016, 1, k=3).collect()] == [
        ("MEXICO", 3), ("NORWAY", 3), (us, 2)]
    assert rows(reports.top_countries(fact, countries, time, 2016, 1, k=2)) == [
        ("MEXICO", 3), ("NORWAY", 3)]
    assert rows(reports.top_ports(fact, ports, time, 2016, 1, k=1)) == [("NEW YORK", "NY", 4)]
    # January 1 was a Friday.
    assert rows(reports.arrivals_by_dow(fact, ports, time, 2016, 1)) == [
        (0, 1), (1, 2), (5, 3), (6, 2)]
    assert rows(reports.port_country_counts(fact, ports, countries)) == [
        ("KETCHIKAN", us, 2), ("KETCHIKAN", "MEXICO", 1), ("KETCHIKAN", "NORWAY", 1),
        ("NEW YORK", "MEXICO", 2), ("NEW YORK", "NORWAY", 2)]
    assert rows(reports.seasonality(fact, ports, time)) == [("AK", 1, 4, 1), ("NY", 1, 4, 1)]
    # Four arrivals of day 1 and 2 in two ports; each race row shows the port's count.
    by_origin = reports.demographics_by_origin(fact, ports, countries, t["dim_demographics"])
    assert rows(by_origin, "port_code", "country", "race", "arrivals") == [
        ("5KE", us, "White", 1), ("5KE", "NORWAY", "White", 1),
        ("KET", us, "White", 1), ("KET", "MEXICO", "White", 1),
        ("NYC", "MEXICO", "Asian", 2), ("NYC", "MEXICO", "White", 2),
        ("NYC", "NORWAY", "Asian", 2), ("NYC", "NORWAY", "White", 2)]


def test_range_over_loaded_days_and_again(spark, cfg):
    jobs.load_day(spark, cfg, D(2016, 1, 2))
    jobs.load_range(spark, cfg, START, END)
    once = contents(spark, cfg)
    jobs.load_range(spark, cfg, START, END)
    assert contents(spark, cfg) == once
    jobs.load_day(spark, cfg, D(2016, 1, 3))
    assert contents(spark, cfg) == once
    assert len(set(ids(spark, cfg))) == len(once["fact"])


def test_range_with_empty_days_allowed(spark, cfg):
    jobs.load_range(spark, cfg, D(2015, 12, 30), D(2016, 1, 9), allow_empty_days=True)
    # Twelve less one unknown port, one unknown country and two of code 407.
    assert spark.table(cfg.table("fact_immigration")).count() == 8


def stray(spark, cfg):
    """A row filed under January 2 that arrived on January 1."""
    clean = clean_arrivals(raw(spark, [(1, 582, "NYC", None)]))
    return clean.selectExpr("* EXCEPT (arrival_day)", "2 AS arrival_day").select(clean.columns)


def test_a_stray_date_is_refused_with_its_batch(spark, cfg, path):
    """The reconciliation counts by arrival date and so reports the stray row; the batch is
    checked before it shows, and what the tables held before stays."""
    cfg = dataclasses.replace(cfg, lake=path("own_lake"))
    lakes.write_lake(clean_arrivals(raw(spark, ARRIVALS)), cfg.lake)
    jobs.load_day(spark, cfg, D(2016, 1, 2))
    before = contents(spark, cfg)
    lakes.write_lake(clean_arrivals(raw(spark, ARRIVALS)).union(stray(spark, cfg)), cfg.lake)
    jobs.load_day(spark, cfg, START)
    with pytest.raises(DataQualityError, match="staging to fact"):
        jobs.load_day(spark, cfg, D(2016, 1, 2))
    fact = cfg.table("fact_immigration")
    counted = [(START, 20454, 3), (D(2016, 1, 2), 20455, 2)]
    # Refused rows never showed.
    assert rows(spark.table(fact).groupBy("load_day", "arrdate").count()) == counted
    assert len(contents(spark, cfg)["ports"]) >= len(before["ports"])
    with pytest.raises(DataQualityError, match="staging to fact"):
        jobs.load_range(spark, cfg, START, D(2016, 1, 2))
    assert rows(spark.table(fact).groupBy("load_day", "arrdate").count()) == counted
    # Once corrected, the batch loads, by day or by range.
    lakes.write_lake(clean_arrivals(raw(spark, ARRIVALS)), cfg.lake)
    jobs.load_range(spark, cfg, START, D(2016, 1, 2))
    assert rows(spark.table(fact).groupBy("load_day", "arrdate").count()) == counted


def test_keep_rule_loads_all_matching_rows(spark, cfg):
    keep = dataclasses.replace(cfg, in_batch="keep")
    jobs.load_range(spark, keep, D(2016, 1, 2), D(2016, 1, 3))
    t = warehouse.tables_of(spark, cfg.database)
    # Both codes of the name enter together, and New York with both temperatures.
    assert rows(t["dim_countries"], "country_code") == [("124",), ("407",), ("582",), ("583",)]
    assert [p[0] for p in rows(t["dim_ports"], "port_code")] == ["5KE", "KET", "NYC", "NYC"]
    # The repeated port fans out its arrival, as informational keys allow.
    assert t["fact_immigration"].where("arrdate = 20456").count() == 4


def test_too_long_text_is_refused(spark, cfg):
    long = spark.createDataFrame([("TOOLONG", "C", "S")], schemas.TABLES["staging_ports"].schema)
    with pytest.raises(Exception, match="EXCEED_LIMIT_LENGTH|[Ee]xceeds char/varchar"):
        writers.append_to(long, cfg.table("staging_ports"))


def test_orphans_stop_the_load(spark, cfg):
    from decimal import Decimal
    spec = schemas.TABLES["dim_demographics"]
    orphan = spark.createDataFrame(
        [(99, 77, Decimal("1.00"), 1, 1, 1, 1, 1, Decimal("1.00"), "White", 1)], spec.schema)
    writers.append_to(orphan, cfg.table("dim_demographics"))
    for _ in range(2):
        with pytest.raises(DataQualityError, match="port_id in dim_ports"):
            jobs.load_day(spark, cfg, START)
    # The rows of the refused append are not there.
    assert spark.table(cfg.table("dim_demographics")).count() == 1


def test_a_lookup_row_without_a_name_is_refused_each_time(spark, cfg):
    unnamed = spark.createDataFrame(
        [("999", None)], schemas.TABLES["staging_countries"].schema)
    writers.append_to(unnamed, cfg.table("staging_countries"))
    for _ in range(2):
        with pytest.raises(DataQualityError, match="country not null"):
            jobs.load_day(spark, cfg, START)
    assert spark.table(cfg.table("dim_countries")).count() == 0
    # Other days do not meet that code.
    jobs.load_day(spark, cfg, D(2016, 1, 2))


def test_command_line(spark, cfg, path):
    from landfall.__main__ import main
    config = path("config.json")
    with open(config, "w") as out:
        json.dump(dataclasses.asdict(cfg), out)
    for arguments in (["extract"], ["setup"], ["load-day", "--day", "2016-01-01"],
                      ["load-range", "--start", "2016-01-02", "--end", "2016-01-03"]):
        main([arguments[0], "--config", config, *arguments[1:]])
    assert rows(spark.table(cfg.table("fact_immigration")).groupBy("load_day").count()) == [
        (START, 3), (D(2016, 1, 2), 2), (D(2016, 1, 3), 1)]


def test_arrivals_of_no_day_fail_the_extract_or_are_set_aside(spark, path):
    good = raw(spark, [(1, 582, "NYC", 3)])
    bad = good.withColumn("i94mon", F.lit(2.0)).withColumn(
        "arrdate", F.lit(float((D(2016, 1, 31) - days.EPOCH).days)))
    none = good.withColumn("arrdate", F.lit(None).cast("double"))
    source, lake = path("raw"), path("lake")
    good.union(bad).union(none).write.parquet(source)
    config = jobs.JobConfig(database="none", raw=source, lake=lake)
    with pytest.raises(DataQualityError, match="day of arrival"):
        jobs.extract_job(spark, config)
    aside = dataclasses.replace(config, undated=path("undated"))
    jobs.extract_job(spark, aside)
    assert spark.read.parquet(aside.undated).count() == 2
    assert spark.read.parquet(lake).count() == 1


def test_undated_rows_are_not_doubled_by_another_extract(spark, path):
    good = raw(spark, [(1, 582, "NYC", 3)])
    none = good.withColumn("arrdate", F.lit(None).cast("double"))
    source, other = path("raw"), path("raw")
    good.union(none).write.parquet(source)
    none.write.parquet(other)
    config = jobs.JobConfig(database="none", raw=source, lake=path("lake"), undated=path("aside"))
    for _ in range(2):
        counts = jobs.extract_job(spark, config)
        assert (counts.rows, counts.undated, counts.strays) == (2, 1, 0)
    assert spark.read.parquet(config.undated).count() == 1
    # Those of another input stay, and go once it has none.
    twin = dataclasses.replace(config, raw=other)
    jobs.extract_job(spark, twin)
    assert spark.read.parquet(config.undated).count() == 2
    good.write.mode("overwrite").parquet(other)
    jobs.extract_job(spark, twin)
    assert spark.read.parquet(config.undated).count() == 1
    assert readers.read_lake(spark, config.lake).count() == 2


def test_a_failing_extract_leaves_the_lake(spark, path):
    source = path("raw")
    late = raw(spark, [(1, 582, "NYC", 3)]).withColumn("arrdate", F.col("arrdate") + 31)
    late.write.parquet(source)
    config = jobs.JobConfig(database="none", raw=source, lake=path("lake"))
    assert jobs.extract_job(spark, config).strays == 1
    refusing = dataclasses.replace(config, refuse_strays=True)
    raw(spark, [(2, 582, "NYC", 3)]).union(late).write.mode("overwrite").parquet(source)
    with pytest.raises(DataQualityError, match="partition date: 1 "):
        jobs.extract_job(spark, refusing)
    assert readers.read_lake(spark, config.lake).count() == 1
    assert not [f for f in os.listdir(config.lake) if f.startswith("_staged")]


def test_extract_reads_its_input_once(spark, path):
    """Counts come from the write: a whole extract is one scan of the raw files."""
    source = path("raw")
    raw(spark, ARRIVALS).repartition(1).write.parquet(source)
    config = jobs.JobConfig(database="none", raw=source, lake=path("lake"))
    jobs.extract_job(spark, config)
    seen = raw_scans(spark, lambda: jobs.extract_job(spark, config), source)
    assert seen == 1


def raw_scans(spark, run, folder):
    """How many of the jobs' plans read a folder: by access to its one file, whose name a
    read cannot do without."""
    from landfall.sources import readers as module

    calls = []
    real = module.read_raw_arrivals

    def counted(spark_, path_, *arguments, **options):
        df = real(spark_, path_, *arguments, **options)
        marked = spark.sparkContext.accumulator(0)
        calls.append(marked)

        def mark(batches):
            marked.add(1)
            yield from batches

        return df.coalesce(1).mapInArrow(mark, df.schema)

    module.read_raw_arrivals = counted
    try:
        run()
    finally:
        module.read_raw_arrivals = real
    return sum(c.value for c in calls)


def test_extract_of_a_year_by_its_months(spark, path):
    base = path("raw")
    for month in range(1, 13):
        shift = (D(2016, month, 1) - D(2016, 1, 1)).days
        rows_ = raw(spark, [(1, 582, "NYC", None), (2, 582, "NYC", None)]).withColumn(
            "i94mon", F.lit(float(month))).withColumn("arrdate", F.col("arrdate") + shift)
        rows_.write.parquet(f"{base}/{readers.month_paths('', 2016)[month - 1].strip('/')}")
    config = jobs.JobConfig(database="none", raw=base, raw_year=2016, lake=path("lake"))
    assert jobs.extract_job(spark, config).rows == 24
    # One month again, by itself: the others stay, the lost day goes.
    file = "i94_mar16_sub"
    kept = spark.read.parquet(f"{base}/{file}").where("dayofmonth(date_add('1960-01-01', "
                                                       "int(arrdate))) = 1")
    settle(kept).write.mode("overwrite").parquet(f"{base}/{file}")
    jobs.extract_job(spark, dataclasses.replace(config, raw_year=None, raw_months=[file]))
    lake = readers.read_lake(spark, config.lake)
    assert lake.count() == 23 and lake.where("month = 3").count() == 1
    # A file that holds another month.
    spark.read.parquet(f"{base}/i94_may16_sub").write.mode("overwrite").parquet(f"{base}/{file}")
    with pytest.raises(DataQualityError, match="i94_mar16_sub: no arrivals"):
        jobs.extract_job(spark, config)
    os.rename(f"{base}/i94_dec16_sub", f"{base}/i94_dec17_sub")
    with pytest.raises(FileNotFoundError, match="i94_dec16_sub"):
        jobs.extract_job(spark, config)


def test_loads_count_what_they_leave_out(spark, cfg):
    counts = jobs.load_day(spark, cfg, START)
    assert (counts.arrivals, counts.no_country, counts.no_port, counts.loaded) == (4, 1, 0, 3)
    assert jobs.load_range(spark, cfg, START, END).loaded == 8
    strict = dataclasses.replace(cfg, most_unmatched=0.1)
    with pytest.raises(DataQualityError, match="unmatched arrivals: 4 of 12"):
        jobs.load_range(spark, strict, START, END)
    assert jobs.load_day(spark, strict, D(2016, 1, 4)).loaded == 2


def test_a_failing_load_leaves_all_tables(spark, cfg, monkeypatch):
    jobs.load_day(spark, cfg, START)
    before, numbers = contents(spark, cfg), ids(spark, cfg)

    def fails(*_):
        raise DataQualityError("no")

    monkeypatch.setattr(jobs, "_check_counts", fails)
    for load in (lambda: jobs.load_day(spark, cfg, D(2016, 1, 3)),
                 lambda: jobs.load_range(spark, cfg, START, END)):
        with pytest.raises(DataQualityError):
            load()
        assert contents(spark, cfg) == before and ids(spark, cfg) == numbers
    folder = writers.location_of(spark, cfg.table("fact_immigration")).removeprefix("file:")
    assert not [f for f in os.listdir(folder) if f.startswith("_staged")]


@pytest.mark.parametrize("moves", [2])
def test_a_load_killed_while_it_publishes_is_ended_by_the_next(spark, cfg, monkeypatch, moves):
    from landfall import session

    jobs.load_range(spark, cfg, START, END)
    before = contents(spark, cfg)
    real, done = session.move, []

    def dying(spark_, source, target):
        if "fact_immigration" in target:
            if len(done) == moves:
                raise KeyboardInterrupt
            done.append(target)
        real(spark_, source, target)

    monkeypatch.setattr(session, "move", dying)
    with pytest.raises(KeyboardInterrupt):
        jobs.load_range(spark, cfg, D(2016, 1, 2), END)
    monkeypatch.setattr(session, "move", real)
    jobs.load_day(spark, cfg, START)
    assert contents(spark, cfg) == before


def test_a_range_again_reads_the_lake_as_often(spark, cfg, monkeypatch):
    """Jobs of a first and of a second run, and the tasks that read the lake."""
    def jobs_of(group):
        spark.sparkContext.setJobGroup(group, group)
        reads = []
        real = readers.read_days

        def counted(*arguments):
            seen = spark.sparkContext.accumulator(0)
            reads.append(seen)
            df = real(*arguments).coalesce(1)

            def mark(batches):
                seen.add(1)
                yield from batches

            return df.mapInArrow(mark, df.schema)

        monkeypatch.setattr(readers, "read_days", counted)
        jobs.load_range(spark, cfg, START, END)
        monkeypatch.setattr(readers, "read_days", real)
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
        return (sum(r.value for r in reads),
                len(spark.sparkContext.statusTracker().getJobIdsForGroup(group)))

    first, second = jobs_of("first"), jobs_of("second")
    assert first[0] == second[0] == 3
    assert second[1] <= first[1]


CHECK = {"name": "few ports", "sql": "SELECT count(*) FROM {dim_ports} WHERE port_code <> :code",
         "expect": "at_most", "values": [1], "parameters": {"code": "NYC"}}


def test_checks_of_the_user_end_a_load(spark, cfg):
    asked = [{"name": "dated", "sql": "SELECT count(*) FROM {fact_immigration} "
              "WHERE load_day < :start OR load_day > :end", "expect": "zero"}, CHECK]
    config = dataclasses.replace(cfg, checks=asked)
    jobs.load_day(spark, config, START)
    with pytest.raises(DataQualityError, match="dated: unexpected value 3"):
        jobs.load_day(spark, config, D(2016, 1, 2))
    config = dataclasses.replace(cfg, checks=[CHECK])
    jobs.load_day(spark, config, D(2016, 1, 2))
    # The batch would bring a second port: its rows are seen by the check, and by it alone.
    before = contents(spark, cfg)
    with pytest.raises(DataQualityError, match="few ports: unexpected value 2"):
        jobs.load_day(spark, config, D(2016, 1, 4))
    assert contents(spark, cfg) == before


@pytest.mark.parametrize("broken", [
    {"expect": "odd"}, {"expect": "between", "values": [1]}, {"other": 1}])
def test_checks_that_cannot_be_understood(spark, broken):
    from landfall.operators.quality import check_sql
    with pytest.raises(ValueError):
        check_sql(spark, CHECK | broken, {"dim_ports": spark.range(1)})


def test_predicates(spark):
    from landfall.operators.quality import PREDICATES, check_sql

    def holds(expect, cell, *values):
        asked = {"name": "x", "sql": f"SELECT {cell}", "expect": expect, "values": values}
        try:
            check_sql(spark, asked, {})
        except DataQualityError:
            return False
        return True

    cases = {"zero": ("0", "1"), "not_zero": ("1", "0"), "true": ("true", "false"),
             "null": ("NULL", "0"), "equals": ("2", "3", 2), "at_least": ("2", "1", 2),
             "at_most": ("2", "NULL", 2), "between": ("2", "4", 1, 3)}
    assert cases.keys() == PREDICATES.keys()
    for name, (good, bad, *values) in cases.items():
        assert holds(name, good, *values) and not holds(name, bad, *values)
    with pytest.raises(DataQualityError, match="no result"):
        check_sql(spark, {"name": "x", "sql": "SELECT 1 WHERE false", "expect": "zero"}, {})


def test_lookups_are_checked_before_they_replace_others(spark, cfg, path):
    before = spark.table(cfg.table("staging_countries")).count()
    empty_code = csv(path, "bad.csv", "Code,Country", ",MEXICO")
    broken = dataclasses.replace(cfg, lookups={"staging_countries": (empty_code, ",")})
    with pytest.raises(DataQualityError):
        jobs.setup_job(spark, broken)
    assert spark.table(cfg.table("staging_countries")).count() == before


def test_no_row_is_added_twice_by_default(spark, cfg, path):
    races = csv(path, "null_race.csv", "City;State;Median Age;Male;Female;Total;Veterans;"
                "Foreign;Household;Code;Race;Count", "New York;New York;36.0;1;2;3;4;5;2.68;NY;;9")
    config = dataclasses.replace(cfg, lookups={
        **cfg.lookups, "staging_demographics": (races, ";")})
    jobs.setup_job(spark, config)
    loads = []
    for null_safe in (True, True, False):
        jobs.load_day(spark, dataclasses.replace(config, null_safe=null_safe), D(2016, 1, 1))
        loads.append(spark.table(config.table("dim_demographics")).count())
    assert loads == [1, 1, 2]


def test_ids_that_do_not_fit_are_an_error(spark):
    df = spark.createDataFrame([(D(2200, 1, 1),)], "load_day date")
    with pytest.raises(Exception, match="no ids for batch day"):
        df.select(day_start(F.col("load_day"))).collect()


def test_warehouse_outlives_the_process(spark, extracted, path):
    """Each command runs in a process of its own, with an in-memory catalog."""
    folder, file = path("warehouse"), path("apart.json")
    config = dataclasses.replace(
        extracted, database="apart", warehouse_location=folder, undated="")
    with open(file, "w") as out:
        json.dump(dataclasses.asdict(config), out)
    environment = os.environ | {"PYSPARK_SUBMIT_ARGS": (
        "--master local[2] --conf spark.ui.enabled=false --conf spark.sql.shuffle.partitions=2 "
        "--conf spark.sql.session.timeZone=UTC pyspark-shell")}

    def run(*arguments):
        subprocess.run([sys.executable, "-m", "landfall", *arguments, "--config", file],
                       cwd=ROOT, env=environment, check=True, timeout=300)

    def loaded():
        fact = spark.read.parquet(f"{folder}/fact_immigration")
        ports = spark.read.parquet(f"{folder}/dim_ports")
        return rows(fact.groupBy("load_day").count()), ports.count()

    run("setup")
    run("load-day", "--day", "2016-01-01")
    first = loaded()
    assert first == ([(START, 3)], 1)
    run("load-day", "--day", "2016-01-01")
    assert loaded() == first
    # A range over loaded days replaces them in tables that another process made.
    run("load-range", "--start", "2016-01-01", "--end", "2016-01-02")
    assert loaded() == ([(START, 3), (D(2016, 1, 2), 2)], 2)
    run("setup")
    warehouse.attach_warehouse(spark, "apart", folder)
    try:
        assert spark.table("apart.fact_immigration").isEmpty()
        assert spark.table("apart.staging_ports").count() == 4
    finally:
        spark.sql("DROP DATABASE apart CASCADE")
