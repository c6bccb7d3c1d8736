import datetime
import glob
import os

import pytest
from pyspark.sql import functions as F

from conftest import rows
from landfall import schemas
from landfall.functions import days
from landfall.operators.clean import clean_arrivals
from landfall.session import new_path, scratch, settle, shared_folder
from landfall.sources import lake as lakes, readers, writers

D = datetime.date


def raw(spark, *days_):
    return spark.createDataFrame(
        [(2016.0, float(d.month), 1.0, "NYC", float((d - days.EPOCH).days), 1.0, None, 30.0, 1.0,
          1986.0, "F", "B2") for d in days_], schemas.RAW_ARRIVALS)


def test_month_paths_start_from_the_base():
    paths = readers.month_paths("/in", 2016, suffix=".sas7bdat")
    assert paths[:2] == ["/in/i94_jan16_sub.sas7bdat", "/in/i94_feb16_sub.sas7bdat"]
    assert len(paths) == 12 and all(p.count("i94_") == 1 for p in paths)
    assert readers.month_paths("/in", 2009, [12]) == ["/in/i94_dec09_sub"]


def test_raw_arrivals_of_several_months(spark, path):
    base = path("raw")
    for month in (1, 2, 3):
        raw(spark, D(2016, month, 1)).write.parquet(f"{base}/m{month}")
    got = readers.read_raw_arrivals(spark, base, months=["m1", "m3"])
    assert rows(got, "i94mon") == [(1.0,), (3.0,)]
    raw(spark, D(2016, 1, 1)).write.json(f"{base}/j")
    assert readers.read_raw_arrivals(spark, f"{base}/j", "json").count() == 1


def write_text(path, text):
    with open(path, "w") as out:
        out.write(text)
    return path


def test_csv_with_quotes_and_empty_fields(spark, path):
    file = write_text(path("countries.csv"), 'Code,Country\n0,INVALID: STATELESS\n'
                      '705,"CHINA, PRC"\n54,"THE ""NORTH"""\n9,\n8,""\n7,NEW  HEBRIDES\n')
    got = readers.stage_csv(spark, file, schemas.TABLES["staging_countries"].schema)
    assert rows(got) == [
        ("0", "INVALID: STATELESS"), ("54", 'THE "NORTH"'), ("7", "NEW  HEBRIDES"),
        ("705", "CHINA, PRC"), ("8", ""), ("9", None)]


def test_csv_with_semicolons(spark, path):
    file = write_text(path("demo.csv"), "City;State;Median Age;Male Population;"
                      "Female Population;Total Population;Number of Veterans;Foreign-born;"
                      "Average Household Size;State Code;Race;Count\n"
                      "Quincy;Massachusetts;41.0;44129;49500;93629;4147;32935;2.39;MA;White;58723\n"
                      "Ponce;Puerto Rico;40.5;56968;64615;121583;;;;PR;Hispanic;120705\n")
    got = readers.stage_csv(spark, file, schemas.TABLES["staging_demographics"].schema, sep=";")
    assert rows(got.select("City", "Foreign-born", "Total Population", "Count")) == [
        ("Ponce", None, 121583, 120705), ("Quincy", 32935, 93629, 58723)]


def test_malformed_csv_fails(spark, path):
    file = write_text(path("bad.csv"), "dt,t,u,Country\n2013-01-01,warm,1,Norway\n")
    with pytest.raises(Exception, match="[Mm]alformed"):
        readers.read_temps(spark, file, schemas.COUNTRY_TEMPS).collect()


def test_temperature_history(spark, path):
    file = write_text(path("temps.csv"), "dt,AverageTemperature,AverageTemperatureUncertainty,"
                      "Country\n1743-11-01,4.384,2.294,Åland\n1743-12-01,,,Åland\n")
    got = readers.read_temps(spark, file, schemas.COUNTRY_TEMPS)
    assert rows(got) == [(D(1743, 11, 1), 4.384, 2.294, "Åland"),
                         (D(1743, 12, 1), None, None, "Åland")]


@pytest.mark.parametrize("fmt", ["parquet", "orc", "json", "csv"])
def test_stage_any_format(spark, path, fmt):
    df = spark.createDataFrame([("NYC", "NEW YORK", "NY")], schemas.TABLES["staging_ports"].schema)
    target = path(fmt)
    df.write.format(fmt).save(target)
    assert rows(readers.stage(spark, target, fmt, df.schema)) == rows(df)


def test_parquet_by_wildcard(spark, path):
    target = path("wild")
    spark.range(10, numPartitions=2).write.parquet(target)
    assert readers.stage_parquet(spark, f"{target}/*.parquet").count() == 10


def clean(spark, *days_):
    from landfall.operators.clean import clean_arrivals
    return clean_arrivals(raw(spark, *days_))


def test_lake_day_and_range(spark, path):
    lake = path("lake")
    written = clean(spark, D(2016, 1, 1), D(2016, 1, 2), D(2016, 1, 2), D(2016, 2, 10))
    lakes.write_lake(written, lake)
    assert os.path.isdir(f"{lake}/year=2016/month=1/arrival_day=2")
    assert readers.read_lake(spark, lake).columns == schemas.CLEAN_ARRIVALS.fieldNames()
    assert rows(readers.read_lake(spark, lake)) == rows(written)
    day = readers.read_day(spark, lake, D(2016, 1, 2))
    assert day.columns == schemas.CLEAN_ARRIVALS.fieldNames() and day.count() == 2
    missing = readers.read_day(spark, lake, D(2016, 1, 3))
    assert missing.columns == day.columns and missing.count() == 0
    span = readers.read_days(spark, lake, D(2016, 1, 2), D(2016, 2, 28))
    assert rows(span, "load_day") == [(D(2016, 1, 2),), (D(2016, 1, 2),), (D(2016, 2, 10),)]


def days_in(spark, lake):
    return rows(readers.read_lake(spark, lake).groupBy("month", "arrival_day").count())


def test_a_corrected_month_leaves_no_stale_day(spark, path):
    lake = path("lake")
    lakes.write_lake(clean(spark, D(2016, 1, 1), D(2016, 1, 2), D(2016, 2, 3)), lake)
    lakes.write_lake(clean(spark, D(2016, 1, 2), D(2016, 1, 2)), lake)
    # The run has no row in February any more.
    assert days_in(spark, lake) == [(1, 2, 2)]


def test_months_and_days_of_other_runs_stay(spark, path):
    lake = path("lake")
    # The file of January holds a day of February, and the other way round.
    lakes.write_lake(clean(spark, D(2016, 1, 1), D(2016, 1, 7), D(2016, 2, 1)), lake, run="jan")
    lakes.write_lake(clean(spark, D(2016, 2, 2), D(2016, 1, 31)), lake, run="feb")
    lakes.write_lake(clean(spark, D(2016, 4, 2)), lake, run="apr")
    assert days_in(spark, lake) == [(1, 1, 1), (1, 31, 1), (1, 7, 1), (2, 1, 1), (2, 2, 1),
                                    (4, 2, 1)]
    lakes.write_lake(clean(spark, D(2016, 1, 1), D(2016, 1, 1)), lake, run="jan")
    assert days_in(spark, lake) == [(1, 1, 2), (1, 31, 1), (2, 2, 1), (4, 2, 1)]
    lakes.write_lake(clean(spark, D(2016, 2, 3)), lake, run="feb")
    assert days_in(spark, lake) == [(1, 1, 2), (2, 3, 1), (4, 2, 1)]
    assert lakes.owned_months(spark, lake) == {
        "jan": {"year=2016/month=1"}, "feb": {"year=2016/month=2"},
        "apr": {"year=2016/month=4"}}


def test_single_days_and_the_whole_lake_are_replaced_on_demand(spark, path):
    lake = path("lake")
    lakes.write_lake(clean(spark, D(2016, 1, 1), D(2016, 1, 2)), lake, run="a")
    lakes.write_lake(clean(spark, D(2016, 1, 2), D(2016, 1, 3)), lake, run="b")
    lakes.write_lake(clean(spark, D(2016, 1, 2), D(2016, 1, 2)), lake, "day", run="a")
    assert days_in(spark, lake) == [(1, 1, 1), (1, 2, 3), (1, 3, 1)]
    lakes.write_lake(clean(spark, D(2016, 1, 2)), lake, "lake", run="a")
    assert days_in(spark, lake) == [(1, 2, 1)]
    with pytest.raises(ValueError):
        lakes.write_lake(clean(spark, D(2016, 1, 2)), lake, "year")


def test_a_lake_without_records_belongs_to_the_writer(spark, path):
    lake = path("lake")
    (clean(spark, D(2016, 1, 1), D(2016, 2, 1)).write
     .partitionBy(*schemas.LAKE_PARTITIONS).parquet(lake))
    lakes.write_lake(clean(spark, D(2016, 1, 5)), lake, run="jan")
    assert days_in(spark, lake) == [(1, 5, 1), (2, 1, 1)]


def test_counts_of_a_lake_write(spark, path):
    rows_ = clean(spark, D(2016, 1, 1), D(2016, 1, 31), D(2016, 3, 31)).withColumn(
        "month", F.lit(2))
    staged = lakes.stage(rows_, path("lake"), ["x"], apart=True)
    assert staged.counts == lakes.LakeCounts(3, 2, 1, frozenset({("x", 2016, 2)}))
    assert lakes.undated_rows(spark, staged).count() == 2
    lakes.commit(spark, staged)
    assert days_in(spark, staged.path) == [(2, 1, 1)]


@pytest.mark.parametrize("moves", range(6))
def test_a_killed_writer_leaves_the_old_lake_or_the_new_one(spark, path, monkeypatch, moves):
    """The writer dies after so many renames; the next one ends its work."""
    from landfall import session

    lake = path("lake")
    lakes.write_lake(clean(spark, D(2016, 1, 1), D(2016, 2, 1), D(2016, 3, 1)), lake)
    old = days_in(spark, lake)
    real, done = session.move, []

    def dying(spark_, source, target):
        if len(done) == moves:
            raise KeyboardInterrupt
        done.append(target)
        real(spark_, source, target)

    monkeypatch.setattr(session, "move", dying)
    monkeypatch.setattr("landfall.sources.publish._THREADS", 1)
    with pytest.raises(KeyboardInterrupt):
        lakes.write_lake(clean(spark, D(2016, 1, 2), D(2016, 2, 2)), lake)
    monkeypatch.setattr(session, "move", real)
    # The note is renamed into place first; without it nothing has changed.
    if not moves:
        assert days_in(spark, lake) == old
    assert readers.read_lake(spark, lake).count() <= 3
    from landfall.sources import publish
    assert publish.recover(spark, lake) is bool(moves)
    new = [(1, 2, 1), (2, 2, 1)]
    assert days_in(spark, lake) == (new if moves else old)
    assert not glob.glob(f"{lake}/_staged*") and not glob.glob(f"{lake}/_notes/*.json")
    lakes.write_lake(clean(spark, D(2016, 1, 3)), lake)
    assert days_in(spark, lake) == [(1, 3, 1)]


def test_a_day_too_big_for_one_task_is_split(spark, path):
    """One day holds nearly all rows; they end up in several files, none lost."""
    key = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    number = float((D(2016, 1, 1) - days.EPOCH).days)
    template = clean(spark, D(2016, 1, 1))
    hot = spark.range(40000, numPartitions=8).select(
        *[F.lit(v).cast(f.dataType).alias(f.name) if f.name != "port_code"
          else F.sha2(F.col("id").cast("string"), 256).alias("port_code")
          for f, v in zip(template.schema, template.first())])
    lake = path("lake")
    spark.conf.set(key, "200k")
    try:
        lakes.write_lake(hot.union(clean(spark, D(2016, 1, 2))), lake)
    finally:
        spark.conf.unset(key)
    files = glob.glob(f"{lake}/year=2016/month=1/arrival_day=1/*.parquet")
    assert len(files) > 1
    written = readers.read_lake(spark, lake)
    assert written.where(F.col("arrdate") == number).count() == 40000
    assert written.select("port_code").distinct().count() == 40001


def test_filed_day_that_does_not_exist_belongs_to_no_range(spark, path):
    lake = path("lake")
    lakes.write_lake(clean(spark, D(2016, 1, 31)).withColumn("month", F.lit(2)), lake)
    assert readers.read_lake(spark, lake).count() == 1
    assert readers.read_days(spark, lake, D(2016, 1, 1), D(2016, 12, 31)).count() == 0


def test_a_range_lists_its_days_only(spark, path):
    lake = path("lake")
    all_days = [D(2016, 1, 20) + datetime.timedelta(days=n) for n in range(70)]
    lakes.write_lake(clean(spark, *all_days), lake)
    found = readers.lake_days(spark, lake, D(2016, 1, 31), D(2016, 2, 2))
    assert sorted(f.removeprefix(lake) for f in found) == [
        "/year=2016/month=1/arrival_day=31", "/year=2016/month=2/arrival_day=1",
        "/year=2016/month=2/arrival_day=2"]
    span = readers.read_days(spark, lake, D(2016, 1, 31), D(2016, 2, 2))
    assert len(span.inputFiles()) == 3 == span.count()
    assert readers.read_days(spark, lake, D(2016, 3, 28), D(2016, 4, 3)).count() == 2
    assert readers.read_days(spark, lake, D(2017, 1, 1), D(2017, 2, 3)).count() == 0
    assert readers.read_days(spark, lake, D(2014, 1, 1), D(2017, 2, 3)).count() == 70


def month_files(spark, base, *months, suffix=""):
    for m in months:
        raw(spark, D(2016, m, 1), D(2016, m, 5)).write.parquet(
            f"{base}/i94_{readers.MONTHS[m - 1]}16_sub{suffix}")


def test_rows_know_their_monthly_file(spark, path):
    base = path("raw")
    month_files(spark, base, 1, 2)
    got = readers.read_months(spark, base, ["i94_jan16_sub", "i94_feb16_sub"])
    assert rows(got, "run", "i94mon") == 2 * [("i94_feb16_sub", 2.0)] + 2 * [
        ("i94_jan16_sub", 1.0)] or rows(got, "run", "i94mon") == [
        ("i94_feb16_sub", 2.0), ("i94_feb16_sub", 2.0), ("i94_jan16_sub", 1.0),
        ("i94_jan16_sub", 1.0)]
    assert readers.month_of_file("i94_feb16_sub.sas7bdat") == (2016, 2)
    assert readers.month_of_file("i94_dec96_sub") == (1996, 12)
    assert readers.month_of_file("other") is readers.month_of_file("i94_xyz16_sub") is None


def test_a_month_missing_or_doubled_is_an_error(spark, path):
    base = path("raw")
    month_files(spark, base, 1, 2)
    with pytest.raises(FileNotFoundError, match="i94_mar16_sub"):
        readers.read_months(spark, base, ["i94_jan16_sub", "i94_mar16_sub"])
    with pytest.raises(ValueError, match="twice"):
        readers.read_months(spark, base, ["i94_jan16_sub", "i94_jan16_sub"])
    month_files(spark, base, 2, suffix=".parquet")
    with pytest.raises(ValueError, match="several files"):
        readers.read_months(spark, base, ["i94_jan16_sub", "i94_feb16_sub"])


def test_sorted_extract(spark, path):
    target = path("sorted")
    df = spark.range(500).select(((F.col("id") * 37) % 11).cast("string").alias("City"),
                                 F.col("id").cast("int").alias("v"))
    for _ in range(2):
        writers.write_sorted(df.repartition(5), target, "City")
    assert spark.read.parquet(target).count() == 500
    from landfall.operators.quality import unordered
    stored = spark.read.parquet(target)
    assert unordered(stored, ["City", "v"]).isEmpty()
    assert not unordered(stored, ["v"]).isEmpty()
    # Files follow each other in order.
    spans = []
    for file in sorted(glob.glob(f"{target}/*.parquet")):
        values = [(r.City, r.v) for r in spark.read.parquet(file).collect()]
        assert values == sorted(values)
        spans.append((values[0], values[-1]))
    assert all(a[1] < b[0] for a, b in zip(spans, spans[1:]))


def test_staging_truncate_and_append(spark):
    from landfall.plans.warehouse import create_table
    spark.sql("CREATE DATABASE IF NOT EXISTS sinks")
    create_table(spark, "sinks", schemas.TABLES["staging_ports"])
    df = spark.createDataFrame([("NY", "NEW YORK", "NYC")], "state string, city string, port_code string")
    for truncate, want in ((True, 1), (False, 2), (True, 1)):
        writers.write_staging(df, "sinks.staging_ports", truncate)
        assert spark.table("sinks.staging_ports").count() == want
    # Columns go by name, not by position.
    assert rows(spark.table("sinks.staging_ports")) == [("NYC", "NEW YORK", "NY")]
    # Appending what was read from the same table.
    writers.append_to(spark.table("sinks.staging_ports"), "sinks.staging_ports")
    assert spark.table("sinks.staging_ports").count() == 2


def test_settled_tables_lie_in_the_shared_folder(spark):
    df = settle(spark.range(5), "numbers")
    assert all(f.startswith(f"file:{shared_folder(spark)}/") or
               f.startswith(f"file://{shared_folder(spark)}/") for f in df.inputFiles())
    assert df.count() == 5


def test_scratch_deletes_what_was_settled_inside(spark):
    kept = settle(spark.range(5))
    with pytest.raises(ZeroDivisionError):
        with scratch(spark):
            inside = settle(spark.range(3))
            folder = os.path.dirname(inside.inputFiles()[0].removeprefix("file://"))
            assert inside.count() == 3 and os.path.isdir(folder)
            1 / 0
    assert not os.path.exists(folder)
    assert kept.count() == 5 and settle(spark.range(2)).count() == 2


def test_paths_are_never_reused(spark):
    assert len({new_path(spark, "x") for _ in range(100)}) == 100


def test_staged_rows_are_counted_without_a_look_at_each(spark, path, monkeypatch):
    """Two runs, a day that does not exist, one that is missing, and a stray."""
    def refuse(*_):
        raise AssertionError("observed row by row")

    monkeypatch.setattr(type(spark.range(1)), "observe", refuse)
    filed = clean_arrivals(raw(spark, D(2016, 1, 1), D(2016, 1, 1), D(2016, 2, 3), D(2016, 2, 4)))
    january = F.col("month") == 1
    filed = filed.withColumn("run", F.when(january, "jan").otherwise("feb"))
    rows_ = (
        filed.withColumn("arrival_day", F.when(F.col("arrival_day") == 4, 30)
                         .otherwise(F.col("arrival_day")))
        .unionByName(filed.where(january).withColumn("arrival_day", F.lit(9)))
        .unionByName(filed.where("arrival_day = 3").withColumn("month", F.lit(None).cast("int"))))
    for apart in (False, True):
        staged = lakes.stage(rows_, path(f"lake{apart}"), ["jan", "feb"], apart)
        assert staged.counts == lakes.LakeCounts(7, 2, 2, frozenset(
            {("jan", 2016, 1), ("feb", 2016, 2), ("feb", 2016, None)}))
    none = lakes.stage(rows_.where("false"), path("none"))
    assert none.counts == lakes.LakeCounts(0, 0, 0, frozenset())
