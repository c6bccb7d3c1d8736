import datetime

import pytest
from pyspark.sql import functions as F

from conftest import rows
from landfall import schemas
from landfall.operators import quality
from landfall.operators.quality import DataQualityError

MONDAY = datetime.date(2016, 1, 4)


def test_check(spark):
    one = spark.createDataFrame([(5,)], "n int")
    assert quality.check(one, lambda n: n == 5, "five") == 5
    with pytest.raises(DataQualityError, match="five: unexpected value 5"):
        quality.check(one, lambda n: n == 6, "five")
    with pytest.raises(DataQualityError, match="no result"):
        quality.check(one.where("n > 9"), lambda n: True, "none")


def test_empty_staging_fails(staging):
    assert quality.check_staged(staging((MONDAY, "1", "NYC"))) == 1
    with pytest.raises(DataQualityError):
        quality.check_staged(staging((MONDAY, "1", "NYC")).where("false"))


@pytest.fixture
def star(spark):
    countries = spark.createDataFrame([(1, "582")], "country_id long, country_code string")
    ports = spark.createDataFrame([(1, "NYC")], "port_id long, port_code string")
    time = spark.createDataFrame([(20457, 2016, 1, 4)],
                                 "sas_timestamp int, year int, month int, day int")
    return countries, ports, time


def test_reconciliation(spark, staging, star):
    countries, ports, time = star
    batch = staging((MONDAY, "582", "NYC"), (MONDAY, "582", "NYC"), (MONDAY, "582", "???"))
    loaded = spark.createDataFrame([(20457,), (20457,), (20458,)], "arrdate int")
    assert quality.check_reconciled(batch, countries, ports, loaded, time, MONDAY) == 0
    twice = loaded.union(loaded)
    with pytest.raises(DataQualityError, match="-2"):
        quality.check_reconciled(batch, countries, ports, twice, time, MONDAY)
    empty = loaded.where("false")
    assert quality.staging_fact_diff(batch, countries, ports, empty, time, MONDAY).first()[0] == 2
    codes = batch.groupBy("load_day", "country_code", "port_code").agg(
        F.count("*").alias("arrivals"))
    assert rows(quality.reconciliation(codes, countries, ports, twice, time)) == [
        (MONDAY, 2, 4, -2)]


def test_unique(spark):
    df = spark.createDataFrame(
        [("a", 1), ("a", 1), ("a", None), ("a", None), ("b", 1)], "k string, n int")
    assert rows(quality.unique_violations(df, ["k"])) == [("a", 4)]
    # NULL repeats nothing.
    assert rows(quality.unique_violations(df, ["k", "n"])) == [("a", 1, 2)]
    with pytest.raises(DataQualityError):
        quality.check_unique(df, ["k"])
    quality.check_unique(df.where("k = 'b'"), ["k"])


def test_foreign_key(spark):
    child = spark.createDataFrame([(1,), (2,), (2,), (None,)], "fk long")
    parent = spark.createDataFrame([(1,), (3,)], "id long")
    assert rows(quality.fk_orphans(child, "fk", parent, "id")) == [(2,)]
    with pytest.raises(DataQualityError):
        quality.check_fk(child, "fk", parent, "id")
    quality.check_fk(child.where("fk = 1 OR fk IS NULL"), "fk", parent, "id")


def test_nulls_and_lengths(spark):
    df = spark.createDataFrame([("abcd", None), ("ab", 1)], "t string, n int")
    assert rows(quality.null_counts(df, ["t", "n"])) == [("n", 1), ("t", 0)]
    with pytest.raises(DataQualityError):
        quality.check_not_null(df, ["n"])
    quality.check_not_null(df, ["t"])
    assert rows(quality.length_counts(df, {"t": 3})) == [("t", 4, 3, 1)]
    with pytest.raises(DataQualityError):
        quality.check_lengths(df, {"t": 3})
    quality.check_lengths(df, {"t": 4})


def fact_row(spark, **changes):
    row = dict(immigration_id=1, country_id=1, port_id=1, age=30, travel_mode="Air",
               visa_category="Pleasure", visa_type="B2", gender="F", birth_year=1980,
               depdate=None, load_day=MONDAY, arrdate=20457)
    row.update(changes)
    spec = schemas.TABLES["fact_immigration"]
    return spark.createDataFrame([tuple(row[c] for c in spec.columns)], spec.schema)


@pytest.mark.parametrize("change, constraint", [
    ({}, None),
    ({"depdate": 20457}, None),
    ({"arrdate": None}, "arrdate not null"),
    ({"arrdate": 1}, "arrdate in dim_time"),
    ({"depdate": 1}, "depdate in dim_time"),
    ({"port_id": 9}, "port_id in dim_ports"),
    ({"country_id": 9}, "country_id in dim_countries"),
    ({"gender": "x" * 11}, "gender length"),
])
def test_all_constraints_of_the_fact(spark, star, change, constraint):
    countries, ports, time = star
    parents = {"dim_countries": countries, "dim_ports": ports, "dim_time": time}
    row, spec = fact_row(spark, **change), schemas.TABLES["fact_immigration"]
    found = quality.violation_counts(row, spec, parents).where("violations > 0")
    assert rows(found) == ([(constraint, 1)] if constraint else [])
    if constraint:
        with pytest.raises(DataQualityError, match=constraint):
            quality.check_table(row, spec, parents)
    else:
        quality.check_table(row, spec, parents)
    with pytest.raises(DataQualityError, match="unique"):
        quality.check_table(fact_row(spark).union(fact_row(spark)), spec, parents)


def test_partition_dates(staging):
    good = staging((MONDAY, "1", "NYC"))
    quality.check_partition_dates(good)
    filed_later = good.withColumn("month", F.lit(2))
    assert rows(quality.partition_mismatch(filed_later)) == [(2016, 2, 4, MONDAY, 1)]
    with pytest.raises(DataQualityError):
        quality.check_partition_dates(filed_later)
    undated = good.select(*[
        F.lit(None).cast(f.dataType).alias(f.name) if "arr" in f.name else F.col(f.name)
        for f in good.schema])
    assert rows(quality.partition_mismatch(undated)) == [(2016, 1, None, None, 1)]


def test_unmatched_codes(spark, staging, star):
    batch = staging((MONDAY, "582", "NYC"), (MONDAY, "1", "NYC"), (MONDAY, "1", "NYC"),
                    (MONDAY, None, "NYC"))
    assert rows(quality.unmatched_codes(batch, star[0], "country_code")) == [(None, 1), ("1", 2)]
