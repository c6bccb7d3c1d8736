import datetime
import random

from conftest import rows
from landfall import schemas
from landfall.operators.clean import clean_arrivals
from landfall.operators.latest import latest_city_temps, latest_country_temps, latest_per_key

D = datetime.date


def test_clean_arrivals(spark):
    raw = spark.createDataFrame([
        (2016.0, 4.0, 54.0, "NYC", 20574.0, 1.0, 20580.5, 41.0, 2.0, 1975.0, "M", "B2"),
        (2016.0, 5.0, None, None, 20574.0, None, None, None, 7.0, None, None, None),
        (2016.0, 4.0, 54.0, "NYC", None, 9.0, None, 1.0, None, 2015.0, "F", "WT"),
    ], schemas.RAW_ARRIVALS)
    clean = clean_arrivals(raw)
    assert clean.columns == schemas.CLEAN_ARRIVALS.fieldNames()
    assert [f.dataType for f in clean.schema] == [f.dataType for f in schemas.CLEAN_ARRIVALS]
    got = [tuple(r) for r in clean.collect()]
    assert got[0] == (41, "54", "NYC", "Air", "Pleasure", "B2", "M", 1975, 20574.0,
                      D(2016, 4, 30), 20580.5, D(2016, 5, 6), 2016, 4, 30)
    # The filing month stays although the arrival is in April.
    assert got[1] == (None, None, None, "Not Reported", "Not Reported", None, None, None,
                      20574.0, D(2016, 4, 30), None, None, 2016, 5, 30)
    assert got[2][8:10] == (None, None) and got[2][14] is None


def test_latest_keeps_ties_and_null_dates_last(spark):
    df = spark.createDataFrame([
        ("a", D(2013, 9, 1), 1), ("a", D(2013, 9, 1), 2), ("a", D(2012, 9, 1), 3), ("a", None, 4),
        ("b", None, 5), ("b", None, 6), (None, D(2000, 1, 1), 7), (None, D(1999, 1, 1), 8),
    ], "k string, dt date, v int")
    assert rows(latest_per_key(df, ["k"], "dt"), "v") == [(1,), (2,), (5,), (6,), (7,)]
    assert rows(latest_per_key(df, ["k"], "dt", ties=False), "v") == [(1,), (5,), (7,)]


def test_latest_against_brute_force(spark):
    random.seed(7)
    # One key holds half of the rows.
    data = [(random.choice("aaaabcde"), D(2000, 1, random.randint(1, 28)), i) for i in range(600)]
    newest = {}
    for key, day, _ in data:
        newest[key] = max(day, newest.get(key, day))
    want = sorted((i,) for key, day, i in data if newest[key] == day)
    df = spark.createDataFrame(data, "k string, dt date, v int")
    assert sorted(rows(latest_per_key(df, ["k"], "dt"), "v")) == want


def test_temperature_extracts(spark):
    cities = spark.createDataFrame([
        (D(2013, 8, 1), 20.0, 0.1, "Dallas", "United States", "32N", "96W"),
        (D(2013, 9, 1), None, None, "Dallas", "United States", "32N", "96W"),
        (D(2013, 8, 1), 21.0, 0.1, "Dallas", "United States", "33N", "97W"),
        (D(2013, 9, 1), 5.0, 0.1, "Oslo", "Norway", "60N", "10E"),
    ], schemas.CITY_TEMPS)
    latest = latest_city_temps(cities)
    assert latest.columns == schemas.TABLES["staging_city_temperatures"].columns
    # The unrecorded month does not count, the two places of one name both stay.
    assert rows(latest, "City", "AverageTemperature", "rank") == [
        ("Dallas", 20.0, 1), ("Dallas", 21.0, 1)]
    countries = spark.createDataFrame([
        (D(2013, 8, 1), 20.0, 0.1, "Norway"), (D(2013, 7, 1), 21.0, 0.1, "Norway"),
    ], schemas.COUNTRY_TEMPS)
    assert rows(latest_country_temps(countries), "Country", "AverageTemperature") == [
        ("Norway", 20.0)]
