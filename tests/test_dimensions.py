import datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from conftest import rows
from landfall import schemas
from landfall.operators import dimensions
from landfall.operators.fact import build_fact

D = datetime.date
MONDAY, TUESDAY = D(2016, 1, 4), D(2016, 1, 5)


@pytest.fixture
def countries(spark):
    return spark.createDataFrame([
        ("582", "MEXICO"), ("583", "INVALID: UNITED STATES"), ("407", "INVALID: UNITED STATES"),
        ("124", "NORWAY"), ("999", "NEVER SEEN"),
    ], schemas.TABLES["staging_countries"].schema)


@pytest.fixture
def ports(spark):
    return spark.createDataFrame([
        ("NYC", "NEW YORK", "NY"), ("KET", "KETCHIKAN", "AK"), ("5KE", "KETCHIKAN", "AK"),
        ("ZZZ", "NEVER SEEN", "ZZ"),
    ], schemas.TABLES["staging_ports"].schema)


@pytest.fixture
def country_temps(spark):
    return spark.createDataFrame([
        (TUESDAY, 2.0005, 0.1, "Norway", 1), (TUESDAY, 1.5, 0.1, "NORWAY", 1),
        (TUESDAY, None, 0.1, "Mexico", 1),
    ], schemas.TABLES["staging_country_temperatures"].schema)


@pytest.fixture
def city_temps(spark):
    return spark.createDataFrame([
        (TUESDAY, 9.5, 0.1, "New York", "United States", "40N", "74W", 1),
        (TUESDAY, 7.25, 0.1, "New York", "United States", "41N", "75W", 1),
        (TUESDAY, 7.25, 0.2, "New York", "United States", "42N", "76W", 1),
    ], schemas.TABLES["staging_city_temperatures"].schema)


def test_countries(staging, countries, country_temps):
    batch = staging((MONDAY, "582", "NYC"), (MONDAY, "124", "NYC"), (MONDAY, "124", "KET"),
                    (MONDAY, "111", "NYC"), (MONDAY, None, "NYC"))
    got = dimensions.build_countries(batch, countries, country_temps)
    assert got.schema == schemas.TABLES["dim_countries"].schema
    assert rows(got) == [(1, "582", "MEXICO", None), (2, "124", "NORWAY", Decimal("1.500"))]


def test_temperature_rounds_half_up(staging, countries, country_temps):
    batch = staging((MONDAY, "124", "NYC"))
    got = dimensions.build_countries(
        batch, countries, country_temps.where("AverageTemperature > 2"))
    assert rows(got, "average_temperature") == [(Decimal("2.001"),)]


def test_all_matching_temperatures_stay_with_keep(staging, countries, country_temps):
    batch = staging((MONDAY, "124", "NYC"))
    got = dimensions.build_countries(batch, countries, country_temps, in_batch="keep")
    assert rows(got, "country_id", "average_temperature") == [
        (1, Decimal("1.500")), (2, Decimal("2.001"))]


def test_two_codes_of_one_name_on_one_day(staging, countries):
    batch = staging((MONDAY, "583", "NYC"), (MONDAY, "407", "NYC"))
    first = dimensions.build_countries(batch, countries)
    assert rows(first, "country_code") == [("407",)]
    keep = dimensions.build_countries(batch, countries, in_batch="keep")
    assert rows(keep, "country_code") == [("407",), ("583",)]
    by_code = dimensions.build_countries(batch, countries, key="country_code")
    assert rows(by_code, "country_code") == [("407",), ("583",)]


def test_two_codes_of_one_name_on_two_days(staging, countries):
    together = staging((MONDAY, "583", "NYC"), (TUESDAY, "407", "NYC"))
    assert rows(dimensions.build_countries(together, countries), "country_code") == [("583",)]
    monday = dimensions.build_countries(staging((MONDAY, "583", "NYC")), countries)
    for in_batch in ("first", "keep"):
        later = dimensions.build_countries(
            staging((TUESDAY, "407", "NYC")), countries, existing=monday, in_batch=in_batch)
        assert rows(later) == []


def test_repeated_lookup_rows_add_nothing(staging, countries):
    batch = staging((MONDAY, "582", "NYC"))
    got = dimensions.build_countries(batch, countries.union(countries), in_batch="keep")
    assert rows(got, "country_code") == [("582",)]


def test_ports_and_keys_of_a_second_batch(staging, ports, city_temps):
    monday = dimensions.build_ports(staging((MONDAY, "582", "NYC")), ports, city_temps)
    assert monday.schema == schemas.TABLES["dim_ports"].schema
    assert rows(monday) == [(1, "NYC", "NEW YORK", "NY", Decimal("7.250"))]
    tuesday = dimensions.build_ports(
        staging((TUESDAY, "582", "NYC"), (TUESDAY, "582", "KET"), (TUESDAY, "1", "5KE"),
                (TUESDAY, "1", "???")), ports, city_temps, existing=monday)
    assert rows(tuesday) == [(2, "5KE", "KETCHIKAN", "AK", None), (3, "KET", "KETCHIKAN", "AK", None)]


def test_ports_keep_distinct_temperatures(staging, ports, city_temps):
    got = dimensions.build_ports(
        staging((MONDAY, "582", "NYC")), ports, city_temps, in_batch="keep")
    assert rows(got, "average_temperature") == [(Decimal("7.250"),), (Decimal("9.500"),)]


def airports_of(spark, *data):
    return spark.createDataFrame(
        [(ident, kind, name, 10, "NA", "US", "US-NY", "City", "G", None, "L", "0, 0")
         for ident, kind, name in data], schemas.TABLES["staging_airports"].schema)


def test_airports(spark, staging, ports):
    dim = dimensions.build_ports(
        staging((MONDAY, "582", "NYC"), (MONDAY, "582", "KET")), ports)
    airports = airports_of(spark, ("NYC", "small", "B"), ("NYC", "small", "A"),
                           ("nyc", "small", "C"), ("JFK", "large", "D"))
    got = dimensions.build_airports(airports, dim)
    assert got.schema == schemas.TABLES["dim_airports"].schema
    assert rows(got, "airport_id", "port_id", "airport_name") == [(1, 2, "A")]
    more = dimensions.build_airports(
        airports.union(airports_of(spark, ("KET", "small", "K"))), dim, existing=got)
    assert rows(more, "airport_id", "port_id", "airport_name") == [(2, 1, "K")]
    assert len(rows(dimensions.build_airports(airports, dim, in_batch="keep"))) == 2


def demographics_of(spark, *data):
    return spark.createDataFrame(
        [(city, "State", Decimal("30.00"), 1, 2, 3, 4, 5, Decimal("2.50"), state, race, count)
         for city, state, race, count in data], schemas.TABLES["staging_demographics"].schema)


def test_demographics(spark, staging, ports):
    batch = staging((MONDAY, "582", "NYC"))
    dim = dimensions.build_ports(staging((MONDAY, "582", "NYC"), (MONDAY, "1", "KET")), ports)
    facts = demographics_of(
        spark, ("New York", "ny", "White", 9), ("New York", "NY", "White", 8),
        ("New York", "NY", "Asian", 7), ("New York", "NJ", "Asian", 6), ("New York", "NY", None, 5),
        ("New York", "NY", None, 4), ("Ketchikan", "AK", "White", 3))
    got = dimensions.build_demographics(dim, facts, batch)
    assert got.schema == schemas.TABLES["dim_demographics"].schema
    # Ketchikan has no arrival in the batch; NULL races never conflict.
    assert rows(got, "demographics_id", "race", "demo_count") == [
        (1, "Asian", 7), (2, "White", 8), (3, None, 4), (4, None, 5)]
    again = dimensions.build_demographics(dim, facts, batch, existing=got)
    assert rows(again, "demographics_id", "race", "demo_count") == [(5, None, 4), (6, None, 5)]
    safe = dimensions.build_demographics(dim, facts, batch, existing=got, null_safe=True)
    assert rows(safe) == []


def test_time(staging):
    batch = staging((D(2016, 1, 1), "582", "NYC", 20456.0), (D(2016, 1, 1), "582", "NYC", 20456.0),
                    (D(2016, 1, 3), "582", "NYC"))
    got = dimensions.build_time(batch)
    assert got.schema.fieldNames() == schemas.TABLES["dim_time"].columns
    assert rows(got) == [(20454, 2016, 1, 1, 53, 5, 1), (20456, 2016, 1, 3, 53, 0, 1)]
    later = dimensions.build_time(staging((D(2016, 1, 3), "1", "N"), (D(2016, 1, 4), "1", "N")), got)
    assert rows(later, "sas_timestamp") == [(20457,)]


def test_a_missing_arrival_day_is_not_dropped(staging):
    batch = staging((D(2016, 1, 1), "582", "NYC")).withColumn("arrdate", F.lit(None).cast("double"))
    assert rows(dimensions.build_time(batch), "sas_timestamp", "year") == [(None, None)]


def test_fact_drops_unknown_codes_and_casts(staging, countries, ports):
    batch = staging((MONDAY, "582", "NYC", 20460.0), (MONDAY, "582", "???"), (MONDAY, "0", "NYC"),
                    (MONDAY, None, None), (MONDAY, "124", "KET"))
    dim_countries = dimensions.build_countries(batch, countries)
    dim_ports = dimensions.build_ports(batch, ports)
    fact = build_fact(batch, dim_countries, dim_ports)
    assert rows(fact, "country_id", "port_id", "arrdate", "depdate", "load_day") == [
        (1, 2, 20457, 20460, MONDAY), (2, 1, 20457, None, MONDAY)]
    assert dict(fact.dtypes)["arrdate"] == dict(fact.dtypes)["depdate"] == "int"


def test_code_counts_stand_in_for_the_arrivals(staging, ports, countries):
    batch = staging((MONDAY, "583", "NYC"), (TUESDAY, "407", "KET"), (TUESDAY, "407", "KET"))
    codes = dimensions.code_counts(batch)
    assert rows(codes, "arrivals") == [(1,), (2,)]
    assert rows(dimensions.build_ports(codes, ports)) == rows(dimensions.build_ports(batch, ports))
    assert rows(dimensions.build_countries(codes, countries)) == rows(
        dimensions.build_countries(batch, countries))
