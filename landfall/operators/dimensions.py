"""Dimension builders: what a batch of clean arrivals adds to the warehouse.

`staging` is a batch of clean arrivals with its `load_day`. Each builder returns
the new rows with their keys; appending them is left to the caller.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from landfall import schemas
from landfall.functions import codes, days
from landfall.operators.upsert import assign_keys, insert_if_absent, next_key


def code_counts(staging: DataFrame) -> DataFrame:
    """Arrivals per batch day, country code and port code.

    A batch this small stands in for the arrivals wherever only their codes
    matter: for all builders but build_time, and for the reconciliation.
    """
    return (staging.groupBy("load_day", "country_code", "port_code")
            .agg(F.count("*").alias("arrivals")))


def seen_codes(staging: DataFrame, lookup: DataFrame, key: str) -> DataFrame:
    """Lookup rows whose code occurs in the batch, with the day it first did.

    The batch shrinks to one row per code, task by task, before the join.
    """
    seen = staging.groupBy(key).agg(F.min("load_day").alias("first_seen"))
    return seen.join(lookup, key)


def enrich_ci(left: DataFrame, right: DataFrame, lkey: str, rkey: str,
              cols: Sequence[str]) -> DataFrame:
    """Left join on text, ignoring case; adds `cols` of `right`."""
    matches = right.select(
        F.col(rkey).alias("_name"), *[F.col(c).alias(f"_add_{c}") for c in cols])
    return (
        left.join(matches, codes.same_text(F.col(lkey), F.col("_name")), "left")
        .select(*left.columns, *[F.col(f"_add_{c}").alias(c) for c in cols])
    )


def _temperature_per_name(temps: DataFrame, name: str, in_batch: str) -> DataFrame:
    """Temperatures to join, reduced beforehand so the join fans out no further
    than needed.

    'first' takes the smallest value of a name in the end, as the temperature is
    the last column of the order; 'keep' needs all distinct ones.
    """
    upper = temps.select(F.upper(name).alias(name), "AverageTemperature")
    if in_batch == "first":
        return upper.groupBy(name).agg(F.min("AverageTemperature").alias("AverageTemperature"))
    return upper.distinct()


def _with_temperature(seen: DataFrame, temps: DataFrame | None, key: str, temp_key: str,
                      in_batch: str) -> DataFrame:
    if temps is None:
        return seen.withColumn("AverageTemperature", F.lit(None).cast("double"))
    values = _temperature_per_name(temps, temp_key, in_batch)
    return enrich_ci(seen, values, key, temp_key, ["AverageTemperature"])


def _finish(fresh: DataFrame, table: str, order_by: Sequence[str],
            existing: DataFrame | None) -> DataFrame:
    """Add the key and bring the rows to the types of the table."""
    spec = schemas.TABLES[table]
    key_col = spec.columns[0]
    start = 1 if existing is None else next_key(existing, key_col)
    keyed = assign_keys(fresh, key_col, order_by, start)
    return keyed.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in spec.schema])


def build_countries(staging: DataFrame, lookup: DataFrame, temps: DataFrame | None = None,
                    existing: DataFrame | None = None, in_batch: str = "first",
                    key: str = "country") -> DataFrame:
    """Countries new in the batch. Of two codes with one name the one seen on the
    earlier day wins, then the smaller code; `key` may be country_code instead."""
    seen = seen_codes(staging, lookup, "country_code")
    candidates = _with_temperature(seen, temps, "country", "Country", in_batch).select(
        "first_seen", "country_code", "country",
        F.col("AverageTemperature").alias("average_temperature")).distinct()
    fresh = insert_if_absent(candidates, existing, [key], ["first_seen", "country_code"],
                             in_batch, nullable=())
    return _finish(fresh.drop("first_seen"), "dim_countries", ["country", "country_code"],
                   existing)


def build_ports(staging: DataFrame, lookup: DataFrame, temps: DataFrame | None = None,
                existing: DataFrame | None = None, in_batch: str = "first") -> DataFrame:
    """Ports new in the batch."""
    seen = seen_codes(staging, lookup, "port_code")
    candidates = _with_temperature(seen, temps, "city", "City", in_batch).select(
        "port_code", F.col("city").alias("port_city"), F.col("state").alias("port_state"),
        F.col("AverageTemperature").alias("average_temperature")).distinct()
    fresh = insert_if_absent(candidates, existing, ["port_code"], in_batch=in_batch, nullable=())
    return _finish(fresh, "dim_ports", ["port_code"], existing)


def ports_x_airports(airports: DataFrame, ports: DataFrame) -> DataFrame:
    """Airports that are ports, matched on the exact code."""
    return airports.join(
        ports.select("port_id", "port_code"), F.col("ident") == F.col("port_code")
    ).select(
        "port_code", "port_id", F.col("type").alias("airport_type"),
        F.col("name").alias("airport_name"), "elevation_ft", "municipality", "gps_code",
        "iata_code", "local_code", "coordinates")


def build_airports(airports: DataFrame, ports: DataFrame, existing: DataFrame | None = None,
                   in_batch: str = "first") -> DataFrame:
    """Airports of ports that have none yet."""
    fresh = insert_if_absent(ports_x_airports(airports, ports), existing, ["port_id"],
                             in_batch=in_batch, nullable=())
    return _finish(fresh, "dim_airports", ["port_code", "port_id"], existing)


def ports_in_batch(ports: DataFrame, staging: DataFrame) -> DataFrame:
    """Ports with at least one arrival in the batch."""
    return ports.join(staging.select("port_code").distinct(), "port_code", "left_semi")


def ports_x_demographics(ports: DataFrame, demographics: DataFrame) -> DataFrame:
    """Demographics of port cities, matched on city and state, ignoring case."""
    here = ports.select("port_id", "port_city", "port_state")
    return here.join(
        demographics,
        codes.same_text(F.col("port_city"), F.col("City"))
        & codes.same_text(F.col("port_state"), F.col("State Code")),
    ).select(
        "port_id", F.col("Median Age").alias("median_age"),
        F.col("Male Population").alias("male_population"),
        F.col("Female Population").alias("female_population"),
        F.col("Total Population").alias("total_population"),
        F.col("Number of Veterans").alias("number_of_veterans"),
        F.col("Foreign-born").alias("foreign_born"),
        F.col("Average Household Size").alias("avg_household_size"),
        F.col("Race").alias("race"), F.col("Count").alias("demo_count"))


def build_demographics(ports: DataFrame, demographics: DataFrame, staging: DataFrame,
                       existing: DataFrame | None = None, in_batch: str = "first",
                       null_safe: bool = False) -> DataFrame:
    """Demographics per port and race for the ports in the batch.

    Without `null_safe` rows with NULL race never conflict and enter every time.
    """
    rows = ports_x_demographics(ports_in_batch(ports, staging), demographics).distinct()
    fresh = insert_if_absent(rows, existing, ["port_id", "race"], in_batch=in_batch,
                             null_safe=null_safe, nullable=["race"])
    return _finish(fresh, "dim_demographics", ["port_id", "race"], existing)


def distinct_days(staging: DataFrame) -> DataFrame:
    """Arrival and departure day numbers; only a NULL departure is left out.

    Both columns come from one scan, and each task drops repeated pairs before the shuffle;
    only the pairs are split into days, not the rows.
    """
    arrived, left = F.col("arrdate"), F.col("depdate")
    pair = F.when(left.isNull(), F.array(arrived)).otherwise(F.array(arrived, left))
    pairs = staging.select(arrived, left).distinct()
    return pairs.select(F.explode(pair).alias("day")).distinct()


def build_time(staging: DataFrame, existing: DataFrame | None = None,
               in_batch: str = "first") -> DataFrame:
    """Calendar rows for the days of the batch, keyed by day number."""
    rows = distinct_days(staging).select(
        F.rint("day").cast("int").alias("sas_timestamp"),
        *[part.alias(name) for name, part in
          days.calendar_parts(days.sas_date(F.col("day"))).items()])
    return insert_if_absent(rows, existing, ["sas_timestamp"], in_batch=in_batch, nullable=())
