"""Latest row per key, and the two temperature extracts built on it."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window, functions as F

from landfall.session import settle


def latest_per_key(df: DataFrame, keys: list[str], order: str, ties: bool = True) -> DataFrame:
    """Rows of each key with the greatest `order`; NULL is the smallest value.

    With ties, all rows of the latest value stay. How many share it is not
    bounded, so they are never sorted into one window group: the latest value per
    key is aggregated first and the rows are then filtered by a semi-join, which
    is a broadcast when the keys are few. Without ties one row per key is left,
    and the window cuts each task to that before the shuffle.
    """
    if not ties:
        rest = [c for c in df.columns if c not in (*keys, order)]
        window = Window.partitionBy(*keys).orderBy(
            F.desc_nulls_last(order), *[F.asc_nulls_last(c) for c in rest])
        return df.withColumn("_n", F.row_number().over(window)).where("_n = 1").drop("_n")
    newest = settle(
        df.groupBy(*[F.col(k).alias(f"_key_{k}") for k in keys])
        .agg(F.max(order).alias("_newest")),
        "newest")
    same = reduce(
        lambda left, right: left & right,
        [F.col(k).eqNullSafe(F.col(f"_key_{k}")) for k in keys],
        F.col(order).eqNullSafe(F.col("_newest")))
    return df.join(newest, same, "left_semi")


def _latest_recorded(temps: DataFrame, key: str) -> DataFrame:
    recorded = temps.where(F.col("AverageTemperature").isNotNull())
    return latest_per_key(recorded, [key], "dt").withColumn("rank", F.lit(1))


def latest_city_temps(temps: DataFrame) -> DataFrame:
    """Last recorded temperatures of US cities; rows tied on the date all stay."""
    return _latest_recorded(temps.where(F.col("Country") == "United States"), "City")


def latest_country_temps(temps: DataFrame) -> DataFrame:
    """Last recorded temperature of each country."""
    return _latest_recorded(temps, "Country")
