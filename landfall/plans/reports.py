"""Reports on the warehouse.

Each one counts the fact per key first and joins names to the counts, so text is
neither hashed nor compared per arrival and a frequent key is combined within
each task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F


def arrivals_on(fact: DataFrame, time: DataFrame, year: int | None = None,
                month: int | None = None, day: int | None = None) -> DataFrame:
    """Fact rows whose arrival date has the given parts, with the date columns.

    The selected days are few and prune the fact's arrdate partitions at run time.
    """
    days = time
    for name, value in (("year", year), ("month", month), ("day", day)):
        if value is not None:
            days = days.where(F.col(name) == value)
    return fact.join(days.withColumnRenamed("sas_timestamp", "arrdate"), "arrdate")


def _counts(fact: DataFrame, *keys: str) -> DataFrame:
    return fact.groupBy(*keys).agg(F.count("*").alias("arrivals"))


def top_countries(fact: DataFrame, countries: DataFrame, time: DataFrame, year: int,
                  month: int, k: int = 10) -> DataFrame:
    """Countries with most arrivals in a month; the name breaks ties."""
    counted = _counts(arrivals_on(fact, time, year, month), "country_id")
    return (
        counted.join(countries, "country_id")
        .groupBy("country").agg(F.sum("arrivals").alias("count"))
        .orderBy(F.desc("count"), "country").limit(k)
    )


def top_ports(fact: DataFrame, ports: DataFrame, time: DataFrame, year: int, month: int,
              k: int = 10) -> DataFrame:
    """Port cities with most arrivals in a month."""
    counted = _counts(arrivals_on(fact, time, year, month), "port_id")
    return (
        counted.join(ports, "port_id")
        .groupBy("port_city", "port_state").agg(F.sum("arrivals").alias("count"))
        .orderBy(F.desc("count"), "port_city", "port_state").limit(k)
    )


def arrivals_by_dow(fact: DataFrame, ports: DataFrame, time: DataFrame, year: int,
                    month: int) -> DataFrame:
    """Arrivals of a month per weekday, Sunday 0."""
    counted = _counts(arrivals_on(fact, time, year, month), "day_of_week", "port_id")
    return (
        counted.join(ports.select("port_id"), "port_id")
        .groupBy("day_of_week").agg(F.sum("arrivals").alias("count"))
        .orderBy("day_of_week")
    )


def port_country_counts(fact: DataFrame, ports: DataFrame, countries: DataFrame) -> DataFrame:
    """Arrivals per port city and country of origin."""
    return (
        _counts(fact, "port_id", "country_id")
        .join(ports.select("port_id", "port_city"), "port_id")
        .join(countries.select("country_id", "country"), "country_id")
        .groupBy("port_city", "country").agg(F.sum("arrivals").alias("arrivals"))
    )


def demographics_by_origin(fact: DataFrame, ports: DataFrame, countries: DataFrame,
                           demographics: DataFrame) -> DataFrame:
    """Per port and country of origin: the arrivals, beside each race of the port.

    The arrivals are counted before the demographics join, which has several rows
    per port, so they are not multiplied.
    """
    return (
        _counts(fact, "port_id", "country_id")
        .join(ports.select("port_id", "port_code", "port_city", "port_state"), "port_id")
        .join(countries.select("country_id", "country"), "country_id")
        .join(demographics.select("port_id", "race", "demo_count", "median_age"), "port_id")
        .select("port_code", "port_city", "port_state", "country", "race", "demo_count",
                "median_age", "arrivals")
    )


def temp_correlation(fact: DataFrame, ports: DataFrame, countries: DataFrame) -> DataFrame:
    """Correlation of origin and port temperature over all arrivals.

    Null if one of them is the same for all; arrivals that lack one are left out.
    """
    origin = countries.select(
        "country_id", F.col("average_temperature").cast("double").alias("origin_temperature"))
    port = ports.select(
        "port_id", F.col("average_temperature").cast("double").alias("port_temperature"))
    x, y, n = F.col("origin_temperature"), F.col("port_temperature"), F.col("arrivals")
    pairs = (_counts(fact, "port_id", "country_id").join(origin, "country_id")
             .join(port, "port_id").where(x.isNotNull() & y.isNotNull()))
    # One row of weighted sums; the arrivals are the weights.
    sums = pairs.agg(*[F.sum(n * v).alias(k) for k, v in (
        ("n", F.lit(1.0)), ("x", x), ("y", y), ("xx", x * x), ("yy", y * y), ("xy", x * y))])

    def spread(total: str, squares: str) -> Column:
        found = F.col(squares) - F.col(total) * F.col(total) / F.col("n")
        # What is left of equal values by rounding is no spread.
        return F.when(found > 1e-12 * F.col(squares), found)

    both = F.col("xy") - F.col("x") * F.col("y") / F.col("n")
    return sums.select(F.round(
        both / F.sqrt(spread("x", "xx") * spread("y", "yy")), 6).alias("correlation"))


def seasonality(fact: DataFrame, ports: DataFrame, time: DataFrame) -> DataFrame:
    """Arrivals per state and month of the year, and the month's rank in its state."""
    busiest = Window.partitionBy("port_state").orderBy(F.desc("arrivals"))
    return (
        _counts(fact, "port_id", "arrdate")
        .join(ports.select("port_id", "port_state"), "port_id")
        .join(time.select(F.col("sas_timestamp").alias("arrdate"), "month"), "arrdate")
        .groupBy("port_state", "month").agg(F.sum("arrivals").alias("arrivals"))
        .withColumn("month_rank", F.rank().over(busiest))
    )
