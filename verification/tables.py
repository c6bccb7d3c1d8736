"""Views that reshape the given tables to arrivals, lookups and histories.

Each view reads its whole table, without joins or row filters, so its size grows
with the table. The text is shared by Spark and DuckDB; {DAY} is the day number
of the ship date in the dialect of either.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

SPARK_DAY = "datediff(CAST(l_shipdate AS DATE), DATE '1960-01-01')"
DUCKDB_DAY = "date_diff('day', DATE '1960-01-01', CAST(l_shipdate AS DATE))"

# Countries 120-124 and ports P80-P99 first appear in 1998, country 123 in 1999.
_RAW = """
SELECT CAST(year({FILED}) AS DOUBLE) AS i94yr,
  CAST(month({FILED}) AS DOUBLE) AS i94mon,
  CAST(100 + CASE WHEN year(l_shipdate) < 1998 THEN l_partkey % 20
                  WHEN year(l_shipdate) < 1999 AND l_partkey % 25 = 23 THEN 22
                  ELSE l_partkey % 25 END AS DOUBLE) AS i94cit,
  CASE WHEN l_linenumber < 7 OR l_quantity < 50 THEN
    concat('P', lpad(CAST(CASE WHEN year(l_shipdate) < 1998 THEN l_suppkey % 80
                               ELSE l_suppkey % 100 END AS STRING), 2, '0')) END AS i94port,
  CAST({DAY} AS DOUBLE) AS arrdate,
  CASE WHEN l_linenumber = 4 THEN CAST(9 AS DOUBLE)
       WHEN l_linenumber = 5 THEN NULL
       ELSE CAST(l_linenumber AS DOUBLE) END AS i94mode,
  CASE WHEN l_linestatus = 'F' THEN CAST({DAY} AS DOUBLE) + l_quantity END AS depdate,
  CASE WHEN l_quantity < 50 THEN l_quantity + 18 END AS i94bir,
  CASE WHEN l_returnflag = 'A' THEN CAST(1 AS DOUBLE)
       WHEN l_returnflag = 'N' THEN CAST(2 AS DOUBLE)
       WHEN l_linenumber < 4 THEN CAST(3 AS DOUBLE)
       WHEN l_linenumber = 7 THEN CAST(5 AS DOUBLE) END AS i94visa,
  CASE WHEN l_quantity < 50 THEN CAST(year(l_shipdate) AS DOUBLE) - (l_quantity + 18) END
    AS biryear,
  CASE WHEN l_tax < 0.035 THEN 'F' WHEN l_tax < 0.065 THEN 'M' END AS gender,
  CASE WHEN l_returnflag = 'A' THEN 'B1' WHEN l_returnflag = 'N' THEN 'B2' ELSE 'F1' END
    AS visatype
FROM {lineitem}
"""

VIEWS: dict[str, str] = {
    "raw_arrivals": _RAW.replace("{FILED}", "l_shipdate"),
    # Line 7 is filed a day late, so at the end of a month under the next one.
    "raw_arrivals_late": _RAW.replace(
        "{FILED}",
        "CASE WHEN l_linenumber = 7 THEN l_shipdate + INTERVAL 1 DAY ELSE l_shipdate END"),
    "lookup_countries": """
SELECT CAST(CASE WHEN n_nationkey = 7 THEN 907 ELSE 100 + n_nationkey END AS STRING)
    AS country_code,
  CASE WHEN n_nationkey IN (23, 24) THEN 'INVALID: STATELESS' ELSE n_name END AS country
FROM {nation}
""",
    "lookup_ports": """
SELECT DISTINCT concat(CASE WHEN s_suppkey % 100 < 96 THEN 'P' ELSE 'X' END,
    lpad(CAST(s_suppkey % 100 AS STRING), 2, '0')) AS port_code,
  concat('CITY_', CAST(s_suppkey % 100 % 40 AS STRING)) AS city,
  concat('S', CAST(s_suppkey % 100 % 4 AS STRING)) AS state
FROM {supplier}
""",
    "airports": """
SELECT concat('P', lpad(CAST(p_partkey % 100 AS STRING), 2, '0')) AS ident, p_type AS type,
  p_name AS name, p_size AS elevation_ft, 'NA' AS continent, 'US' AS iso_country,
  concat('US-', CAST(p_partkey % 4 AS STRING)) AS iso_region, p_brand AS municipality,
  concat('K', CAST(p_size AS STRING)) AS gps_code,
  CASE WHEN p_size > 10 THEN concat('I', CAST(p_size AS STRING)) END AS iata_code,
  CAST(p_partkey AS STRING) AS local_code,
  concat(CAST(p_size AS STRING), ', ', CAST(p_partkey AS STRING)) AS coordinates
FROM {part}
""",
    "demographics": """
SELECT concat('City_', CAST(c_custkey % 40 AS STRING)) AS City,
  concat('State ', CAST(c_custkey % 4 AS STRING)) AS State,
  CAST(c_acctbal AS DECIMAL(18,2)) AS {q}Median Age{q},
  CAST(c_custkey % 100000 * 3 AS INT) AS {q}Male Population{q},
  CAST(c_custkey % 100000 * 5 AS INT) AS {q}Female Population{q},
  c_custkey % 100000 * 8 AS {q}Total Population{q},
  CAST(c_nationkey * 7 AS INT) AS {q}Number of Veterans{q},
  CAST(c_nationkey * 11 AS INT) AS {q}Foreign-born{q},
  CAST(c_nationkey AS DECIMAL(18,2)) AS {q}Average Household Size{q},
  concat('s', CAST(c_custkey % 4 AS STRING)) AS {q}State Code{q},
  CASE WHEN c_nationkey = 24 THEN NULL ELSE c_mktsegment END AS Race,
  CAST(c_nationkey AS INT) AS {q}Count{q}
FROM {customer}
""",
    "city_temps": """
SELECT CAST(ts AS DATE) AS dt,
  CASE WHEN event_type <> 'error' THEN value END AS AverageTemperature,
  CAST(event_id % 16 AS DOUBLE) AS AverageTemperatureUncertainty,
  concat('City_', CAST(user_id % 30 AS STRING)) AS City,
  CASE WHEN event_type = 'signup' THEN 'Canada' ELSE 'United States' END AS Country,
  concat(CAST(user_id % 90 AS STRING), 'N') AS Latitude,
  concat(CAST(user_id % 180 AS STRING), 'W') AS Longitude
FROM {events}
""",
    "country_temps": """
SELECT CAST(ts AS DATE) AS dt,
  CASE WHEN event_type <> 'error' THEN value END AS AverageTemperature,
  CAST(event_id % 16 AS DOUBLE) AS AverageTemperatureUncertainty,
  concat('Nation_', CAST(user_id % 20 AS STRING)) AS Country
FROM {events}
""",
}

_SOURCES = ("lineitem", "nation", "supplier", "part", "customer", "events")


def spark_view(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    text = VIEWS[name].replace("{DAY}", SPARK_DAY).replace("{q}", "`")
    tables = {
        source: spark.read.parquet(f"{sf_dir}/{source}.parquet")
        for source in _SOURCES if "{" + source + "}" in text
    }
    return spark.sql(text, **tables)


def duckdb_view(name: str) -> str:
    text = VIEWS[name].replace("{DAY}", DUCKDB_DAY).replace("{q}", '"')
    for source in _SOURCES:
        text = text.replace("{" + source + "}", source)
    return text.strip()
