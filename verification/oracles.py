"""The expected results as DuckDB SQL, stated independently of the Spark code.

Statements are put together from common table expressions; each one carries only
those it needs.
"""

from __future__ import annotations

import re

from verification.tables import VIEWS, duckdb_view


def _sas_date(days: str) -> str:
    return f"(DATE '1960-01-01' + CAST(floor({days}) AS INTEGER))"


def _first(source: str, keys: str, order: str) -> str:
    return (f"SELECT * FROM {source} QUALIFY row_number() OVER "
            f"(PARTITION BY {keys} ORDER BY {order}) = 1")


_TEMP = "CAST(average_temperature AS DECIMAL(16,3)) AS average_temperature"


def _countries(staged: str, seen: str) -> dict[str, str]:
    """Candidates for dim_countries from one batch."""
    return {
        seen: f"""
SELECT l.country_code, min(s.load_day) AS first_seen, l.country
FROM {staged} s JOIN lookup_countries l ON s.country_code = l.country_code
GROUP BY l.country_code, l.country""",
        f"{seen}_temps": f"""
SELECT DISTINCT s.first_seen, s.country_code, s.country,
  t.AverageTemperature AS average_temperature
FROM {seen} s LEFT JOIN latest_country t ON upper(s.country) = upper(t.Country)""",
    }


_COUNTRY_ORDER = "first_seen, country_code, average_temperature NULLS LAST"

# Whether a raw row's filed month has the day on which it arrived.
_DATED = (f"day({_sas_date('arrdate')}) <= "
          "day(last_day(make_date(CAST(i94yr AS INTEGER), CAST(i94mon AS INTEGER), 1)))")


def _rerun(batch: str) -> str:
    """Counts of a batch of 1996, whose country names have one code each, loaded twice."""
    return f"""
SELECT count(*) AS arrivals, count(*) FILTER (WHERE c IS NULL) AS no_country,
  count(*) FILTER (WHERE c IS NOT NULL AND p IS NULL) AS no_port,
  count(*) FILTER (WHERE c IS NOT NULL AND p IS NOT NULL) AS loaded,
  count(*) FILTER (WHERE c IS NOT NULL AND p IS NOT NULL) AS fact_rows,
  count(*) FILTER (WHERE c IS NOT NULL AND p IS NOT NULL) AS ids, true AS unchanged
FROM (SELECT l.country_code AS c, o.port_code AS p FROM staged s
  LEFT JOIN lookup_countries l ON l.country_code = s.country_code
  LEFT JOIN lookup_ports o ON o.port_code = s.port_code WHERE {batch})"""


_CTES: dict[str, str] = {
    **{name: duckdb_view(name) for name in VIEWS},
    "clean": f"""
SELECT CAST(trunc(i94bir) AS INTEGER) AS age,
  CAST(CAST(trunc(i94cit) AS INTEGER) AS VARCHAR) AS country_code,
  i94port AS port_code,
  CASE i94mode WHEN 1 THEN 'Air' WHEN 2 THEN 'Sea' WHEN 3 THEN 'Land'
    ELSE 'Not Reported' END AS mode,
  CASE i94visa WHEN 1 THEN 'Business' WHEN 2 THEN 'Pleasure' WHEN 3 THEN 'Student'
    ELSE 'Not Reported' END AS visa_category,
  visatype, gender, CAST(trunc(biryear) AS INTEGER) AS birth_year, arrdate,
  {_sas_date('arrdate')} AS arrival_date, depdate, {_sas_date('depdate')} AS departure_date,
  CAST(i94yr AS INTEGER) AS year, CAST(i94mon AS INTEGER) AS month,
  CAST(day({_sas_date('arrdate')}) AS INTEGER) AS arrival_day
FROM raw_arrivals""",
    "staged": "SELECT *, make_date(year, month, arrival_day) AS load_day FROM clean",
    "batch_one": "SELECT * FROM staged WHERE arrival_date < DATE '1998-01-01'",
    "batch_two": "SELECT * FROM staged WHERE arrival_date >= DATE '1998-01-01'",
    "latest_city": """
SELECT * FROM (
  SELECT *, CAST(dense_rank() OVER (PARTITION BY City ORDER BY dt DESC NULLS LAST) AS INTEGER)
    AS rank
  FROM city_temps WHERE AverageTemperature IS NOT NULL AND Country = 'United States')
WHERE rank = 1""",
    "latest_country": """
SELECT * FROM (
  SELECT *, CAST(dense_rank() OVER (PARTITION BY Country ORDER BY dt DESC NULLS LAST)
    AS INTEGER) AS rank
  FROM country_temps WHERE AverageTemperature IS NOT NULL)
WHERE rank = 1""",
    **_countries("staged", "seen_countries"),
    **_countries("batch_one", "seen_one"),
    **_countries("batch_two", "seen_two"),
    "chosen_countries": _first("seen_countries_temps", "country", _COUNTRY_ORDER),
    "dim_countries": f"""
SELECT row_number() OVER (ORDER BY country, country_code) AS country_id, country_code, country,
  {_TEMP} FROM chosen_countries""",
    "seen_ports": """
SELECT l.port_code, min(s.load_day) AS first_seen, l.city, l.state
FROM staged s JOIN lookup_ports l ON s.port_code = l.port_code
GROUP BY l.port_code, l.city, l.state""",
    "port_candidates": """
SELECT DISTINCT s.port_code, s.city AS port_city, s.state AS port_state,
  t.AverageTemperature AS average_temperature
FROM seen_ports s LEFT JOIN latest_city t ON upper(s.city) = upper(t.City)""",
    "chosen_ports": _first(
        "port_candidates", "port_code",
        "port_city, port_state, average_temperature NULLS LAST"),
    "dim_ports": f"""
SELECT row_number() OVER (ORDER BY port_code) AS port_id, port_code, port_city, port_state,
  {_TEMP} FROM chosen_ports""",
    "airport_rows": """
SELECT p.port_code, p.port_id, a.type AS airport_type, a.name AS airport_name, a.elevation_ft,
  a.municipality, a.gps_code, a.iata_code, a.local_code, a.coordinates
FROM airports a JOIN dim_ports p ON a.ident = p.port_code""",
    "chosen_airports": _first(
        "airport_rows", "port_id",
        "airport_type, airport_name, elevation_ft, municipality, gps_code, "
        "iata_code NULLS LAST, local_code, coordinates"),
    "dim_airports": """
SELECT row_number() OVER (ORDER BY port_code) AS airport_id, port_id, airport_type,
  airport_name, elevation_ft, municipality, gps_code, iata_code, local_code, coordinates
FROM chosen_airports""",
    "demographic_rows": """
SELECT DISTINCT p.port_id, d."Median Age" AS median_age,
  d."Male Population" AS male_population, d."Female Population" AS female_population,
  d."Total Population" AS total_population, d."Number of Veterans" AS number_of_veterans,
  d."Foreign-born" AS foreign_born, d."Average Household Size" AS avg_household_size,
  d.Race AS race, d."Count" AS demo_count
FROM dim_ports p JOIN demographics d
  ON upper(p.port_city) = upper(d.City) AND upper(p.port_state) = upper(d."State Code")
WHERE EXISTS (SELECT 1 FROM staged i WHERE i.port_code = p.port_code)""",
    "chosen_demographics": """
SELECT * FROM demographic_rows WHERE race IS NULL
UNION ALL
SELECT * FROM (
  SELECT * FROM demographic_rows WHERE race IS NOT NULL
  QUALIFY row_number() OVER (PARTITION BY port_id, race ORDER BY median_age, male_population,
    female_population, total_population, number_of_veterans, foreign_born,
    avg_household_size, demo_count) = 1)""",
    "dim_demographics": """
SELECT row_number() OVER (ORDER BY port_id, race NULLS LAST, median_age, male_population,
    female_population, total_population, number_of_veterans, foreign_born,
    avg_household_size, demo_count) AS demographics_id, port_id, median_age, male_population,
  female_population, total_population, number_of_veterans, foreign_born, avg_household_size,
  race, demo_count
FROM chosen_demographics""",
    "days_seen": """
SELECT arrdate AS day FROM staged
UNION SELECT depdate FROM staged WHERE depdate IS NOT NULL""",
    "dim_time": """
SELECT CAST(day AS INTEGER) AS sas_timestamp, CAST(date_part('year', d) AS INTEGER) AS year,
  CAST(date_part('month', d) AS INTEGER) AS month, CAST(date_part('day', d) AS INTEGER) AS day,
  CAST(date_part('week', d) AS INTEGER) AS week,
  CAST(date_part('dow', d) AS INTEGER) AS day_of_week,
  CAST(date_part('quarter', d) AS INTEGER) AS quarter
FROM (SELECT day, DATE '1960-01-01' + CAST(day AS INTEGER) AS d FROM days_seen)""",
    "fact": """
SELECT c.country_id, p.port_id, i.age, i.mode AS travel_mode, i.visa_category,
  i.visatype AS visa_type, i.gender, i.birth_year, CAST(i.depdate AS INTEGER) AS depdate,
  i.load_day, CAST(i.arrdate AS INTEGER) AS arrdate
FROM staged i JOIN dim_countries c ON i.country_code = c.country_code
  JOIN dim_ports p ON i.port_code = p.port_code""",
    "fact_1996_12": """
SELECT f.*, t.year, t.month, t.day, t.day_of_week
FROM fact f JOIN dim_time t ON f.arrdate = t.sas_timestamp
WHERE t.year = 1996 AND t.month = 12""",
}


def _needed(text: str) -> list[str]:
    """Names of the expressions `text` uses, in order of definition."""
    found: set[str] = set()
    pending = [text]
    while pending:
        words = set(re.findall(r"\w+", pending.pop()))
        for name in words & _CTES.keys() - found:
            found.add(name)
            pending.append(_CTES[name])
    return [name for name in _CTES if name in found]


def _statement(body: str) -> str:
    ctes = ",\n".join(f"{name} AS ({_CTES[name].strip()})" for name in _needed(body))
    return f"WITH {ctes}\n{body.strip()}"


def _count_by(code: str, label: str) -> str:
    cases = {"mode": ("Air", "Sea", "Land"), "visa_category": ("Business", "Pleasure", "Student")}
    one, two, three = cases[label]
    return f"""
SELECT {code}, CASE {code} WHEN 1 THEN '{one}' WHEN 2 THEN '{two}' WHEN 3 THEN '{three}'
  ELSE 'Not Reported' END AS {label}, count(*) AS arrivals
FROM raw_arrivals GROUP BY ALL"""


def _upsert(in_batch: str) -> str:
    """Countries of the second batch that are absent after the first."""
    if in_batch == "first":
        one = _first("seen_one_temps", "country", _COUNTRY_ORDER)
        two = ("SELECT * FROM (SELECT * FROM seen_two_temps s WHERE NOT EXISTS "
               "(SELECT 1 FROM existing e WHERE e.country = s.country)) "
               "QUALIFY row_number() OVER (PARTITION BY country ORDER BY "
               f"{_COUNTRY_ORDER}) = 1")
    else:
        one = "SELECT * FROM seen_one_temps"
        two = ("SELECT * FROM seen_two_temps s WHERE NOT EXISTS "
               "(SELECT 1 FROM existing e WHERE e.country = s.country)")
    body = f"""
SELECT (SELECT count(*) FROM existing) + row_number() OVER (
    ORDER BY country, country_code, CAST(average_temperature AS DOUBLE) NULLS LAST)
    AS country_id, country_code, country, {_TEMP}
FROM ({two})"""
    needed = _needed(one + body)
    ctes = ",\n".join(f"{name} AS ({_CTES[name].strip()})" for name in needed)
    return f"WITH {ctes},\nexisting AS ({one}){body}"


def _orphans(name: str, child: str, fk: str, parent: str, pk: str) -> str:
    return (f"SELECT '{name}' AS constraint_name, count(DISTINCT {fk}) AS orphans FROM {child} x "
            f"WHERE {fk} IS NOT NULL AND NOT EXISTS "
            f"(SELECT 1 FROM {parent} y WHERE y.{pk} = x.{fk})")


_FOREIGN_KEYS = (
    ("dim_airports.port_id", "dim_airports", "port_id", "dim_ports", "port_id"),
    ("dim_demographics.port_id", "dim_demographics", "port_id", "dim_ports", "port_id"),
    ("fact_immigration.port_id", "fact", "port_id", "dim_ports", "port_id"),
    ("fact_immigration.country_id", "fact", "country_id", "dim_countries", "country_id"),
    ("fact_immigration.arrdate", "fact", "arrdate", "dim_time", "sas_timestamp"),
    ("fact_immigration.depdate", "fact", "depdate", "dim_time", "sas_timestamp"),
    ("arrivals.country_code", "staged", "country_code", "lookup_countries", "country_code"),
    ("arrivals.port_code", "staged", "port_code", "lookup_ports", "port_code"),
)

_CLEAN_COLUMNS = (
    "age", "country_code", "port_code", "mode", "visa_category", "visatype", "gender",
    "birth_year", "arrdate", "arrival_date", "depdate", "departure_date", "year", "month",
    "arrival_day",
)

_LENGTHS = (("ident", 3), ("type", 8), ("name", 256), ("iata_code", 2))

_BODIES: dict[str, str] = {
    "raw_arrivals_scan": "SELECT * FROM raw_arrivals",
    "stage_ports_csv": "SELECT * FROM lookup_ports",
    "day_partition_scan": "SELECT * FROM clean WHERE year = 1996 AND month = 12 "
                          "AND arrival_day = 24",
    "clean_arrivals": "SELECT * FROM clean",
    "lake_rewrite": f"""
SELECT CAST(i94yr AS INTEGER) AS year, CAST(i94mon AS INTEGER) AS month,
  CAST(day({_sas_date('arrdate')}) AS INTEGER) AS arrival_day, count(*) AS rows
FROM (SELECT * FROM raw_arrivals WHERE {_sas_date('arrdate')} < DATE '1996-01-01'
      UNION ALL SELECT * FROM raw_arrivals_late WHERE {_sas_date('arrdate')} >= DATE '1996-01-01')
WHERE {_DATED} GROUP BY ALL""",
    "extract_observed": f"""
SELECT step, run, count(*) AS rows, count(*) FILTER (WHERE NOT dated) AS undated,
  count(*) FILTER (WHERE dated AND stray) AS strays,
  (SELECT count(*) FROM raw_arrivals_late WHERE NOT ({_DATED}) AND CASE step
     WHEN 1 THEN {_sas_date('arrdate')} < DATE '1996-01-01'
     WHEN 2 THEN true ELSE {_sas_date('arrdate')} >= DATE '1996-01-01' END) AS aside
FROM (SELECT CASE WHEN early THEN 1 ELSE 2 END AS step,
        CASE WHEN early THEN 'early' ELSE 'later' END AS run, dated, stray
      FROM (SELECT *, {_sas_date('arrdate')} < DATE '1996-01-01' AS early, {_DATED} AS dated,
              i94mon <> month({_sas_date('arrdate')}) AS stray FROM raw_arrivals_late)
      UNION ALL
      SELECT 3, 'early', true, false FROM raw_arrivals
      WHERE {_sas_date('arrdate')} < DATE '1996-01-01')
GROUP BY step, run""",
    "month_files_scan": f"""
SELECT 'i94_' || lower(strftime({_sas_date('arrdate')}, '%b%y')) || '_sub' AS run,
  count(*) AS rows, min(arrdate) AS first, max(arrdate) AS last
FROM raw_arrivals GROUP BY ALL""",
    "temps_csv_scan": "SELECT * FROM city_temps",
    "staged_parquet_scan": """
SELECT City, Race, "Total Population" AS total_population FROM demographics""",
    "staged_json_scan": "SELECT * FROM airports",
    "lookups_scan": """
SELECT 'countries' AS lookup, count(*) AS rows, count(DISTINCT country_code) AS codes
FROM lookup_countries
UNION ALL SELECT 'ports', count(*), count(DISTINCT port_code) FROM lookup_ports""",
    "sorted_extract": """
SELECT count(*) AS rows, min(City) AS first, max(City) AS last, CAST(0 AS BIGINT) AS breaks
FROM latest_city""",
    "user_checks": """
SELECT 'loaded' AS name, count(*) FILTER (WHERE load_day = DATE '1996-12-24') <> 0 AS held
FROM fact
UNION ALL SELECT 'no age', count(*) = count(age) FROM fact
UNION ALL SELECT 'age', max(age) BETWEEN 19 AND 68 FROM fact
UNION ALL SELECT 'few ports', count(*) <= 3 FROM dim_ports
UNION ALL SELECT 'calendar', true""",
    "load_day_rerun": _rerun("load_day = DATE '1996-12-24'"),
    "range_rerun": _rerun("year(load_day) = 1996 AND month(load_day) = 12"),
    "sas_dates": f"""
SELECT arrdate, depdate, {_sas_date('arrdate')} AS arrival_date,
  CAST(day({_sas_date('arrdate')}) AS INTEGER) AS arrival_day,
  {_sas_date('depdate')} AS departure_date,
  {_sas_date('i94bir - arrdate / 8')} AS early_date,
  CAST(day({_sas_date('i94bir - arrdate / 8')}) AS INTEGER) AS early_day
FROM raw_arrivals""",
    "decode_mode": _count_by("i94mode", "mode"),
    "decode_visa": _count_by("i94visa", "visa_category"),
    "arrivals_by_month_filter": """
SELECT country_id, port_id, age, travel_mode, arrdate, depdate, year, month, day, day_of_week
FROM fact_1996_12""",
    "seen_countries": "SELECT country_code, first_seen, country FROM seen_countries",
    "seen_ports": "SELECT port_code, first_seen, city, state FROM seen_ports",
    "country_temp_enrich": """
SELECT c.country_code, c.country, t.AverageTemperature
FROM lookup_countries c LEFT JOIN latest_country t ON upper(c.country) = upper(t.Country)""",
    "port_temp_enrich": """
SELECT p.port_code, p.city, p.state, t.AverageTemperature
FROM lookup_ports p LEFT JOIN latest_city t ON upper(p.city) = upper(t.City)""",
    "new_keys_antijoin": """
SELECT DISTINCT l.port_code, l.city, l.state
FROM lookup_ports l JOIN batch_two s ON l.port_code = s.port_code
WHERE l.port_code NOT IN (SELECT port_code FROM batch_one WHERE port_code IS NOT NULL)""",
    "ports_in_batch": """
SELECT * FROM dim_ports p
WHERE EXISTS (SELECT 1 FROM batch_one i WHERE i.port_code = p.port_code)""",
    "port_demographics_join": """
SELECT p.port_id, d."Median Age" AS median_age,
  d."Male Population" AS male_population, d."Female Population" AS female_population,
  d."Total Population" AS total_population, d."Number of Veterans" AS number_of_veterans,
  d."Foreign-born" AS foreign_born, d."Average Household Size" AS avg_household_size,
  d.Race AS race, d."Count" AS demo_count
FROM dim_ports p JOIN demographics d
  ON upper(p.port_city) = upper(d.City) AND upper(p.port_state) = upper(d."State Code")""",
    "port_airports_join": "SELECT * FROM airport_rows",
    "fact_arrivals": "SELECT * FROM fact",
    "fact_arrivals_shuffled": "SELECT * FROM fact",
    "new_demographics_antijoin": """
SELECT r.* FROM demographic_rows r WHERE NOT EXISTS (
  SELECT 1 FROM demographic_rows e JOIN dim_ports p ON e.port_id = p.port_id
  WHERE p.port_code IN (SELECT port_code FROM batch_one WHERE port_code IS NOT NULL)
    AND e.port_id = r.port_id AND e.race = r.race)""",
    "staging_count": "SELECT count(*) AS row_count FROM staged",
    "staging_fact_diff": """
SELECT (SELECT count(*) FROM staged i JOIN dim_countries c ON i.country_code = c.country_code
    JOIN dim_ports p ON i.port_code = p.port_code)
  - (SELECT count(*) FROM fact_1996_12 WHERE day = 24) AS difference""",
    "latest_city_temps": "SELECT * FROM latest_city",
    "latest_country_temps": "SELECT * FROM latest_country",
    "distinct_days_union": "SELECT * FROM days_seen",
    "dim_countries": "SELECT * FROM dim_countries",
    "dim_ports": "SELECT * FROM dim_ports",
    "dim_airports": "SELECT * FROM dim_airports",
    "dim_demographics": "SELECT * FROM dim_demographics",
    "dim_time": "SELECT * FROM dim_time",
    "unique_violations": """
SELECT 'country' AS constraint_name, country AS key_value, count(*) AS occurrences
FROM lookup_countries GROUP BY country HAVING count(*) > 1
UNION ALL
SELECT 'ident', ident, count(*) FROM airports GROUP BY ident HAVING count(*) > 1
UNION ALL
SELECT 'city_state_race', concat(City, '|', "State Code", '|', Race), count(*)
FROM demographics WHERE Race IS NOT NULL GROUP BY City, "State Code", Race
HAVING count(*) > 1""",
    "fk_orphans": "\nUNION ALL ".join(_orphans(*link) for link in _FOREIGN_KEYS),
    "null_violations": "\nUNION ALL ".join(
        f"SELECT '{c}' AS column_name, count(*) - count({c}) AS nulls FROM staged"
        for c in _CLEAN_COLUMNS),
    "length_violations": "\nUNION ALL ".join(
        f"SELECT '{c}' AS column_name, CAST(max(length({c})) AS INTEGER) AS max_length, "
        f"CAST({n} AS INTEGER) AS length_limit, "
        f"count(*) FILTER (WHERE length({c}) > {n}) AS too_long FROM airports"
        for c, n in _LENGTHS),
    "partition_mismatch": f"""
SELECT CAST(i94yr AS INTEGER) AS year, CAST(i94mon AS INTEGER) AS month,
  CAST(day({_sas_date('arrdate')}) AS INTEGER) AS arrival_day,
  {_sas_date('arrdate')} AS arrival_date, count(*) AS rows
FROM raw_arrivals_late
WHERE i94yr <> year({_sas_date('arrdate')}) OR i94mon <> month({_sas_date('arrdate')})
GROUP BY ALL""",
    "unmatched_codes": """
SELECT 'country' AS kind, country_code AS code, count(*) AS arrivals FROM staged s
WHERE NOT EXISTS (SELECT 1 FROM lookup_countries l WHERE l.country_code = s.country_code)
GROUP BY country_code
UNION ALL
SELECT 'port', port_code, count(*) FROM staged s
WHERE NOT EXISTS (SELECT 1 FROM lookup_ports l WHERE l.port_code = s.port_code)
GROUP BY port_code""",
    "extract_accounting": """
SELECT outcome, count(*) AS arrivals FROM (
  SELECT CASE
    WHEN arrival_day IS NULL OR age % 11 = 0
      OR (age % 7 = 0 AND arrival_day > day(last_day(make_date(year, 2, 1)))) THEN 'undated'
    WHEN age % 11 IS NULL THEN 'undated'
    WHEN NOT EXISTS (SELECT 1 FROM lookup_countries l WHERE l.country_code = s.country_code)
      THEN 'country'
    WHEN NOT EXISTS (SELECT 1 FROM lookup_ports l WHERE l.port_code = s.port_code) THEN 'port'
    ELSE 'loaded' END AS outcome
  FROM clean s)
GROUP BY outcome""",
    "fact_ids": """
SELECT count(*) AS fact_rows, count(*) AS ids, CAST(0 AS BIGINT) AS nulls FROM fact""",
    "load_day_counts": """
SELECT load_day, count(*) AS staged, count(*) AS loaded, CAST(0 AS BIGINT) AS difference
FROM fact GROUP BY load_day""",
    "top_countries": """
SELECT c.country, count(*) AS count
FROM fact_1996_12 f JOIN dim_countries c ON f.country_id = c.country_id
GROUP BY c.country ORDER BY count DESC, c.country LIMIT 10""",
    "top_ports": """
SELECT p.port_city, p.port_state, count(*) AS count
FROM fact_1996_12 f JOIN dim_ports p ON f.port_id = p.port_id
GROUP BY p.port_city, p.port_state ORDER BY count DESC, p.port_city, p.port_state LIMIT 10""",
    "arrivals_by_dow": """
SELECT f.day_of_week, count(*) AS count
FROM fact_1996_12 f JOIN dim_ports p ON f.port_id = p.port_id
GROUP BY f.day_of_week ORDER BY f.day_of_week""",
    "port_country_counts": """
SELECT p.port_city, c.country, count(*) AS arrivals
FROM fact f JOIN dim_ports p ON f.port_id = p.port_id
  JOIN dim_countries c ON f.country_id = c.country_id
GROUP BY p.port_city, c.country""",
    "demographics_by_origin": """
SELECT p.port_code, p.port_city, p.port_state, c.country, d.race, d.demo_count, d.median_age,
  n.arrivals
FROM (SELECT port_id, country_id, count(*) AS arrivals FROM fact GROUP BY ALL) n
  JOIN dim_ports p ON n.port_id = p.port_id
  JOIN dim_countries c ON n.country_id = c.country_id
  JOIN dim_demographics d ON n.port_id = d.port_id""",
    "temp_correlation": """
SELECT round(corr(CAST(c.average_temperature AS DOUBLE), CAST(p.average_temperature AS DOUBLE)),
  6) AS correlation
FROM fact f JOIN dim_ports p ON f.port_id = p.port_id
  JOIN dim_countries c ON f.country_id = c.country_id""",
    "seasonality": """
SELECT port_state, month, arrivals, CAST(rank() OVER (
    PARTITION BY port_state ORDER BY arrivals DESC) AS INTEGER) AS month_rank
FROM (
  SELECT p.port_state, t.month, count(*) AS arrivals
  FROM fact f JOIN dim_ports p ON f.port_id = p.port_id
    JOIN dim_time t ON f.arrdate = t.sas_timestamp
  GROUP BY p.port_state, t.month)""",
}


# Columns to show as text (dates) or as doubles (decimals, nullable integers), as
# the queries do.
_DATES = {
    "day_partition_scan": ("arrival_date", "departure_date"),
    "clean_arrivals": ("arrival_date", "departure_date"),
    "sas_dates": ("arrival_date", "departure_date", "early_date"),
    "seen_countries": ("first_seen",),
    "seen_ports": ("first_seen",),
    "fact_arrivals": ("load_day",),
    "fact_arrivals_shuffled": ("load_day",),
    "temps_csv_scan": ("dt",),
    "latest_city_temps": ("dt",),
    "latest_country_temps": ("dt",),
    "partition_mismatch": ("arrival_date",),
    "load_day_counts": ("load_day",),
}
_MEASURES = ("median_age", "avg_household_size")
_DOUBLES = {
    "day_partition_scan": ("age", "birth_year"),
    "clean_arrivals": ("age", "birth_year"),
    "sas_dates": ("early_day",),
    "arrivals_by_month_filter": ("age", "depdate"),
    "fact_arrivals": ("age", "birth_year", "depdate"),
    "fact_arrivals_shuffled": ("age", "birth_year", "depdate"),
    "ports_in_batch": ("average_temperature",),
    "dim_countries": ("average_temperature",),
    "dim_ports": ("average_temperature",),
    "insert_if_absent_first": ("average_temperature",),
    "insert_if_absent_keep": ("average_temperature",),
    "port_demographics_join": _MEASURES,
    "new_demographics_antijoin": _MEASURES,
    "dim_demographics": _MEASURES,
    "demographics_by_origin": ("median_age",),
}


def _comparable(name: str, statement: str) -> str:
    casts = [f"CAST({c} AS VARCHAR) AS {c}" for c in _DATES.get(name, ())]
    casts += [f"CAST({c} AS DOUBLE) AS {c}" for c in _DOUBLES.get(name, ())]
    return f"SELECT * REPLACE ({', '.join(casts)}) FROM ({statement})" if casts else statement


def all_oracles() -> dict[str, str]:
    statements = {name: _statement(body) for name, body in _BODIES.items()}
    statements["insert_if_absent_first"] = _upsert("first")
    statements["insert_if_absent_keep"] = _upsert("keep")
    return {name: _comparable(name, statement) for name, statement in statements.items()}
