"""Table contracts: column types, keys, lengths and partitioning.

Parquet tables enforce neither keys nor NOT NULL, so the constraints live here
as data and `operators.quality` turns them into jobs.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import types as T

INT, LONG, DOUBLE, TEXT, DATE = (
    T.IntegerType(), T.LongType(), T.DoubleType(), T.StringType(), T.DateType(),
)
TEMPERATURE = T.DecimalType(16, 3)
MEASURE = T.DecimalType(18, 2)


def _struct(*columns: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(name, dtype, True) for name, dtype in columns])


RAW_ARRIVALS = _struct(
    ("i94yr", DOUBLE), ("i94mon", DOUBLE), ("i94cit", DOUBLE), ("i94port", TEXT),
    ("arrdate", DOUBLE), ("i94mode", DOUBLE), ("depdate", DOUBLE), ("i94bir", DOUBLE),
    ("i94visa", DOUBLE), ("biryear", DOUBLE), ("gender", TEXT), ("visatype", TEXT),
)

# Partition columns come last, as Spark returns them from a partitioned directory.
LAKE_PARTITIONS = ("year", "month", "arrival_day")
CLEAN_ARRIVALS = _struct(
    ("age", INT), ("country_code", TEXT), ("port_code", TEXT), ("mode", TEXT),
    ("visa_category", TEXT), ("visatype", TEXT), ("gender", TEXT), ("birth_year", INT),
    ("arrdate", DOUBLE), ("arrival_date", DATE), ("depdate", DOUBLE),
    ("departure_date", DATE), ("year", INT), ("month", INT), ("arrival_day", INT),
)

CITY_TEMPS = _struct(
    ("dt", DATE), ("AverageTemperature", DOUBLE), ("AverageTemperatureUncertainty", DOUBLE),
    ("City", TEXT), ("Country", TEXT), ("Latitude", TEXT), ("Longitude", TEXT),
)
COUNTRY_TEMPS = _struct(
    ("dt", DATE), ("AverageTemperature", DOUBLE), ("AverageTemperatureUncertainty", DOUBLE),
    ("Country", TEXT),
)


@dataclass(frozen=True)
class ForeignKey:
    column: str
    parent: str
    parent_column: str


@dataclass(frozen=True)
class TableSpec:
    """One catalog table and the constraints that hold on it."""

    name: str
    schema: T.StructType
    unique: tuple[tuple[str, ...], ...] = ()
    not_null: tuple[str, ...] = ()
    lengths: dict[str, int] = field(default_factory=dict)
    foreign_keys: tuple[ForeignKey, ...] = ()
    partitioned_by: tuple[str, ...] = ()

    @property
    def columns(self) -> list[str]:
        return self.schema.fieldNames()


_STAGING = (
    TableSpec(
        "staging_immigration", CLEAN_ARRIVALS,
        lengths={"country_code": 3, "port_code": 3, "mode": 256, "visa_category": 256,
                 "visatype": 128, "gender": 10},
    ),
    TableSpec(
        "staging_countries", _struct(("country_code", TEXT), ("country", TEXT)),
        not_null=("country_code", "country"),
        lengths={"country_code": 3, "country": 256},
    ),
    TableSpec(
        "staging_ports", _struct(("port_code", TEXT), ("city", TEXT), ("state", TEXT)),
        lengths={"port_code": 3, "city": 256, "state": 50},
    ),
    TableSpec(
        "staging_airports",
        _struct(
            ("ident", TEXT), ("type", TEXT), ("name", TEXT), ("elevation_ft", INT),
            ("continent", TEXT), ("iso_country", TEXT), ("iso_region", TEXT),
            ("municipality", TEXT), ("gps_code", TEXT), ("iata_code", TEXT),
            ("local_code", TEXT), ("coordinates", TEXT),
        ),
        lengths={name: 256 for name in (
            "ident", "type", "name", "continent", "iso_country", "iso_region",
            "municipality", "gps_code", "iata_code", "local_code", "coordinates",
        )},
    ),
    TableSpec(
        "staging_demographics",
        _struct(
            ("City", TEXT), ("State", TEXT), ("Median Age", MEASURE),
            ("Male Population", INT), ("Female Population", INT),
            ("Total Population", LONG), ("Number of Veterans", INT),
            ("Foreign-born", INT), ("Average Household Size", MEASURE),
            ("State Code", TEXT), ("Race", TEXT), ("Count", INT),
        ),
        lengths={"City": 256, "State": 100, "State Code": 50, "Race": 100},
    ),
    TableSpec("staging_city_temperatures", _struct(
        *[(f.name, f.dataType) for f in CITY_TEMPS], ("rank", INT))),
    TableSpec("staging_country_temperatures", _struct(
        *[(f.name, f.dataType) for f in COUNTRY_TEMPS], ("rank", INT))),
)

_DIMENSIONS = (
    TableSpec(
        "dim_countries",
        _struct(("country_id", LONG), ("country_code", TEXT), ("country", TEXT),
                ("average_temperature", TEMPERATURE)),
        unique=(("country_id",), ("country_code",), ("country",)),
        not_null=("country_id", "country_code", "country"),
        lengths={"country_code": 3, "country": 256},
    ),
    TableSpec(
        "dim_ports",
        _struct(("port_id", LONG), ("port_code", TEXT), ("port_city", TEXT),
                ("port_state", TEXT), ("average_temperature", TEMPERATURE)),
        unique=(("port_id",), ("port_code",)),
        not_null=("port_id",),
        lengths={"port_code": 3, "port_city": 256, "port_state": 50},
    ),
    TableSpec(
        "dim_airports",
        _struct(("airport_id", LONG), ("port_id", LONG), ("airport_type", TEXT),
                ("airport_name", TEXT), ("elevation_ft", INT), ("municipality", TEXT),
                ("gps_code", TEXT), ("iata_code", TEXT), ("local_code", TEXT),
                ("coordinates", TEXT)),
        unique=(("airport_id",), ("port_id",)),
        not_null=("airport_id",),
        lengths={name: 256 for name in (
            "airport_type", "airport_name", "municipality", "gps_code", "iata_code",
            "local_code", "coordinates",
        )},
        foreign_keys=(ForeignKey("port_id", "dim_ports", "port_id"),),
    ),
    TableSpec(
        "dim_demographics",
        _struct(("demographics_id", LONG), ("port_id", LONG), ("median_age", MEASURE),
                ("male_population", INT), ("female_population", INT),
                ("total_population", LONG), ("number_of_veterans", INT),
                ("foreign_born", INT), ("avg_household_size", MEASURE),
                ("race", TEXT), ("demo_count", INT)),
        unique=(("demographics_id",), ("port_id", "race")),
        not_null=("demographics_id",),
        lengths={"race": 100},
        foreign_keys=(ForeignKey("port_id", "dim_ports", "port_id"),),
    ),
    TableSpec(
        "dim_time",
        _struct(("sas_timestamp", INT), ("year", INT), ("month", INT), ("day", INT),
                ("week", INT), ("day_of_week", INT), ("quarter", INT)),
        unique=(("sas_timestamp",),),
        not_null=("sas_timestamp", "year", "month", "day", "week", "day_of_week", "quarter"),
    ),
)

# load_day is technical: the batch that wrote the row. A re-run replaces exactly
# that partition, also when the batch holds stray arrival dates.
_FACT = TableSpec(
    "fact_immigration",
    _struct(("immigration_id", LONG), ("country_id", LONG), ("port_id", LONG), ("age", INT),
            ("travel_mode", TEXT), ("visa_category", TEXT), ("visa_type", TEXT),
            ("gender", TEXT), ("birth_year", INT), ("depdate", INT),
            ("load_day", DATE), ("arrdate", INT)),
    unique=(("immigration_id",),),
    not_null=("immigration_id", "arrdate"),
    lengths={"travel_mode": 100, "visa_category": 100, "visa_type": 100, "gender": 10},
    foreign_keys=(
        ForeignKey("port_id", "dim_ports", "port_id"),
        ForeignKey("country_id", "dim_countries", "country_id"),
        ForeignKey("arrdate", "dim_time", "sas_timestamp"),
        ForeignKey("depdate", "dim_time", "sas_timestamp"),
    ),
    partitioned_by=("load_day", "arrdate"),
)

TABLES: dict[str, TableSpec] = {spec.name: spec for spec in (*_STAGING, *_DIMENSIONS, _FACT)}
