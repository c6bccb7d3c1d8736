"""Data-quality checks and the constraints Parquet tables do not enforce.

The reports return DataFrames; the check_* functions raise on a violation.
"""

from __future__ import annotations

import datetime
from collections.abc import Callable, Sequence
from functools import reduce
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from landfall.schemas import TableSpec
from landfall.sources.readers import with_load_day


class DataQualityError(ValueError):
    """A check did not hold."""


def check(df: DataFrame, predicate: Callable[[Any], bool], name: str) -> Any:
    """Apply `predicate` to the first cell of `df`; no row at all is a failure."""
    row = df.first()
    if row is None or len(row) == 0:
        raise DataQualityError(f"{name}: no result")
    if not predicate(row[0]):
        raise DataQualityError(f"{name}: unexpected value {row[0]!r}")
    return row[0]


#: Predicates that a configuration can name, each with the number of values it takes.
PREDICATES: dict[str, tuple[int, Callable[..., bool]]] = {
    "zero": (0, lambda found: found == 0),
    "not_zero": (0, lambda found: found != 0),
    "true": (0, lambda found: found is True),
    "null": (0, lambda found: found is None),
    "equals": (1, lambda found, value: found == value),
    "at_least": (1, lambda found, value: found is not None and found >= value),
    "at_most": (1, lambda found, value: found is not None and found <= value),
    "between": (2, lambda found, low, high: found is not None and low <= found <= high),
}


def check_sql(spark: SparkSession, asked: dict, tables: dict[str, DataFrame],
              **bound: Any) -> Any:
    """A check given as data: `name`, `sql`, `expect` (one of PREDICATES), and the `values`
    that the predicate takes.

    The statement names tables as `{dim_ports}`; parameters such as `:start` are bound,
    never put into its text, and those under `parameters` join the ones given here. Its
    first cell is judged; no row at all is a failure.
    """
    unknown = set(asked) - {"name", "sql", "expect", "values", "parameters"}
    if unknown or not {"name", "sql", "expect"} <= set(asked):
        raise ValueError(f"a check has name, sql, expect, values, parameters: {sorted(asked)}")
    if asked["expect"] not in PREDICATES:
        raise ValueError(f"{asked['name']}: expect is one of {sorted(PREDICATES)}")
    count, predicate = PREDICATES[asked["expect"]]
    values = list(asked.get("values", ()))
    if len(values) != count:
        raise ValueError(f"{asked['name']}: {asked['expect']} takes {count} values")
    used = {name: table for name, table in tables.items() if "{" + name + "}" in asked["sql"]}
    found = spark.sql(asked["sql"], {**bound, **asked.get("parameters", {})}, **used)
    return check(found, lambda cell: predicate(cell, *values), asked["name"])


def _check_empty(violations: DataFrame, name: str) -> None:
    row = violations.first()
    if row is not None:
        raise DataQualityError(f"{name}: {row.asDict()}")


# Row counts and reconciliation


def count_rows(df: DataFrame) -> DataFrame:
    return df.agg(F.count("*").alias("row_count"))


def check_staged(staging: DataFrame) -> int:
    return check(count_rows(staging), lambda rows: rows != 0, "staging row count")


def _with_known_codes(staging: DataFrame, countries: DataFrame, ports: DataFrame) -> DataFrame:
    return (staging.join(countries.select("country_code"), "country_code")
            .join(ports.select("port_code"), "port_code"))


def _on_day(time: DataFrame, day: datetime.date) -> DataFrame:
    return time.where(
        (F.col("year") == day.year) & (F.col("month") == day.month) & (F.col("day") == day.day))


def staging_fact_diff(staging: DataFrame, countries: DataFrame, ports: DataFrame,
                      fact: DataFrame, time: DataFrame, day: datetime.date) -> DataFrame:
    """Qualifying staged rows minus fact rows of that day, as one row."""
    staged = _with_known_codes(staging, countries, ports).agg(F.count("*").alias("rows"))
    dated = _on_day(time, day).select(F.col("sas_timestamp").alias("arrdate"))
    loaded = fact.join(dated, "arrdate").agg((-F.count("*")).alias("rows"))
    return staged.union(loaded).agg(F.sum("rows").alias("difference"))


def check_reconciled(staging: DataFrame, countries: DataFrame, ports: DataFrame,
                     fact: DataFrame, time: DataFrame, day: datetime.date) -> int:
    return check(staging_fact_diff(staging, countries, ports, fact, time, day),
                 lambda difference: difference == 0, f"staging to fact, {day}")


def reconciliation(codes: DataFrame, countries: DataFrame, ports: DataFrame,
                   fact: DataFrame, time: DataFrame) -> DataFrame:
    """The same comparison for all days at once: load_day, staged, loaded, difference.

    `codes` are the code_counts of the staged arrivals.
    """
    staged = (_with_known_codes(codes, countries, ports)
              .groupBy("load_day").agg(F.sum("arrivals").alias("staged")))
    dates = time.select(
        F.col("sas_timestamp").alias("arrdate"),
        F.make_date("year", "month", "day").alias("load_day"))
    loaded = (fact.groupBy("arrdate").agg(F.count("*").alias("loaded"))
              .join(dates, "arrdate").select("load_day", "loaded"))
    both = staged.join(loaded, "load_day", "full")
    counts = [F.coalesce(F.col(c), F.lit(0)).alias(c) for c in ("staged", "loaded")]
    return both.select("load_day", *counts).withColumn(
        "difference", F.col("staged") - F.col("loaded"))


# Constraints


def unique_violations(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Key values that occur more than once. A key with NULL in it never repeats."""
    complete = reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys])
    return (df.where(complete).groupBy(*keys).agg(F.count("*").alias("occurrences"))
            .where("occurrences > 1"))


def check_unique(df: DataFrame, keys: Sequence[str]) -> None:
    _check_empty(unique_violations(df, keys), f"unique {tuple(keys)}")


def fk_orphans(child: DataFrame, fk: str, parent: DataFrame, pk: str) -> DataFrame:
    """Distinct foreign-key values without a parent row; NULL refers to nothing."""
    used = child.where(F.col(fk).isNotNull()).select(F.col(fk).alias("orphan")).distinct()
    known = parent.select(F.col(pk).alias("_known"))
    return used.join(known, F.col("orphan") == F.col("_known"), "left_anti")


def fk_orphan_counts(links: Sequence[tuple[str, DataFrame, str, DataFrame, str]]) -> DataFrame:
    """(constraint_name, orphans): the distinct values without a parent row of all foreign
    keys (name, child, column, parent, key) at once.

    Each child and each parent is read once: a row gives one (constraint, value) per key, and
    tasks drop repeats before the shuffle, so that its size is that of the distinct values.
    """
    def values(side: int, column: int) -> DataFrame:
        tables: dict[int, tuple[DataFrame, list[Column]]] = {}
        for link in links:
            pair = F.struct(F.lit(link[0]).alias("constraint_name"),
                            F.col(link[column]).cast("string").alias("value"))
            tables.setdefault(id(link[side]), (link[side], []))[1].append(pair)
        sets = [table.select(F.explode(F.array(*pairs)).alias("v")).select("v.*")
                .where("value IS NOT NULL").distinct() for table, pairs in tables.values()]
        return reduce(DataFrame.unionByName, sets)

    orphans = values(1, 2).join(values(3, 4), ["constraint_name", "value"], "left_anti")
    counted = orphans.groupBy("constraint_name").agg(F.count("*").alias("orphans"))
    spark = links[0][1].sparkSession
    names = spark.createDataFrame([(link[0],) for link in links], "constraint_name string")
    return names.join(F.broadcast(counted), "constraint_name", "left").select(
        "constraint_name", F.coalesce("orphans", F.lit(0)).cast("long").alias("orphans"))


def check_fk(child: DataFrame, fk: str, parent: DataFrame, pk: str) -> None:
    _check_empty(fk_orphans(child, fk, parent, pk), f"foreign key {fk}")


def null_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """NULLs per column, from one pass: column_name, nulls."""
    counted = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns])
    return counted.unpivot([], list(columns), "column_name", "nulls")


def check_not_null(df: DataFrame, columns: Sequence[str]) -> None:
    if columns:
        _check_empty(null_counts(df, columns).where("nulls > 0"), "not null")


def length_counts(df: DataFrame, limits: dict[str, int]) -> DataFrame:
    """Text lengths against their limits, from one pass: column_name, max_length,
    length_limit, too_long."""
    counted = df.agg(F.array(*[
        F.struct(
            F.lit(name).alias("column_name"),
            F.max(F.length(name)).alias("max_length"),
            F.lit(limit).alias("length_limit"),
            F.count_if(F.length(name) > limit).alias("too_long"))
        for name, limit in limits.items()
    ]).alias("counts"))
    return counted.select(F.explode("counts").alias("c")).select("c.*")


def check_lengths(df: DataFrame, limits: dict[str, int]) -> None:
    if limits:
        _check_empty(length_counts(df, limits).where("too_long > 0"), "text length")


def violation_counts(df: DataFrame, spec: TableSpec,
                     parents: dict[str, DataFrame]) -> DataFrame:
    """NOT NULL, length and foreign-key violations of a table, from one pass over
    it: constraint_name, violations. Parents of a size to broadcast cost no shuffle."""
    counts = {f"{c} not null": F.count_if(F.col(c).isNull()) for c in spec.not_null}
    for name, limit in spec.lengths.items():
        counts[f"{name} length"] = F.count_if(F.length(name) > limit)
    joined = df
    for fk in spec.foreign_keys:
        known = f"_{fk.column}_known"
        joined = joined.join(
            parents[fk.parent].select(F.col(fk.parent_column).alias(known)),
            F.col(fk.column) == F.col(known), "left")
        counts[f"{fk.column} in {fk.parent}"] = F.count_if(
            F.col(fk.column).isNotNull() & F.col(known).isNull())
    counted = joined.agg(*[count.alias(name) for name, count in counts.items()])
    return counted.unpivot([], [F.col(f"`{n}`") for n in counts], "constraint_name", "violations")


def check_table(df: DataFrame, spec: TableSpec, parents: dict[str, DataFrame],
                unique: bool = True) -> None:
    """All constraints of a table, in one job. Each unique key shuffles its columns."""
    violations = violation_counts(df, spec, parents).where("violations > 0")
    for keys in spec.unique if unique else ():
        repeated = unique_violations(df, keys)
        violations = violations.union(repeated.select(
            F.lit(f"unique {', '.join(keys)}"), "occurrences"))
    _check_empty(violations, spec.name)


def unordered(df: DataFrame, by: Sequence[str]) -> DataFrame:
    """Proof that Parquet files read as `df` are ordered by `by`, all in all: the breaks.

    One row for each place (file, row) whose key is smaller than the one before it: within a
    file by the place of its rows, and between files by the smallest and the largest key,
    in the order of their names. NULLs come first. A window holds one file's rows, or one row
    for each file.
    """
    key = F.struct(*[F.col(c) for c in by])
    placed = df.select(F.col("_metadata.file_path").alias("file"),
                       F.col("_metadata.row_index").alias("row"), key.alias("key"))
    here = Window.partitionBy("file").orderBy("row")
    inside = placed.withColumn("before", F.lag("key").over(here)).where(
        F.col("key") < F.col("before")).select("file", "row")
    spans = placed.groupBy("file").agg(F.min("key").alias("low"), F.max("key").alias("high"))
    between = spans.withColumn(
        "before", F.max("high").over(Window.orderBy("file").rowsBetween(
            Window.unboundedPreceding, -1))).where(F.col("low") < F.col("before"))
    return inside.unionByName(between.select("file", F.lit(0).cast("long").alias("row")))


# Reports on the input


def partition_mismatch(clean: DataFrame) -> DataFrame:
    """Partitions whose date is not the arrival date, or that have no date and so
    are never loaded, with the rows concerned."""
    dated = with_load_day(clean)
    return (
        dated.where(F.col("load_day").isNull()
                    | ~F.col("load_day").eqNullSafe(F.col("arrival_date")))
        .groupBy("year", "month", "arrival_day", "arrival_date")
        .agg(F.count("*").alias("rows"))
    )


def check_partition_dates(clean: DataFrame) -> None:
    _check_empty(partition_mismatch(clean), "partition date")


def undated(clean: DataFrame) -> DataFrame:
    """Lake partitions that are no date, with their rows."""
    return (
        with_load_day(clean).where(F.col("load_day").isNull())
        .groupBy("year", "month", "arrival_day").agg(F.count("*").alias("rows")))


def check_dated(clean: DataFrame) -> None:
    _check_empty(undated(clean), "existing day of arrival")


def accounting(staging: DataFrame, countries: DataFrame, ports: DataFrame) -> DataFrame:
    """(outcome, arrivals): what becomes of each arrival. The outcomes add up to all.

    undated: its day does not exist; country, port: the first code the lookups lack;
    loaded: the rest.
    """
    country = countries.select(F.col("country_code").alias("_country")).distinct()
    port = ports.select(F.col("port_code").alias("_port")).distinct()
    outcome = (
        F.when(F.col("load_day").isNull(), "undated")
        .when(F.col("_country").isNull(), "country")
        .when(F.col("_port").isNull(), "port").otherwise("loaded"))
    # Counted before the joins: they then see one row per combination of codes.
    counted = staging.groupBy("load_day", "country_code", "port_code").agg(
        F.count("*").alias("arrivals"))
    return (
        counted.join(country, F.col("country_code") == F.col("_country"), "left")
        .join(port, F.col("port_code") == F.col("_port"), "left")
        .groupBy(outcome.alias("outcome")).agg(F.sum("arrivals").alias("arrivals")))


def unmatched_codes(staging: DataFrame, lookup: DataFrame, key: str) -> DataFrame:
    """Codes the lookup lacks, with the arrivals the fact loses to each."""
    counted = staging.groupBy(key).agg(F.count("*").alias("arrivals"))
    known = lookup.select(F.col(key).alias("_known"))
    return counted.join(known, F.col(key) == F.col("_known"), "left_anti")
