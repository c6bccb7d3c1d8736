"""Physical plans: what is pruned, pushed, broadcast and shuffled."""

import datetime
import os
import re

import pytest
from pyspark.sql import functions as F

from landfall import schemas
from landfall.operators import dimensions, fact as facts, latest, quality, upsert
from landfall.operators.clean import clean_arrivals
from landfall.operators.fact import batch_fact
from landfall.plans import reports
from landfall.session import settle
from landfall.sources import readers
from verification.tables import spark_view

SF = "/root/testdata/sf0.001"

pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no test data")


def plan(df):
    return df._jdf.queryExecution().explainString(
        df._sc._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))


def nodes(df, name):
    tree = plan(df).split("\n\n")[0]
    return len(re.findall(rf"\b{name}\b", tree))


@pytest.fixture(scope="module")
def lake(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("plans") / "lake")
    (clean_arrivals(spark_view(spark, SF, "raw_arrivals"))
     .where("year = 1996 AND month = 12").write.partitionBy(*schemas.LAKE_PARTITIONS)
     .parquet(path))
    return path


@pytest.fixture(scope="module")
def star(spark):
    staging = readers.with_load_day(clean_arrivals(spark_view(spark, SF, "raw_arrivals")))
    return {
        "staging": staging,
        "countries": settle(dimensions.build_countries(
            staging, spark_view(spark, SF, "lookup_countries"))),
        "ports": settle(dimensions.build_ports(staging, spark_view(spark, SF, "lookup_ports"))),
        "time": settle(dimensions.build_time(staging)),
    }


def test_cleaning_is_one_projection_over_the_scan(spark):
    df = clean_arrivals(spark_view(spark, SF, "raw_arrivals"))
    assert "Exchange" not in plan(df)
    assert not re.search("Python|ArrowEval", plan(df))
    assert "WholeStageCodegen" in plan(df) or "[codegen id" in plan(df)


def test_only_needed_columns_are_read(spark, star):
    text = plan(star["staging"].groupBy("port_code").count())
    schema = re.search(r"ReadSchema: struct<([^>]*)>", text).group(1)
    assert {c.split(":")[0] for c in schema.split(",")} == {
        "l_suppkey", "l_linenumber", "l_quantity", "l_shipdate"}


def test_day_range_prunes_partitions(spark, lake):
    df = readers.read_days(spark, lake, datetime.date(1996, 12, 3), datetime.date(1996, 12, 5))
    assert re.search(r"PartitionFilters: \[.*year.*month.*arrival_day", plan(df))
    assert nodes(df, "Filter") == 0
    scan = df._jdf.queryExecution().executedPlan().collectLeaves().head()
    days = readers.read_lake(spark, lake).where("arrival_day BETWEEN 3 AND 5").select("arrival_day")
    assert scan.selectedPartitions().partitionCount() == days.distinct().count() > 0


def test_one_day_lists_one_directory(spark, lake):
    df = readers.read_day(spark, lake, datetime.date(1996, 12, 3))
    assert all("arrival_day=3" in f for f in df.inputFiles())


def test_fact_is_joined_without_a_shuffle(star):
    df = batch_fact(star["staging"], star["countries"], star["ports"])
    assert nodes(df, "BroadcastHashJoin") == 2
    assert nodes(df, "Exchange") == 0 and nodes(df, "Sort") == 0


def test_observed_fact_is_joined_without_a_shuffle(star):
    df, _ = facts.observed_fact(star["staging"], star["countries"], star["ports"])
    assert nodes(df, "BroadcastHashJoin") == 2 and nodes(df, "CollectMetrics") == 1
    assert nodes(df, "Exchange") == 0 and nodes(df, "Sort") == 0


def test_fact_is_shuffled_when_a_dimension_is_too_big_to_broadcast(spark, star):
    key = "spark.sql.autoBroadcastJoinThreshold"
    codes = settle(dimensions.code_counts(star["staging"]))
    spark.conf.set(key, "100")
    try:
        df = batch_fact(star["staging"], star["countries"], star["ports"])
        assert nodes(df, "BroadcastHashJoin") == 0
        df, _ = facts.observed_fact(star["staging"], star["countries"], star["ports"], codes)
        assert nodes(df, "SortMergeJoin") == 2
        # Brought together by partition before the write, after the joins.
        assert "REBALANCE_PARTITIONS_BY_COL" in plan(df)
        with pytest.raises(ValueError, match="code_counts"):
            facts.observed_fact(star["staging"], star["countries"], star["ports"])
    finally:
        spark.conf.unset(key)


def test_hot_codes_are_dealt_over_tasks(spark, star):
    """Half of all rows have one country and a third no port: no task gets them all."""
    base = star["staging"].limit(1)
    rows = base.crossJoin(spark.range(6000, numPartitions=4)).withColumn(
        "country_code", F.when(F.col("id") % 2 == 0, "101").otherwise(
            F.concat(F.lit("1"), F.lpad((F.col("id") % 20).cast("string"), 2, "0")))
    ).withColumn("port_code", F.when(F.col("id") % 3 > 0, F.concat(
        F.lit("P0"), (F.col("id") % 9).cast("string")))).drop("id")
    codes = settle(dimensions.code_counts(rows))
    tasks = 3
    hot = {r[0]: r[1] for r in facts.hot_codes(codes, "port_code", tasks).collect()}
    assert None in facts.hot_codes(codes, "port_code", 12).toPandas()["port_code"].tolist()
    assert len(hot) < tasks
    df, seen = facts.observed_fact(rows, star["countries"], star["ports"], codes, shuffled=True)
    df = df.cache()
    wanted = facts.build_fact(rows, star["countries"], star["ports"])
    try:
        assert df.count() == wanted.count() > 0
        assert df.exceptAll(wanted).isEmpty()
    finally:
        df.unpersist()
    counts = facts.fact_counts(seen)
    assert counts.arrivals == 6000 == counts.loaded + counts.no_country + counts.no_port
    key = "spark.sql.shuffle.partitions"
    few = spark.conf.get(key)
    spark.conf.set(key, "12")
    try:
        join, _ = facts.observed_fact(rows, star["countries"], star["ports"], codes,
                                      shuffled=True)
        assert "_salt" in plan(join) and "_place" in plan(join)
        assert join.count() == wanted.count()
    finally:
        spark.conf.set(key, few)


def test_partitions_of_the_stored_fact_are_pruned_by_the_time_dimension(spark, star):
    fact = batch_fact(star["staging"], star["countries"], star["ports"]).where(
        "year(load_day) = 1996")
    keys = schemas.TABLES["fact_immigration"].partitioned_by
    fact.hint("rebalance", *keys).write.mode("overwrite").partitionBy(*keys).saveAsTable(
        "pruned_fact")
    try:
        df = reports.arrivals_on(spark.table("pruned_fact"), star["time"], 1996, 12)
        assert re.search(r"PartitionFilters: \[.*arrdate.*dynamicpruning", plan(df))
        assert df.count() == fact.where("month(load_day) = 12").count() > 0
    finally:
        spark.sql("DROP TABLE pruned_fact")


def test_foreign_keys_take_one_scan_per_table(spark, star, tmp_path):
    fact = batch_fact(star["staging"], star["countries"], star["ports"])
    fact.write.parquet(str(tmp_path / "fact"))
    child = spark.read.parquet(str(tmp_path / "fact"))
    ports, time = star["ports"].where("port_code <> 'P01'"), star["time"]
    df = quality.fk_orphan_counts([
        ("port", child, "port_id", ports, "port_id"),
        ("country", child, "country_id", star["countries"], "country_id"),
        ("arrival", child, "arrdate", time, "sas_timestamp"),
        ("departure", child, "depdate", time, "sas_timestamp")])
    # The child, and three parents of which one has two keys.
    assert nodes(df, "parquet") == 4
    found = {r[0]: r[1] for r in df.collect()}
    assert found == {"port": 1, "country": 0, "arrival": 0, "departure": 0}


def test_first_per_key_is_cut_before_the_shuffle(spark):
    df = upsert.insert_if_absent(
        spark.range(100).selectExpr("id % 7 AS k", "id AS v"), None, ["k"], nullable=())
    assert nodes(df, "WindowGroupLimit") == 2


def test_absent_is_an_anti_join(spark):
    df = upsert.absent(spark.range(10), spark.range(5), ["id"])
    assert "LeftAnti" in plan(df)


def test_latest_ties_need_no_sort_and_no_shuffle_of_the_rows(spark):
    df = latest.latest_city_temps(spark_view(spark, SF, "city_temps"))
    assert "LeftSemi" in plan(df) and nodes(df, "BroadcastHashJoin") == 1
    assert nodes(df, "Window") == 0 and nodes(df, "Sort") == 0 and nodes(df, "Exchange") == 0


def test_days_come_from_one_scan(star):
    assert nodes(dimensions.distinct_days(star["staging"]), "parquet") == 1


def test_days_are_split_after_their_pairs_are_distinct(star):
    """The tree is printed from the root: below the Generate stands an aggregate."""
    tree = plan(dimensions.distinct_days(star["staging"])).split("\n\n")[0]
    assert "Generate" in tree and "HashAggregate" in tree.split("Generate", 1)[1]


def test_reports_combine_before_the_shuffle(star):
    fact = batch_fact(star["staging"], star["countries"], star["ports"])
    df = reports.top_countries(fact, star["countries"], star["time"], 1996, 12)
    text = plan(df)
    assert "TakeOrderedAndProject" in text
    assert nodes(df, "SortMergeJoin") == 0
    partial = re.search(r"Functions \[1\]: \[partial_count\(1\)\]", text)
    assert partial
    assert not re.search("CartesianProduct|BroadcastNestedLoopJoin", text)
