import pytest
from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import functions as F

from conftest import rows
from landfall.operators.fact import _within_day, assign_fact_ids, day_start
from landfall.operators.upsert import absent, assign_keys, dense_keys, insert_if_absent, next_key

SCHEMA = "k string, r string, v int"


def frame(spark, *data):
    return spark.createDataFrame(list(data), SCHEMA)


def test_first_drops_present_and_repeated_keys(spark):
    existing = frame(spark, ("a", "x", 0))
    new = frame(spark, ("a", "x", 1), ("b", "x", 3), ("b", "x", 2), ("c", "x", None), ("c", "x", 9))
    assert rows(insert_if_absent(new, existing, ["k"])) == [("b", "x", 2), ("c", "x", 9)]
    assert rows(insert_if_absent(new, None, ["k"])) == [
        ("a", "x", 1), ("b", "x", 2), ("c", "x", 9)]


def test_keep_only_drops_present_keys(spark):
    existing = frame(spark, ("a", "x", 0))
    new = frame(spark, ("a", "x", 1), ("b", "x", 3), ("b", "x", 2))
    assert rows(insert_if_absent(new, existing, ["k"], in_batch="keep")) == [
        ("b", "x", 2), ("b", "x", 3)]


def test_order_by_comes_before_the_other_columns(spark):
    new = frame(spark, ("a", "y", 1), ("a", "x", 2))
    assert rows(insert_if_absent(new, None, ["k"], ["r"])) == [("a", "x", 2)]
    assert rows(insert_if_absent(new, None, ["k"], ["v"])) == [("a", "y", 1)]


def test_null_in_a_key_conflicts_with_nothing(spark):
    existing = frame(spark, ("a", None, 0), ("a", "x", 0))
    new = frame(spark, ("a", None, 1), ("a", None, 2), ("a", "x", 3), ("b", "x", 4), ("b", "x", 5))
    assert rows(insert_if_absent(new, existing, ["k", "r"])) == [
        ("a", None, 1), ("a", None, 2), ("b", "x", 4)]
    assert rows(insert_if_absent(new, existing, ["k", "r"], null_safe=True)) == [("b", "x", 4)]
    assert rows(insert_if_absent(new, None, ["k", "r"], null_safe=True)) == [
        ("a", None, 1), ("a", "x", 3), ("b", "x", 4)]


ROWS = st.lists(st.tuples(st.sampled_from(["a", "b", "c", None]), st.sampled_from(["x", "y", None]),
                          st.one_of(st.none(), st.integers(0, 3))), min_size=1, max_size=25)


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(new=ROWS, existing=ROWS, null_safe=st.booleans(), keep=st.booleans())
def test_against_row_by_row_insertion(spark, new, existing, null_safe, keep):
    """The rule as a loop: rows come in order and enter unless their key is taken."""
    def taken(row, rows_):
        key = row[:2]
        return (null_safe or None not in key) and any(r[:2] == key for r in rows_)

    table, entered = list(existing), []
    for row in sorted(new, key=lambda r: (r[2] is None, r[2] or 0)):
        if not taken(row, existing if keep else table):
            table.append(row)
            entered.append(row)
    got = insert_if_absent(frame(spark, *new), frame(spark, *existing), ["k", "r"],
                           in_batch="keep" if keep else "first", null_safe=null_safe)
    assert rows(got) == rows(frame(spark, *entered))


def test_keys_only(spark):
    new = spark.createDataFrame([("a",), ("a",), ("b",)], "k string")
    assert rows(insert_if_absent(new, None, ["k"])) == [("a",), ("b",)]


def test_unknown_policy(spark):
    with pytest.raises(ValueError):
        insert_if_absent(frame(spark, ("a", "x", 1)), None, ["k"], in_batch="last")


def test_absent_on_two_keys(spark):
    existing = frame(spark, ("a", "x", 0))
    new = frame(spark, ("a", "x", 1), ("a", "y", 1), ("b", "x", 1))
    assert rows(absent(new, existing, ["k", "r"]), "k", "r") == [("a", "y"), ("b", "x")]


def test_assign_keys_is_dense_and_ordered(spark):
    new = spark.range(1000).select(
        F.concat(F.lit("n"), F.lpad(((F.col("id") * 7919) % 1000).cast("string"), 4, "0"))
        .alias("name")).repartition(7)
    keyed = assign_keys(new, "id", ["name"], start=41).orderBy("id").collect()
    assert [r.id for r in keyed] == list(range(41, 1041))
    assert [r.name for r in keyed] == sorted(r.name for r in keyed)


def test_dense_keys_over_many_tasks(spark):
    df = spark.range(0, 5000, numPartitions=13).where("id % 3 <> 0")
    ids = [r.n for r in dense_keys(df, "n", 100).collect()]
    assert sorted(ids) == list(range(100, 100 + df.count()))


def test_next_key(spark):
    keyed = spark.createDataFrame([(3,), (8,)], "id long")
    assert next_key(keyed, "id") == 9
    assert next_key(keyed.where("id < 0"), "id") == 1


def fact_rows(spark, days, per_day, tasks):
    return spark.range(0, days * per_day, numPartitions=tasks).select(
        F.lit(1).cast("long").alias("country_id"), F.lit(1).cast("long").alias("port_id"),
        F.lit(30).alias("age"), F.lit("Air").alias("travel_mode"),
        F.lit("Pleasure").alias("visa_category"), F.lit("B2").alias("visa_type"),
        F.lit("F").alias("gender"), F.lit(1980).alias("birth_year"),
        F.lit(None).cast("int").alias("depdate"),
        F.date_add(F.lit("1996-01-01").cast("date"), (F.col("id") % days).cast("int"))
        .alias("load_day"), F.lit(13149).alias("arrdate"))


def test_fact_ids_are_unique(spark):
    ids = [r[0] for r in assign_fact_ids(fact_rows(spark, 5, 400, 11)).select("immigration_id").collect()]
    assert len(set(ids)) == 2000


def test_dense_fact_ids(spark):
    df = assign_fact_ids(fact_rows(spark, 5, 400, 11), start=7, dense=True)
    assert sorted(r[0] for r in df.select("immigration_id").collect()) == list(range(7, 2007))


def test_fact_ids_of_a_day_stay_in_its_range(spark):
    df = fact_rows(spark, 5, 400, 11)
    keyed = assign_fact_ids(df, day_start(F.col("load_day")))
    spans = keyed.groupBy("load_day").agg(
        F.min("immigration_id").alias("lo"), F.max("immigration_id").alias("hi"),
        F.count_distinct("immigration_id").alias("n")).orderBy("load_day").collect()
    assert [s.n for s in spans] == [400] * 5
    for a, b in zip(spans, spans[1:]):
        assert a.hi < b.lo
    # The batches of single days and the batch of all days never share an id.
    assert all(s.lo >> 47 == s.hi >> 47 for s in spans)


def test_fact_ids_before_the_epoch_and_far_ahead(spark):
    df = spark.sql("SELECT DATE '1959-12-31' d UNION ALL SELECT DATE '2139-01-01'")
    starts = [r[0] for r in df.select(day_start(F.col("d"))).collect()]
    assert starts[0] == -(1 << 47) and 0 < starts[1] < 1 << 63


def test_fact_ids_at_any_number_of_tasks(spark):
    """20,000 tasks, more than one class of the split holds."""
    df = fact_rows(spark, 2, 20_000, 20_000)
    keyed = assign_fact_ids(df, day_start(F.col("load_day")))
    found = keyed.agg(F.count("*").alias("n"), F.count_distinct("immigration_id").alias("ids"),
                      F.min("immigration_id").alias("low")).first()
    assert (found.n, found.ids) == (40_000, 40_000) and found.low > 0


def test_ids_within_a_day(spark):
    """Tasks and places at the edges of all classes are apart and fit 47 bits."""
    tasks = [0, 1, 4095, 4096, 65535, 65536, (1 << 20) - 1, 1 << 20, (1 << 24) - 1]
    places = [0, 1, 12345, (1 << 21) - 1]
    rows_ = [(t << 33 | p,) for t in tasks for p in places] + [((1 << 33) - 1,)]
    ids = [r[0] for r in spark.createDataFrame(rows_, "at long").select(
        _within_day(F.col("at"))).collect()]
    assert len(set(ids)) == len(ids) and min(ids) >= 0 and max(ids) < 1 << 47
    for task, place, message in ((1 << 24, 0, "more tasks"), (1 << 20, 1 << 21, "more rows")):
        df = spark.createDataFrame([(task << 33 | place,)], "at long")
        with pytest.raises(Exception, match=message):
            df.select(_within_day(F.col("at"))).collect()
