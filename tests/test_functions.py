import datetime
import math

from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from landfall.functions import codes, days

EPOCH = datetime.date(1960, 1, 1)


def one(spark, column, value, dtype="double"):
    return spark.createDataFrame([(value,)], f"v {dtype}").select(column(F.col("v"))).first()[0]


def test_day_numbers_round_down(spark):
    values = [0.0, 20454.0, -0.5, -1.0, 0.99, 12.5, None, float("nan")]
    df = spark.createDataFrame([(v,) for v in values], "v double")
    got = [r[0] for r in df.select(days.sas_date(F.col("v"))).collect()]
    assert got == [
        EPOCH, datetime.date(2016, 1, 1), datetime.date(1959, 12, 31),
        datetime.date(1959, 12, 31), EPOCH, datetime.date(1960, 1, 13), None, None]


@settings(max_examples=5, deadline=None)
@given(st.lists(st.floats(-20000, 60000), min_size=50, max_size=50))
def test_day_numbers_equal_calendar_arithmetic(spark, numbers):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(numbers)], "i int, v double")
    got = df.select("i", days.sas_date(F.col("v")).alias("d"),
                    days.sas_day_of_month(F.col("v")).alias("m")).orderBy("i").collect()
    want = [EPOCH + datetime.timedelta(days=math.floor(v)) for v in numbers]
    assert [r.d for r in got] == want
    assert [r.m for r in got] == [d.day for d in want]


def test_day_number_inverts_sas_date(spark):
    assert one(spark, lambda c: days.day_number(days.sas_date(c)), 13484.0) == 13484


def test_modes_and_visas(spark):
    df = spark.createDataFrame([(v,) for v in (1.0, 2.0, 3.0, 9.0, None)], "v double")
    got = df.select(codes.decode_mode(F.col("v")), codes.decode_visa(F.col("v"))).collect()
    assert [tuple(r) for r in got] == [
        ("Air", "Business"), ("Sea", "Pleasure"), ("Land", "Student"),
        ("Not Reported", "Not Reported"), ("Not Reported", "Not Reported")]


def test_codes_have_no_padding(spark):
    assert one(spark, codes.code_text, 54.0) == "54"
    assert one(spark, codes.code_text, 0.0) == "0"


def test_values_that_do_not_fit_become_null(spark):
    assert one(spark, codes.whole, "x", "string") is None
    assert one(spark, codes.whole, 1e12) is None
    assert one(spark, codes.whole, float("nan")) is None
    assert one(spark, codes.whole, -1.9) == -1


def test_calendar_parts(spark):
    def parts(day):
        df = spark.createDataFrame([(day,)], "d date")
        return df.select(*[c.alias(n) for n, c in days.calendar_parts(F.col("d")).items()]
                         ).first().asDict()

    # ISO week 53 of the year before; a Friday.
    assert parts(datetime.date(2016, 1, 1)) == {
        "year": 2016, "month": 1, "day": 1, "week": 53, "day_of_week": 5, "quarter": 1}
    assert parts(datetime.date(2016, 1, 3))["day_of_week"] == 0
    assert parts(datetime.date(2016, 1, 2))["day_of_week"] == 6
    assert parts(datetime.date(2016, 12, 31))["quarter"] == 4


def test_date_of_parts_is_null_for_no_real_day(spark):
    df = spark.createDataFrame(
        [(2016, 2, 29), (2015, 2, 29), (2016, 13, 1), (2016, 4, 31), (2016, 1, 0),
         (2000000000, 1, 1), (2016, 1, None), (None, 1, 1)], "y int, m int, d int")
    got = [r[0] for r in df.select(
        days.date_of_parts(F.col("y"), F.col("m"), F.col("d"))).collect()]
    assert got == [datetime.date(2016, 2, 29)] + [None] * 7


def test_same_text_ignores_case_but_not_spaces(spark):
    df = spark.createDataFrame(
        [("New  York", "NEW  YORK"), ("New York", "NEW  YORK")], "a string, b string")
    got = [r[0] for r in df.select(codes.same_text(F.col("a"), F.col("b"))).collect()]
    assert got == [True, False]
