import datetime as dt

import pytest
from pyspark.sql import functions as F

from ledgerloom.functions import blank, coerce, dates
from ledgerloom.sources import calendar


def values(spark, column, inputs, dtype="string"):
    df = spark.createDataFrame([(i, x) for i, x in enumerate(inputs)], f"i int, x {dtype}")
    return [r.y for r in df.select("i", column(F.col("x")).alias("y")).orderBy("i").collect()]


def test_flags(spark):
    texts = ["true", "True", "TRUE", "1", "false", "False", "", None]
    assert values(spark, coerce.to_flag, texts) == [True, True] + [False] * 6


def test_floats(spark):
    texts = [" 3 ", "1e3", "-.5", "7.", "1,200.5", "$5", "", "nan", "1.0d", "0x1F", None, "inf", "-Infinity"]
    assert values(spark, coerce.to_float, texts) == [
        3.0, 1000.0, -0.5, 7.0, None, None, None, None, None, None, None,
        float("inf"), float("-inf")]


def test_decimals_are_exact_and_bounded(spark):
    texts = ["100.50", "0.1", "1e2", "12345678901234567890", "x"]
    got = values(spark, lambda c: coerce.to_decimal(c, "decimal(18,2)").cast("string"), texts)
    assert got == ["100.50", "0.10", "100.00", None, None]


def test_integers(spark):
    texts = ["7", "7.0", "7.5", "7e2", " 8 ", "99999999999999999999", "x", None, "5.0000001", "1e-7", "9007199254740993"]
    assert values(spark, coerce.to_int, texts) == [7, 7, None, 700, 8, None, None, None, None, None, 9007199254740993]


def test_dates_and_datetimes(spark):
    texts = ["2024-01-05", "2024-02-30", "2024", "2024-1-5", "", None]
    assert values(spark, coerce.to_date, texts) == [dt.date(2024, 1, 5)] + [None] * 5
    iso = ["2024-01-05T00:00:00", "2024-01-05 23:59:59.5", "2024-01-05T22:00:00-08:00", "2024-01-05T10:30Z", "2024-01-05T25:00:00"]
    assert values(spark, coerce.to_date, iso) == [dt.date(2024, 1, 5)] * 4 + [None]
    assert values(spark, coerce.to_datetime, iso[2:4]) == [dt.datetime(2024, 1, 5, 22), dt.datetime(2024, 1, 5, 10, 30)]
    stamps = ["2024-01-05T10:30:00", "2024-01-05 10:30:00", "2024-01-05", "2024-01-05T25:00:00", "x"]
    assert values(spark, coerce.to_datetime, stamps) == [
        dt.datetime(2024, 1, 5, 10, 30), dt.datetime(2024, 1, 5, 10, 30),
        dt.datetime(2024, 1, 5), None, None]


def test_date_key(spark):
    got = values(spark, lambda c: dates.date_key(coerce.to_date(c)), ["2024-01-05", "2024-02-30", None])
    assert got == [20240105, None, None]


def test_blank_arithmetic(spark):
    df = spark.createDataFrame(
        [(1.0, 2.0), (None, 2.0), (1.0, None), (None, None), (1.0, 0.0)], "a double, b double")
    a, b = F.col("a"), F.col("b")
    rows = df.select(
        blank.blank_add(a, b).alias("add"), blank.blank_sub(a, b).alias("sub"),
        blank.divide(a, b).alias("div"), blank.divide(a, b, 0).alias("div0"),
        blank.change(a, b).alias("change")).collect()
    assert [r.add for r in rows] == [3.0, 2.0, 1.0, None, 1.0]
    assert [r["sub"] for r in rows] == [-1.0, -2.0, 1.0, None, 1.0]
    assert [r["div"] for r in rows] == [0.5, None, None, None, None]
    assert [r.div0 for r in rows] == [0.5, None, 0.0, 0.0, 0.0]
    assert [r.change for r in rows] == [-0.5, -1.0, None, None, None]


def test_distinct_counts_null_as_a_value(spark):
    df = spark.createDataFrame([("a",), ("a",), ("b",), (None,), (None,)], "x string")
    assert df.agg(blank.distinct_with_null(F.col("x")).alias("n")).first().n == 3


@pytest.mark.parametrize("day, in_year", [(dt.date(2024, 1, 1), 0), (dt.date(2024, 3, 1), 60)])
def test_days_into_year(spark, day, in_year):
    assert spark.range(1).select(dates.days_into_year(day).alias("n")).first().n == in_year


def test_calendar_matches_python(spark):
    days = calendar.dim_date(spark).collect()
    assert len(days) == 4018
    for row in days:
        day = row.full_date
        assert row.week_of_year == int(day.strftime("%W"))
        assert row.day_of_week == int(day.strftime("%w"))
        assert row.day_name == day.strftime("%A") and row.month_short == day.strftime("%b")
        assert row.day_of_year == int(day.strftime("%j"))
        assert row.date_key == int(day.strftime("%Y%m%d"))
        assert row.is_weekend == (day.weekday() >= 5) and row.is_holiday is False
