from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from quizlens.functions import calendar
from quizlens.settings import Settings


@pytest.mark.parametrize("now, monday", [
    (datetime(2001, 7, 29, 12), date(2001, 7, 23)),    # Sunday
    (datetime(2001, 7, 30, 3, 59), date(2001, 7, 23)),  # Monday before four: still last week
    (datetime(2001, 7, 30, 4), date(2001, 7, 30)),
    (datetime(2018, 12, 31, 12), date(2018, 12, 31)),
])
def test_week_bounds(now, monday):
    assert calendar.week_bounds(now)[0] == monday
    assert (calendar.week_bounds(now)[1] - monday).days == 6


def test_week_label_at_year_end(spark):
    assert calendar.week_label(datetime(2018, 12, 31, 12)) == "2019-1"
    df = spark.createDataFrame([(date(2018, 12, 31),), (date(2021, 1, 3),)], "d date")
    assert [r[0] for r in df.select(calendar.iso_week_label(F.col("d"))).collect()] == ["2019-1", "2020-53"]


def test_active_since():
    assert Settings(as_of=datetime(2001, 7, 29, 12)).active_since == date(2001, 6, 29)


def test_features(spark):
    df = spark.createDataFrame([("2001-07-29 05:07:09", "12"), ("2001-07-30 23:00:00", "x1")], "t string, n string")
    df = df.withColumn("ts", F.to_timestamp("t"))
    a, b = calendar.calendar_features(df, "ts", add_days=3, number_text="n").orderBy("t").collect()
    assert (a.day_dashed, a.day_compact, a.day_added) == ("2001-07-29", "20010729", "2001-08-01")
    assert (a.hour, a.minute, a.second, a.hour_padded, a.minute_stripped) == (5, 7, 9, "05", "7")
    assert (a.iso_weekday, a.is_rest_day, a.parsed_number) == (7, True, 12)
    assert (b.iso_weekday, b.is_rest_day, b.parsed_number, b.minute_stripped) == (1, False, None, "0")


def test_formats(spark):
    df = spark.createDataFrame([("0",), ("05",), ("00",), ("12",)], "x string")
    assert [r[0] for r in df.select(calendar.strip_zero(F.col("x"))).collect()] == ["0", "5", "0", "12"]
    row = spark.range(1).select(calendar.compact_from_dashed(F.lit("2001-02-03")),
                                calendar.dashed_from_compact(F.lit("20010203"))).first()
    assert tuple(row) == ("20010203", "2001-02-03")
