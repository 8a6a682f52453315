"""Week bounds, week labels and calendar columns."""

from __future__ import annotations

from datetime import date, datetime, time, timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

DAY_START = timedelta(hours=4)  # a reporting day starts at 04:00


def week_bounds(as_of: datetime) -> tuple[date, date]:
    """Monday and Sunday (both included) of the reporting week."""
    today = (as_of - DAY_START).date()
    monday = today - timedelta(days=today.weekday())
    return monday, monday + timedelta(days=6)


def week_label(as_of: datetime) -> str:
    """ISO ``year-week``, so the last days of December may belong to week 1 of the next year."""
    year, week, _ = (as_of - DAY_START).date().isocalendar()
    return f"{year}-{week}"


def label_bounds(label: str) -> tuple[date, date]:
    """Monday and Sunday of a ``year-week`` label, the inverse of :func:`week_label`."""
    year, _, week = label.partition("-")
    monday = date.fromisocalendar(int(year), int(week), 1)
    return monday, monday + timedelta(days=6)


def moment_of(label: str) -> datetime:
    """Sunday noon of a labelled week: a moment whose reporting week it is."""
    return datetime.combine(label_bounds(label)[1], time(12))


def label_monday(label: Column) -> Column:
    """Monday of ISO ``year-week`` labels; null for other text and for weeks a year does not have."""
    year = F.regexp_extract(label, "^([0-9]{1,4})-[0-9]{1,2}$", 1).try_cast("int")
    week = F.regexp_extract(label, "^[0-9]{1,4}-([0-9]{1,2})$", 1).try_cast("int")
    fourth = F.try_to_date(F.format_string("%04d-01-04", year), "yyyy-MM-dd")      # always in the first week
    monday = F.date_add(F.date_sub(fourth, F.weekday(fourth)), 7 * (week - 1))
    return F.when((week >= 1) & (F.extract(F.lit("YEAROFWEEK"), monday) == year), monday)


def iso_week_label(day: Column) -> Column:
    return F.concat_ws("-", F.extract(F.lit("YEAROFWEEK"), day).cast("string"), F.weekofyear(day).cast("string"))


def parse_day(value: Column, data_type: str) -> Column:
    """Card dates come as yyyyMMdd text, as epoch milliseconds, or already as dates."""
    if data_type == "string":
        return F.try_to_date(value, "yyyyMMdd")
    if data_type in ("int", "bigint"):
        return F.to_date(F.timestamp_millis(value.cast("bigint")))
    return value.cast("date")


def pad_two(value: Column) -> Column:
    """At least two digits; longer numbers stay whole."""
    text = value.cast("string")
    return F.when(F.length(text) < 2, F.lpad(text, 2, "0")).otherwise(text)


def strip_zero(text: Column) -> Column:
    """Drop one leading zero, but keep a lone 0."""
    return F.when((text != "0") & text.startswith("0"), text.substr(F.lit(2), F.length(text))).otherwise(text)


def calendar_features(df: DataFrame, ts: str, add_days: int = 1, number_text: str | None = None) -> DataFrame:
    """Adds day formats, clock parts, ISO weekday, rest-day flag and week label of ``ts``."""
    stamp = F.col(ts)
    day = F.to_date(stamp)
    weekday = F.weekday(day) + 1
    out = df.withColumns({
        "day_dashed": F.date_format(day, "yyyy-MM-dd"),
        "day_compact": F.date_format(day, "yyyyMMdd"),
        "day_added": F.date_format(F.date_add(day, add_days), "yyyy-MM-dd"),
        "hour": F.hour(stamp),
        "minute": F.minute(stamp),
        "second": F.second(stamp).cast("int"),
        "hour_padded": pad_two(F.hour(stamp)),
        "minute_stripped": strip_zero(pad_two(F.minute(stamp))),
        "iso_weekday": weekday,
        "is_rest_day": weekday >= 6,
        "week_label": iso_week_label(day),
    })
    if number_text is not None:
        out = out.withColumn("parsed_number", F.col(number_text).try_cast("bigint"))
    return out


def compact_from_dashed(text: Column) -> Column:
    """yyyy-MM-dd to yyyyMMdd."""
    return F.date_format(F.to_date(text, "yyyy-MM-dd"), "yyyyMMdd")


def dashed_from_compact(text: Column) -> Column:
    """yyyyMMdd to yyyy-MM-dd."""
    return F.date_format(F.to_date(text, "yyyyMMdd"), "yyyy-MM-dd")
