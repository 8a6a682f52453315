"""Answer cards: one row per practice session, parallel arrays with one element per question."""

from __future__ import annotations

from datetime import date, datetime, time, timedelta
from zoneinfo import ZoneInfo

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quizlens.functions.calendar import parse_day

ARRAYS = {"question": "question", "correct": "correct", "answerTime": "answer_time", "point": "point"}

UNKNOWN_USER = -1


def read_cards(
    spark: SparkSession,
    source: str,
    *,
    day_from: date | None = None,
    day_to: date | None = None,
    card_id: str | None = None,
    null_mode: str = "empty",
) -> DataFrame:
    """Read a catalog table or a parquet path and bring it into the engine's column names.

    Day bounds are compared with the stored ``createTime``, so they reach the scan.
    """
    raw = spark.read.parquet(source) if "/" in source else spark.table(source)
    return normalise_cards(between_days(raw, day_from, day_to), card_id=card_id, null_mode=null_mode)


def between_days(raw: DataFrame, day_from: date | None, day_to: date | None) -> DataFrame:
    """Bound the stored column itself, from the start of the first day to before the day after the last.

    Text is yyyyMMdd, numbers are epoch milliseconds in the session's time zone, dates and timestamps are typed. The
    column is never wrapped, so the bounds reach the scan. A bound leaves out cards without a readable day, text that sorts
    inside it included.
    """
    stored = raw.schema["createTime"].dataType.simpleString()
    zone = ZoneInfo(raw.sparkSession.conf.get("spark.sql.session.timeZone"))

    def start_of(day: date) -> Column:
        if stored == "string":
            return F.lit(day.strftime("%Y%m%d"))
        if stored in ("int", "bigint"):
            return F.lit(int(datetime.combine(day, time(), zone).timestamp() * 1000)).cast("bigint")
        return F.lit(day).cast(stored)      # date, or the start of the day as either kind of timestamp

    if day_from is not None:
        raw = raw.where(F.col("createTime") >= start_of(day_from))
    if day_to is not None:
        raw = raw.where(F.col("createTime") < start_of(day_to + timedelta(days=1)))
    if stored == "string" and (day_from is not None or day_to is not None):
        raw = raw.where(parse_day(F.col("createTime"), stored).isNotNull())
    return raw


def normalise_cards(raw: DataFrame, *, card_id: str | None = None, null_mode: str = "empty") -> DataFrame:
    """Columns: card_id (if named), user_id, subject, day, question, correct, answer_time, point.

    ``null_mode='empty'`` reads a null array as empty, a null user as -1 and a null subject as 0, and keeps
    an unreadable date as null; ``'fail'`` raises on any of them.
    """
    if null_mode not in ("empty", "fail"):
        raise ValueError("null_mode must be 'empty' or 'fail'")

    def checked(value: Column, what: str, fallback: Column) -> Column:
        if null_mode == "fail":
            return F.when(value.isNull(), F.raise_error(F.lit(f"answer card without {what}"))).otherwise(value)
        return F.coalesce(value, fallback)

    stored = raw.schema["createTime"].dataType.simpleString()
    day = checked(parse_day(F.col("createTime"), stored), "a readable createTime", F.lit(None).cast("date"))
    columns = [
        checked(F.col("userId").cast("bigint"), "a user", F.lit(UNKNOWN_USER).cast("bigint")).alias("user_id"),
        checked(F.col("subject").cast("int"), "a subject", F.lit(0)).alias("subject"),
        day.alias("day"),
    ]
    if card_id is not None:
        columns.insert(0, F.col(card_id).alias("card_id"))
    for name, alias in ARRAYS.items():
        columns.append(checked(F.col(name), name, F.array().cast("array<int>")).alias(alias))
    return raw.select(*columns)


def cards_volume(cards: DataFrame) -> DataFrame:
    """Card count per day."""
    return cards.groupBy("day").agg(F.count(F.lit(1)).alias("card_num"))


def cards_on_day(
    cards: DataFrame, day_from: date, day_to: date | None = None,
    user_id: int | None = None, subject: int | None = None,
) -> DataFrame:
    """Cards of one day or a day range, optionally of one user and subject."""
    out = cards.where(F.col("day").between(F.lit(day_from), F.lit(day_to or day_from)))
    if user_id is not None:
        out = out.where(F.col("user_id") == user_id)
    if subject is not None:
        out = out.where(F.col("subject") == subject)
    return out
