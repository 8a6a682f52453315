"""Lifetime results: subject totals, ranks, days histogram."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from quizlens.operators.ranking import group_ranks, top_rows
from quizlens.settings import Settings

def subject_totals(base: DataFrame, settings: Settings) -> DataFrame:
    """Users, qualified users, answers, time, right answers and undone items per listed subject."""
    return (
        base.where(F.col("subject").isin(*settings.totals_subjects))
        .groupBy("subject")
        .agg(
            F.count(F.lit(1)).alias("user_count"),
            F.count_if(F.col("score") >= settings.qualified_score).alias("qualified_user_count"),
            F.sum("answered_num").alias("question_count"),
            F.sum("answered_time").alias("time_total"),
            F.sum("right_num").alias("right_total"),
            F.lit(0).cast("bigint").alias("undo_total"),  # never raised in the figures this one reproduces
            F.sum("undone_num").alias("undone_total"),
        )
    )


def attach_totals(rows: DataFrame, totals: DataFrame, columns: list[str]) -> DataFrame:
    """Totals of the row's subject; at most one row per listed subject is broadcast."""
    return rows.join(F.broadcast(totals.select("subject", *columns)), "subject", "left")


def total_rank_keys(settings: Settings) -> dict:
    keys = {
        "rank": F.col("sort_score"),
        "rank2": F.col("practice_days"),
        "rank3": F.col("answered_time"),
        "rank4": F.col("answered_num"),
    }
    if settings.with_extra_ranks:
        keys["rank5"] = F.col("score")
    return keys


def total_ranks(base: DataFrame, settings: Settings) -> DataFrame:
    """Ranks within the subject; ``base`` should be materialized."""
    return group_ranks(base, total_rank_keys(settings))


def total_top(base: DataFrame, settings: Settings) -> DataFrame:
    return top_rows(base, F.col("sort_score"), settings.top_k)


def days_histogram(base: DataFrame) -> DataFrame:
    """Rows per number of practice days, over all subjects."""
    return base.groupBy("practice_days").agg(F.count(F.lit(1)).alias("row_num"))


def days_pass_count(rows: DataFrame, base: DataFrame | None = None) -> DataFrame:
    """Adds how many rows of ``base`` (by default ``rows`` themselves) have strictly fewer practice days.

    Only the histogram goes through an unpartitioned window and the broadcast. It has one row per distinct
    number of days, so never more than the calendar has days. Numbers of days that only ``rows`` have enter it as
    zero, and a null number has passed nobody.
    """
    fewer = Window.orderBy("practice_days").rowsBetween(Window.unboundedPreceding, -1)
    counted = days_histogram(rows if base is None else base)
    if base is not None:
        asked = rows.select("practice_days").distinct().withColumn("row_num", F.lit(0).cast("bigint"))
        counted = counted.union(asked).groupBy("practice_days").agg(F.sum("row_num").alias("row_num"))
    passed = counted.where("practice_days IS NOT NULL").select(
        "practice_days", F.coalesce(F.sum("row_num").over(fewer), F.lit(0)).alias("days_pass_count")
    )
    return rows.join(F.broadcast(passed), "practice_days", "left").withColumn(
        "days_pass_count", F.coalesce("days_pass_count", F.lit(0)))
