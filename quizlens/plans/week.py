"""Results of the reporting week."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quizlens.operators.ranking import group_ranks, top_rows
from quizlens.plans.base import SCORE_DECIMALS
from quizlens.settings import Settings

def _ratio(above: str, below: str) -> Column:
    return F.round(F.try_divide(F.col(above), F.col(below)), SCORE_DECIMALS)


def week_rows(base: DataFrame, settings: Settings, *further: str) -> DataFrame:
    """Week figures per (user, subject). Speed is seconds per question; null when nothing was answered. ``further`` columns
    are kept."""
    rows = base.where(F.col("week_answered_num") > 0) if settings.week_needs_answers else base
    slow_enough = F.try_divide(F.col("answered_time"), F.col("answered_num")) >= settings.week_min_seconds
    competes = (F.col("answered_num") >= settings.week_min_answered) & slow_enough
    sort_score = F.col("week_score") if settings.sort_by_raw_score else (
        F.when(competes, F.col("week_score")).otherwise(F.lit(0.0)))
    texts = ["week_point_stats"] if "week_point_stats" in base.columns else []
    return rows.select(
        "user_id", "subject", *further, "week_score", *texts, "week_answered_num", "week_time", "week_right_num",
        _ratio("week_time", "week_answered_num").alias("week_speed"),
        _ratio("week_right_num", "week_answered_num").alias("week_accuracy"),
        F.lit(0).cast("bigint").alias("week_undo_num"),
        "week_undone_num",
        sort_score.alias("week_sort_score"),
    )


def week_subject_totals(week: DataFrame, settings: Settings) -> DataFrame:
    return (
        week.where(F.col("subject").isin(*settings.totals_subjects))
        .groupBy("subject")
        .agg(
            F.count(F.lit(1)).alias("user_count"),
            F.sum("week_answered_num").alias("question_count"),
            F.sum("week_time").alias("time_total"),
            F.sum("week_right_num").alias("right_total"),
            F.lit(0).cast("bigint").alias("undo_total"),
            F.sum("week_undone_num").alias("undone_total"),
        )
    )


def week_rank_keys(settings: Settings) -> dict:
    speed = F.col("week_speed")
    keys = {
        "rank": F.col("week_sort_score"),
        "rank2": F.col("week_answered_num"),
        "rank3": -speed if settings.speed_ascending else speed,
        "rank4": F.col("week_accuracy"),
    }
    if settings.with_extra_ranks:
        keys["rank5"] = F.col("week_score")
    return keys


def week_ranks(week: DataFrame, settings: Settings) -> DataFrame:
    """Ranks within the subject; ``week`` should be materialized."""
    return group_ranks(week, week_rank_keys(settings))


def week_top(week: DataFrame, settings: Settings) -> DataFrame:
    return top_rows(week, F.col("week_sort_score"), settings.top_k)
