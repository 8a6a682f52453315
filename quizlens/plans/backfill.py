"""Week results of many weeks in one pass: the week is part of the grouping key, not a flag per week."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from quizlens.functions.rules import rule_table
from quizlens.functions.score_text import point_text
from quizlens.operators.ranking import group_ranks
from quizlens.plans.base import WEEK, score, score_sums
from quizlens.plans.week import week_rank_keys, week_rows
from quizlens.settings import Settings


def weeks_rows(rows: DataFrame, moments: Sequence[datetime], settings: Settings, *, with_text: bool = False) -> DataFrame:
    """``week_rows`` as of each of ``moments``, one per week, with the column ``week`` (its label).

    ``rows`` are answers or stored sums. They are summed up once, per (user, subject, point, week), with all weeks that are
    not asked for as one, and placed by user. Lifetime figures, which have no upper bound, and the last day of a user are
    windows of that small result, so nothing is joined but the weeks: Monday, label and activity bound, a few rows.
    """
    spark = rows.sparkSession
    runs = [settings.with_(as_of=m) for m in moments]
    weeks = [(s.week[0], s.week_label, s.active_since) for s in runs]
    if len({monday for monday, *_ in weeks}) < len(weeks):
        raise ValueError("two moments of one week")
    if not weeks:
        raise ValueError("no week asked for")
    plan = F.broadcast(spark.createDataFrame(weeks, "monday date, week string, active_since date"))
    monday = F.date_trunc("week", F.col("day")).cast("date")
    monday = F.when(monday.isin([F.lit(m) for m, *_ in weeks]), monday)
    measures = sorted({*WEEK.values(), "answered_time"})
    summed = (
        rows.withColumn("monday", monday).groupBy("user_id", "subject", "point", "monday")
        .agg(*[F.sum(m).alias(m) for m in measures], F.max("day").alias("last_day"))
        .repartition("user_id").groupBy("user_id", "subject", "point", "monday")
        .agg(*[F.sum(m).alias(m) for m in measures], F.max("last_day").alias("last_day")))
    group, user = Window.partitionBy("user_id", "subject"), Window.partitionBy("user_id")
    summed = summed.withColumns({
        "lifetime_num": F.sum("answered_num").over(group), "lifetime_time": F.sum("answered_time").over(group),
        "user_last_day": F.max("last_day").over(user)})

    week = WEEK | ({"week_time": "answered_time"} if settings.week_time_answered_only else {})
    points = summed.where(F.col("monday").isNotNull()).select(
        "user_id", "subject", "point", "monday", "lifetime_num", "lifetime_time", "user_last_day",
        *[F.col(m).alias(name) for name, m in week.items()])
    texts = [point_text(F.col("point"), *map(F.col, ("week_right_num", "week_total_num", "week_time_sum"))).alias(
        "week_point_stats")] if with_text else []
    rules = F.broadcast(rule_table(spark, settings.fix_denominators))
    sums = ["week_right_num", "week_answered_num", "week_time", "week_undone_num"]
    scored = (
        points.join(rules, ["subject", "point"], "left").groupBy("user_id", "subject", "monday")
        .agg(*[F.sum(c).alias(c) for c in sums], *score_sums("week_"), *texts, F.max("lifetime_num").alias("answered_num"),
             F.max("lifetime_time").alias("answered_time"), F.max("user_last_day").alias("user_last_day"))
        .selectExpr("user_id", "subject", "monday", *sums, "answered_num", "answered_time", "user_last_day", *(["week_point_stats"] if with_text else []),
                    f"{score('week_', None, settings.fix_denominators)} AS week_score"))
    base = scored.join(plan, "monday").where(
        F.col("active_since").isNull() | (F.col("user_last_day") >= F.col("active_since")))
    if settings.min_answered > 0:
        base = base.where(F.col("answered_num") >= settings.min_answered)
    if not settings.week_needs_answers:
        raise ValueError("a backfill holds the users with cards in a week; rows without any are not made")
    return week_rows(base, settings, "week")


def weeks_ranks(weeks: DataFrame, settings: Settings) -> DataFrame:
    """Ranks within week and subject; ``weeks`` should be materialized."""
    race = weeks.withColumn("race", F.concat_ws("/", "week", "subject"))
    return group_ranks(race, week_rank_keys(settings), group="race").drop("race")
