"""From cards to answers, and from answers to a roll-up per day that can be stored and added to."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

ANSWERED = (1, 2)  # 1 right, 2 wrong, anything else not answered

MEASURES = ("right_num", "total_num", "time_sum", "answered_num", "answered_time", "all_time", "undone_num",
            "card_num")
ROLLUP_KEYS = ("user_id", "subject", "day", "point")


def explode_answers(cards: DataFrame) -> DataFrame:
    """One row per array position, plus one row per card, each with the measures it adds.

    Arrays of unequal length end where the shortest array a measure needs ends. ``point`` is set only on
    answers that count for point statistics; everything else, the card row included, has a null point.
    So every (user, subject, day) with a card has null-point rows, and grouping those by day counts practice
    days without a distinct aggregate.
    """
    keep = [c for c in ("card_id", "user_id", "subject", "day") if c in cards.columns]
    return (
        cards.selectExpr(
            *keep, "explode(array_append(arrays_zip(point, correct, answer_time, question), NULL)) AS a")
        .selectExpr(
            *keep, "a IS NULL AS is_card", "a.point", "a.question", "a.correct", "a.answer_time",
            f"coalesce(a.correct IN {ANSWERED}, false) AS answered",
            "coalesce(CAST(a.answer_time AS BIGINT), 0L) AS seconds")
        .selectExpr(
            "*", "answered AND answer_time IS NOT NULL AND coalesce(point <> 0, false) AS on_point")
        .selectExpr(
            *keep,
            "IF(on_point, point, NULL) AS point",
            "CAST(on_point AND correct = 1 AS BIGINT) AS right_num",
            "CAST(on_point AS BIGINT) AS total_num",
            "IF(on_point, seconds, 0L) AS time_sum",
            "CAST(answered AND question IS NOT NULL AS BIGINT) AS answered_num",
            "IF(answered, seconds, 0L) AS answered_time",
            "seconds AS all_time",
            "CAST(correct IS NOT NULL AND NOT answered AS BIGINT) AS undone_num",
            "CAST(is_card AS BIGINT) AS card_num")
    )


def narrowed(cards: DataFrame) -> DataFrame:
    """Cards with the same answers in less room, for a shuffle: a question is only there or not, and ``correct`` 1, 2 or 0."""
    answered = ", ".join(map(str, ANSWERED))
    return cards.withColumns({
        "question": F.expr("transform(question, q -> IF(q IS NULL, NULL, 1Y))"),
        "correct": F.expr(f"transform(correct, c -> IF(c IS NULL OR c IN ({answered}), CAST(c AS TINYINT), 0Y))")})


def daily_rollup(answers: DataFrame) -> DataFrame:
    """Sums per (user, subject, day, point). Partial sums in the map stage absorb hot users."""
    return answers.groupBy(*ROLLUP_KEYS).agg(*[F.sum(m).alias(m) for m in MEASURES])


def merge_rollups(*rollups: DataFrame) -> DataFrame:
    """Combine stored roll-ups, for example yesterday's table and the new day."""
    merged = rollups[0]
    for other in rollups[1:]:
        merged = merged.unionByName(other)
    return daily_rollup(merged)


def point_stats(answers_or_rollup: DataFrame) -> DataFrame:
    """Right, total and time per (user, subject, point)."""
    return (
        answers_or_rollup.where(F.col("point").isNotNull())
        .groupBy("user_id", "subject", "point")
        .agg(F.sum("right_num").alias("right_num"), F.sum("total_num").alias("total_num"),
             F.sum("time_sum").alias("time_sum"))
    )


def row_count(df: DataFrame, *keys: str, alias: str = "row_num") -> DataFrame:
    """Rows per key, nulls counted too; a long, so it does not overflow at two billion rows."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias(alias))
