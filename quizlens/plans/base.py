"""The (user, subject) base: lifetime and week figures and scores, from one pass over the cards."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from quizlens.functions.rules import WEIGHTED_POINTS, full_denominator, rule_table
from quizlens.functions.score_text import point_text
from quizlens.operators.answers import explode_answers
from quizlens.operators.bloom import key_filter, might_hold
from quizlens.operators.running import running_of_scored
from quizlens.settings import Settings

SCORE_DECIMALS = 6  # sums of doubles depend on order; ranks need a value that does not

LIFETIME = ("right_num", "total_num", "time_sum", "answered_num", "answered_time", "undone_num")
WEEK = {"week_right_num": "right_num", "week_total_num": "total_num", "week_time_sum": "time_sum",
        "week_answered_num": "answered_num", "week_time": "all_time", "week_undone_num": "undone_num"}


def collapse(rows: DataFrame, settings: Settings) -> DataFrame:
    """Answers or a stored roll-up, brought to one row per (user, subject, point) and one per practice day.

    Point rows give up their day, with the week kept as separate sums; only the null-point rows keep it, so
    that counting them counts days. What is left per user is bounded by points plus days.
    """
    monday, sunday = settings.week
    in_week = f"day BETWEEN DATE '{monday}' AND DATE '{sunday}'"
    week = WEEK | ({"week_time": "answered_time"} if settings.week_time_answered_only else {})
    practice_day = F.expr("IF(point IS NULL, day, NULL) AS practice_day")
    return rows.groupBy("user_id", "subject", "point", practice_day).agg(
        *[F.expr(f"sum({m}) AS {m}") for m in LIFETIME],
        *[F.expr(f"sum(IF({in_week}, {m}, 0L)) AS {name}") for name, m in week.items()],
        F.expr("max(day) AS last_day"),
    )


def score_sums(prefix: str) -> list[Column]:
    """What a score needs, per (user, subject), from point rows joined with the rules."""
    right, total = f"{prefix}right_num", f"{prefix}total_num"
    return [
        F.expr(f"coalesce(sum({right} * w_right), 0L) AS {prefix}hits"),
        F.expr(f"coalesce(sum({total} * w_total), 0L) AS {prefix}tries"),
        F.expr(f"coalesce(sum(IF({total} > 0, w_total, NULL)), 0L) AS {prefix}seen"),
        F.expr(f"coalesce(sum(share * try_divide({right}, {total})), 0D) AS {prefix}shares"),
    ]


def score(prefix: str, gate: int | None, fix_denominators: bool = False) -> str:
    """SQL for the score of a (user, subject) in percent.

    A scored point never answered counts as one try, in the denominator and in the gate. So the denominator
    is the tries made plus the weights of the points not seen, and needs no row per missing point.
    """
    whole = full_denominator("subject", fix_denominators)
    tries = f"({prefix}tries + {whole} - {prefix}seen)"
    weighted = ", ".join(map(str, WEIGHTED_POINTS))
    passed = f"{whole} IS NOT NULL" if gate is None else f"{tries} >= {gate}"
    return f"""IF({passed}, round(
        100 * IF(subject IN ({weighted}), {prefix}shares, try_divide({prefix}hits, {tries})), {SCORE_DECIMALS}), 0D)"""


def user_subject_base(rows: DataFrame, settings: Settings, *, with_text: bool = False) -> DataFrame:
    """One row per (user, subject) with statistics and scores, active users only if the settings ask.

    ``rows`` are answers, a roll-up, or both together. The first aggregate absorbs hot users by partial sums; its small
    result is placed by user once, and all later steps, the activity test included, keep that partitioning.
    Days are folded into their null-point row, and inactive users left out, before scores and texts are put together.
    """
    fix_denominators = settings.fix_denominators
    rules = F.broadcast(rule_table(rows.sparkSession, fix_denominators))
    sums = ["right_num", "answered_num", "answered_time", "undone_num", "practice_days",
            "week_right_num", "week_answered_num", "week_time", "week_undone_num"]
    texts = []
    if with_text:
        texts = [
            point_text(F.col("point"), *map(F.col, ("right_num", "total_num", "time_sum"))).alias("point_stats"),
            point_text(F.col("point"), *map(F.col, ("week_right_num", "week_total_num", "week_time_sum")))
            .alias("week_point_stats"),
        ]
    folded = (
        collapse(rows, settings).repartition("user_id")
        .groupBy("user_id", "subject", "point")
        .agg(*[F.expr(f"sum({m}) AS {m}") for m in (*LIFETIME, *WEEK)],
             F.expr("count(practice_day) AS practice_days"), F.expr("max(last_day) AS last_day"))
    )
    base = (
        keep_active(folded, settings)
        .join(rules, ["subject", "point"], "left")
        .groupBy("user_id", "subject")
        .agg(*[F.expr(f"sum({c}) AS {c}") for c in sums], *score_sums(""), *score_sums("week_"), *texts)
        .selectExpr("user_id", "subject", *sums,
                    f"{score('', settings.score_gate, fix_denominators)} AS score",
                    f"{score('week_', None, fix_denominators)} AS week_score",
                    *(["point_stats", "week_point_stats"] if with_text else []))
    )
    base = base.withColumn(
        "sort_score",
        F.col("score") if settings.sort_by_raw_score
        else F.when(F.col("score") >= settings.qualified_score, F.col("score")).otherwise(F.lit(0.0)),
    )
    if settings.min_answered > 0:
        base = base.where(F.col("answered_num") >= settings.min_answered)
    return base


def keep_active(base: DataFrame, settings: Settings) -> DataFrame:
    """Rows of users with a card since the activity bound, in any subject.

    The rows already lie by user, so the user's last day is a window without a shuffle; no second scan of
    the cards and no join.
    """
    if settings.active_since is None:
        return base.drop("last_day")
    last = F.max("last_day").over(Window.partitionBy("user_id"))
    return (
        base.withColumn("user_last_day", last)
        .where(F.col("user_last_day") >= F.lit(settings.active_since))
        .drop("user_last_day", "last_day")
    )


def base_from_cards(cards: DataFrame, settings: Settings, *, recent: DataFrame | None = None, **options) -> DataFrame:
    """The base of all cards. With ``running_right`` the cards need a ``card_id``, and right answers, of the week too,
    are the running figure.

    ``recent``, a scan of the cards since the activity bound, makes a filter of its users that the history passes before it
    is exploded and summed up; the exact activity test follows as ever, so the result is the same.
    """
    if recent is not None and settings.active_since is not None:
        cards = cards.where(might_hold(key_filter(active_users(recent, settings), "user_id"), "user_id"))
    answers = explode_answers(cards)
    base = user_subject_base(answers, settings, **options)
    return with_running_right(base, answers, settings) if settings.running_right else base


def with_running_right(base: DataFrame, answers: DataFrame, settings: Settings) -> DataFrame:
    return replace_right(base, running_of_scored(answers, settings.week))


def replace_right(base: DataFrame, running: DataFrame) -> DataFrame:
    """Right answers, of the week too, by the running figure of each (user, subject), 0 where there is none."""
    return base.join(running, ["user_id", "subject"], "left").select(*[
        F.coalesce(f"running_{c}" if c == "right_num" else "week_running_right_num", F.lit(0)).alias(c)
        if c in ("right_num", "week_right_num") else c for c in base.columns])


def active_users(cards: DataFrame, settings: Settings) -> DataFrame:
    """Distinct users with a card since the activity bound; later cards count too."""
    recent = cards if settings.active_since is None else cards.where(F.col("day") >= F.lit(settings.active_since))
    return recent.select("user_id").distinct()


def semi_join_users(rows: DataFrame, users: DataFrame) -> DataFrame:
    """Rows of the users in a given table, for activity lists that come from elsewhere."""
    return rows.join(users.select("user_id"), "user_id", "left_semi")
