"""Compatibility figure: right answers counted as a running total per card, as the old aggregate did."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window


def running_right(answers: DataFrame, week: tuple[date, date]) -> DataFrame:
    """Per (user, subject) with a card: the sum, over cards in (day, card_id) order, of the right answers so far.

    Cards without a readable day come first, cards that share a day and an id count as one, and a (user, subject)
    without scored answers gets 0. The figure is a long.
    """
    everyone = answers.select("user_id", "subject").distinct()
    return everyone.join(running_of_scored(answers, week), ["user_id", "subject"], "left").select(
        "user_id", "subject",
        F.coalesce("running_right_num", F.lit(0)).cast("bigint").alias("running_right_num"),
        F.coalesce("week_running_right_num", F.lit(0)).cast("bigint").alias("week_running_right_num"))


def running_of_scored(answers: DataFrame, week: tuple[date, date]) -> DataFrame:
    """The figures of :func:`running_right`, only for (user, subject) with scored answers.

    The answers of a point are cut into years, so a hot point spreads over partitions, and sent once. With n cards in a year
    and c_j right answers on the j-th, a year adds sum(c_j * (n - j + 1)) + n * S, where S are the right answers of earlier
    years; n - j + 1 is the place counted from the last card, which the answers of one card share. So a year needs sums only,
    and years are then combined in order. No such sum exceeds the figure itself, as no answer counts less than nothing.
    """
    group = ["user_id", "subject", "point"]
    stretch = [*group, "year"]
    in_week = F.coalesce(F.col("day").between(*map(F.lit, week)), F.lit(False))
    from_last = Window.partitionBy(*stretch).orderBy(F.col("day").desc(), F.col("card_id").desc())
    placed = (
        answers.where(F.col("point").isNotNull())
        .select(*group, F.year("day").alias("year"), "day", "card_id", "right_num")
        .repartition(*stretch)
        .withColumn("place", F.dense_rank().over(from_last).cast("bigint"))
        .select(*stretch, "right_num", "place", F.when(in_week, F.col("right_num")).alias("week_right_num"),
                F.when(in_week, F.col("place")).alias("week_place"))
    )
    # The week's cards lie together; those after them are taken off their places.
    after = F.coalesce(F.min("week_place") - 1, F.lit(0))
    week_s = F.coalesce(F.sum("week_right_num"), F.lit(0))
    years = placed.groupBy(*stretch).agg(
        F.max("place").alias("n"), F.sum("right_num").alias("s"), F.sum(F.col("right_num") * F.col("place")).alias("q"),
        (F.coalesce(F.max("week_place"), F.lit(0)) - after).alias("week_n"), week_s.alias("week_s"),
        (F.coalesce(F.sum(F.col("week_right_num") * F.col("week_place")), F.lit(0)) - week_s * after).alias("week_q"))
    earlier = Window.partitionBy(*group).orderBy("year").rowsBetween(Window.unboundedPreceding, -1)

    def carried(prefix: str):
        n, s, q = (F.col(prefix + name) for name in ("n", "s", "q"))
        return q + n * F.coalesce(F.sum(s).over(earlier), F.lit(0))

    return (
        years.repartition("user_id", "subject")
        .select("user_id", "subject", carried("").alias("all"), carried("week_").alias("week"))
        .groupBy("user_id", "subject")
        .agg(F.sum("all").alias("running_right_num"), F.sum("week").alias("week_running_right_num")))
