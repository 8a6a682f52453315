"""The running figure as a state that can be stored: prefix sums per day that later loads are merged into.

Of n cards in order with right answers c_1..c_n, let s be their sum and q the sum of all their prefix sums. Two stretches, one
wholly before the other, merge into (n1 + n2, s1 + s2, q1 + q2 + n2 * s1): the cards of the later one carry on from s1. So a
day is one row per (user, subject, point), a week or a lifetime is a fold over its days, and a new day changes no older row.

Loads may hold cards of the same day. Their rows merge by the same rule where one load's cards come before the other's.
Where card ids interleave, or a card was split between loads, the day is counted anew from its scored cards, and only it.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from quizlens.operators.answers import MEASURES, ROLLUP_KEYS
from quizlens.operators.bloom import key_filter, might_hold
from quizlens.operators.materialize import materialize

POINT = ("user_id", "subject", "point")
DAY = (*POINT, "day")
WIDE = "decimal(38,0)"


def scored_cards(answers: DataFrame) -> DataFrame:
    """Right answers per (user, subject, point, day, card), of answers that count for point statistics; not added up yet."""
    return answers.where(F.col("point").isNotNull()).select(*DAY, "card_id", "right_num")


def _carried(n: Column, s: Column, q: Column, order: Window) -> Column:
    """What a stretch adds behind all earlier ones of its window."""
    before = F.coalesce(F.sum(s).over(order), F.lit(0)).cast("decimal(19,0)")
    return (q + (n.cast("decimal(18,0)") * before).cast(WIDE)).cast(WIDE)


def _earlier(keys: tuple[str, ...], *order: str) -> Window:
    return Window.partitionBy(*keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)


def daily_rollup_with_states(answers: DataFrame) -> DataFrame:
    """The sums of ``daily_rollup`` and, on rows with a point, the day state of their cards: n, q, first_card, last_card and
    loose as in :func:`day_states`; s is right_num. ``answers`` are as ``explode_answers`` makes them, one row each.

    No shuffle where ``answers`` lie by (user, subject, day): they are sorted once, by point and card, counted card by card from
    the last one back and summed up. A measure is 0, 1 or the seconds, so the sort carries the seconds and a bit for each.
    """
    bits = ["right_num", "total_num", "answered_num", "undone_num", "card_num", "answered_time <> 0"]
    packed = " + ".join(f"CAST({bit} AS INT) * {1 << i}" for i, bit in enumerate(bits))
    rows = answers.select(
        *ROLLUP_KEYS, F.when(F.col("point").isNotNull(), F.col("card_id")).alias("card_id"),
        F.col("all_time").alias("seconds"), F.expr(packed).alias("bits"))
    latest = Window.partitionBy(*ROLLUP_KEYS).orderBy(F.col("card_id").desc())

    def has(bit: str) -> Column:
        return F.col("bits").bitwiseAND(1 << bits.index(bit)) != 0

    def seconds(bit: str) -> Column:
        return F.sum(F.when(has(bit), F.col("seconds")).otherwise(0))

    sums = {m: F.sum(has(m).cast("bigint")) for m in MEASURES if m in bits} | {
        "time_sum": seconds("total_num"), "answered_time": seconds("answered_time <> 0"), "all_time": F.sum("seconds")}
    on_point = F.col("point").isNotNull()
    return (
        rows.withColumn("from_last", F.dense_rank().over(latest).cast("bigint")).groupBy(*ROLLUP_KEYS)
        .agg(*[sums[m].alias(m) for m in MEASURES],
             F.max("from_last").alias("n"), F.sum(F.when(has("right_num"), F.col("from_last")).otherwise(0)).alias("q"),
             F.min("card_id").alias("first_card"), F.max("card_id").alias("last_card"),
             F.max(on_point & F.col("card_id").isNull()).alias("loose"))
        .withColumns({"n": F.when(on_point, F.col("n")).otherwise(0), "q": F.col("q").cast(WIDE)}))


def rows_of(rows: DataFrame, keys: DataFrame, columns: tuple[str, ...]) -> DataFrame:
    """Rows with one of the written, distinct ``keys``, nulls compared like values. A filter in the scan goes before the join,
    so that only what it lets through is shuffled."""
    mark = F.xxhash64(*columns)
    passed = rows.withColumn("_mark", mark).where(
        might_hold(key_filter(keys.select(mark.alias("_mark")), "_mark"), "_mark")).drop("_mark")
    right = keys.select(*[F.col(c).alias(f"_{c}") for c in columns])
    return passed.join(right, [passed[c].eqNullSafe(right[f"_{c}"]) for c in columns], "left_semi")


def day_states(scored: DataFrame) -> DataFrame:
    """One row per (user, subject, point, day) of ``scored``, whose rows are one per card.

    Columns: n, s, q, first_card, last_card, and loose, whether a card has no id. Cards are sorted by range, so a user with
    a third of all cards spreads over partitions; a partition's stretch of a day needs sums only, and stretches are merged.
    """
    order = [*DAY, "card_id"]
    placed = (
        scored.select(*order, "right_num").repartitionByRange(*order).sortWithinPartitions(*order)
        .withColumn("_id", F.monotonically_increasing_id())
        .withColumns({"part": F.shiftright("_id", 33), "place": F.col("_id").bitwiseAND(F.lit((1 << 33) - 1))})
    )
    weighted = F.sum(F.col("right_num").cast("decimal(19,0)") * F.col("place").cast("decimal(19,0)")).cast(WIDE)
    stretches = placed.groupBy(*DAY, "part").agg(
        F.count(F.lit(1)).alias("n"), F.sum("right_num").alias("s"), weighted.alias("weighted"),
        F.min("place").alias("at"), F.min("card_id").alias("first_card"), F.max("card_id").alias("last_card"),
        F.max(F.col("card_id").isNull()).alias("loose"))
    inside = ((F.col("n") + F.col("at")).cast("decimal(18,0)") * F.col("s").cast("decimal(19,0)") - F.col("weighted")).cast(WIDE)
    stretches = stretches.withColumn("q", inside)
    carried = _carried(F.col("n"), F.col("s"), F.col("q"), _earlier(DAY, "part"))
    return _merged(stretches.withColumn("q", carried), *DAY)


def _merged(stretches: DataFrame, *keys: str) -> DataFrame:
    """Stretches that have been carried, summed up."""
    return stretches.groupBy(*keys).agg(
        F.sum("n").alias("n"), F.sum("s").alias("s"), F.sum("q").cast(WIDE).alias("q"),
        F.min("first_card").alias("first_card"), F.max("last_card").alias("last_card"), F.max("loose").alias("loose"))


def _placed_loads(states: DataFrame) -> DataFrame:
    """Day states of several loads, each carried behind the earlier ones of its day; ``tangled`` marks days that have cards in
    no clear order. A state of one card may have no q, which is its s."""
    loads = Window.partitionBy(*DAY).orderBy("first_card", "last_card")
    before = loads.rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy(*DAY)
    tangled = F.col("first_card") <= F.max("last_card").over(before)
    return (
        states.withColumn("q", F.coalesce("q", F.col("s").cast(WIDE)))
        .withColumns({"q": _carried(F.col("n"), F.col("s"), F.col("q"), before), "tangled": F.coalesce(tangled, F.lit(False)),
                      "loads": F.count(F.lit(1)).over(whole)})
        .withColumn("tangled", F.max(F.col("tangled") | (F.col("loose") & (F.col("loads") > 1))).over(whole)))


def merge_loads(states: DataFrame, scored: Callable[[list[date | None]], DataFrame]) -> DataFrame:
    """Day states of several loads as one row per day.

    ``scored`` gives the scored cards of some days; it is asked only for days that have cards in no clear order. At most
    one number per day of the calendar comes to the driver.
    """
    known = materialize(_placed_loads(states), "day-states", "zstd")
    clear = _merged(known.where(~F.col("tangled")), *DAY)
    again = materialize(known.where("tangled").select(*DAY).distinct(), "tangled-days")
    days = [r.day for r in again.select("day").distinct().collect()]
    if not days:
        return clear
    cards = rows_of(scored(days), again, DAY).groupBy(*DAY, "card_id").agg(F.sum("right_num").alias("right_num"))
    return clear.unionByName(day_states(cards))


def point_folds(states: DataFrame, week: tuple[date, date]) -> DataFrame:
    """What each (user, subject, point) adds to the figure of ``running_right``: lifetime, in_week, and tangled, whether it has
    a day whose loads are in no clear order, so that it has to be folded anew from what :func:`merge_loads` gives.

    One shuffle by point and one sort for the merging of loads and for the fold; a group is one point of one user, at most as
    many rows as it has days and loads. Loads of a day are in clear order where each one is behind the one before it.
    No product exceeds the figure itself, as no answer counts less than nothing.
    """
    in_week = F.coalesce(F.col("day").between(*map(F.lit, week)), F.lit(False))
    # Most days have one card: its q is s and its last card the first, which is not sent twice.
    sent = states.select(
        *DAY, "n", "s", F.when(F.col("n") != 1, F.col("q").cast("bigint")).alias("q"), "first_card",
        F.nullif("last_card", "first_card").alias("last_card"), "loose").repartition(*POINT)
    order = Window.partitionBy(*POINT).orderBy("day", "first_card")
    earlier = order.rowsBetween(Window.unboundedPreceding, -1)
    weekly = F.when(in_week, F.col("s"))
    same_day = F.lag("n").over(order).isNotNull() & F.lag("day").over(order).eqNullSafe(F.col("day"))
    tangled = F.lag("loose").over(order) | F.col("loose") | (F.col("first_card") <= F.lag("last_card").over(order))
    placed = sent.withColumns({"q": F.coalesce("q", "s"), "last_card": F.coalesce("last_card", "first_card")}).select(
        *POINT, "n", "q", in_week.alias("counts"), (same_day & F.coalesce(tangled, F.lit(False))).alias("tangled"),
        F.coalesce(F.sum("s").over(earlier), F.lit(0)).alias("before"),
        F.coalesce(F.sum(weekly).over(earlier), F.lit(0)).alias("week_before"))
    return placed.groupBy(*POINT).agg(
        F.sum(F.col("q") + F.col("n") * F.col("before")).alias("lifetime"),
        F.sum(F.when(F.col("counts"), F.col("q") + F.col("n") * F.col("week_before"))).alias("in_week"),
        F.max("tangled").alias("tangled"))


def running_of_loads(states: DataFrame, scored: Callable[[list[date | None]], DataFrame], everyone: DataFrame,
                     week: tuple[date, date]) -> DataFrame:
    """The figure of ``running_right`` for every (user, subject) of ``everyone``, from the day states of several loads.

    Points whose loads are in clear order are folded at once; only the others are merged from their scored cards first.
    """
    points = materialize(point_folds(states, week), "points", "zstd")
    tangled = points.where("tangled")
    found = points.where(~F.col("tangled"))
    if not tangled.isEmpty():
        found = found.unionByName(point_folds(merge_loads(rows_of(states, tangled, POINT), scored), week))
    found = found.groupBy("user_id", "subject").agg(F.sum("lifetime").alias("lifetime"), F.sum("in_week").alias("in_week"))
    return everyone.select("user_id", "subject").distinct().join(found, ["user_id", "subject"], "left").select(
        "user_id", "subject",
        F.coalesce("lifetime", F.lit(0)).cast("bigint").alias("running_right_num"),
        F.coalesce("in_week", F.lit(0)).cast("bigint").alias("week_running_right_num"))
