"""Wide output tables: a row key and one family of text cells."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quizlens.operators.knowledge import attach_contacts, attach_subject_points
from quizlens.plans.totals import attach_totals, days_pass_count, subject_totals, total_ranks
from quizlens.plans.week import week_ranks, week_subject_totals, week_top
from quizlens.settings import Settings

# The cell labels of the original tables, score and statistics swapped as they were.
LEGACY_TOTAL = {
    "point_stats": "grade", "score": "predictScore", "answered_num": "exerciseNum",
    "answered_time": "exerciseTime", "practice_days": "exerciseDay", "subject": "subject", "rank": "rank",
    "rank2": "rank2", "rank3": "rank3", "rank4": "rank4", "points": "sp", "point_names": "spn",
    "days_pass_count": "exeDayPassMan", "sort_score": "sortScore", "rank5": "rank5",
    "user_count": "userCount", "qualified_user_count": "qualifiedUserCount", "question_count": "quesCount",
    "time_total": "exerciseTimeTotal", "right_total": "correctNum", "undo_total": "undoCount",
}
LEGACY_WEEK = {
    "week_point_stats": "grade", "week_score": "predict_score", "subject": "subject", "rank": "rank",
    "week_answered_num": "exerciseNum", "week_time": "exerciseTime", "rank2": "rank2", "rank3": "rank3",
    "rank4": "rank4", "week_speed": "week_speek", "week_accuracy": "week_accuracy", "points": "sp",
    "point_names": "spn", "week_sort_score": "sortScore", "rank5": "rank5",
    "user_count": "userCount", "question_count": "quesCount", "time_total": "timeTotal",
    "right_total": "correctNum", "undo_total": "undoNum",
}
LEGACY_TOP = {**LEGACY_WEEK, "user_id": "userId"}


def row_key(*parts: Column) -> Column:
    return F.concat_ws("-", *[p.cast("string") for p in parts])


def _cells(rows: DataFrame, key: Column, columns: list[str], settings: Settings, legacy: dict[str, str],
           filled: tuple[str, ...] = ()) -> DataFrame:
    """Text cells under a row key; ``filled`` columns get the settings' text where they have no value."""
    cells = []
    for name in columns:
        text = F.col(name).cast("string")
        if name in filled and settings.missing_total is not None:
            text = F.coalesce(text, F.lit(settings.missing_total))
        cells.append(text.alias(legacy[name] if settings.legacy_names else name))
    return rows.select(key.alias("row_key"), *cells)


def total_wide(base: DataFrame, subject_lists: DataFrame | None, settings: Settings) -> DataFrame:
    """One row per (user, subject). ``base`` should be materialized and carry the point texts."""
    ranked = total_ranks(base, settings)
    columns = ["point_stats", "score", "answered_num", "answered_time", "practice_days", "subject",
               "rank", "rank2", "rank3", "rank4"]
    totals = ["user_count", "question_count", "time_total", "right_total"]
    if settings.with_extra_ranks:
        ranked = attach_subject_points(days_pass_count(ranked, base), subject_lists)
        columns += ["points", "point_names", "days_pass_count", "sort_score", "rank5"]
        totals = ["user_count", "qualified_user_count", "question_count", "time_total", "right_total", "undo_total"]
    rows = attach_totals(ranked, subject_totals(base, settings), totals)
    key = row_key(F.col("user_id"), F.col("subject"))
    return _cells(rows, key, columns + totals, settings, LEGACY_TOTAL, tuple(totals))


def week_wide(week: DataFrame, subject_lists: DataFrame | None, settings: Settings) -> DataFrame:
    ranked = week_ranks(week, settings)
    columns = ["week_point_stats", "week_score", "subject", "rank", "week_answered_num", "week_time",
               "rank2", "rank3", "rank4", "week_speed", "week_accuracy"]
    totals = ["user_count", "question_count", "time_total", "right_total"]
    if settings.with_extra_ranks:
        ranked = attach_subject_points(ranked, subject_lists)
        columns += ["points", "point_names", "week_sort_score", "rank5"]
        totals = [*totals, "undo_total"]
    rows = attach_totals(ranked, week_subject_totals(week, settings), totals)
    key = row_key(F.col("user_id"), F.col("subject"), F.lit(settings.week_label))
    return _cells(rows, key, columns + totals, settings, LEGACY_WEEK, tuple(totals))


def week_top_wide(week: DataFrame, settings: Settings) -> DataFrame:
    columns = ["user_id", "week_point_stats", "week_score", "subject", "rank", "week_answered_num", "week_time"]
    if settings.with_extra_ranks:
        columns.append("week_sort_score")
    key = row_key(F.col("rank"), F.col("subject"), F.lit(settings.week_label))
    return _cells(week_top(week, settings), key, columns, settings, LEGACY_TOP)


def contact_wide(base: DataFrame, contacts: DataFrame, settings: Settings) -> DataFrame:
    """The variant with user contacts and without ranks."""
    columns = ["point_stats", "score", "answered_num", "answered_time", "practice_days", "subject", "sort_score"]
    contact = ["phone_hash", "phone_masked"]
    labels = {**LEGACY_TOTAL, **{c: c for c in contact}}
    key = row_key(F.col("user_id"), F.col("subject"))
    return _cells(attach_contacts(base, contacts), key, columns + contact, settings, labels)


def merge_wide(stored: DataFrame, new: DataFrame) -> DataFrame:
    """Stored rows with new ones written over them cell by cell; rows and cells not written stay as they are."""
    columns = [c for c in new.columns if c != "row_key"]
    columns += [c for c in stored.columns if c not in new.columns]
    both = new.alias("n").join(stored.alias("s"), "row_key", "full")

    def cell(name: str) -> Column:
        sides = [F.col(f"{side}.{name}") for side, df in (("n", new), ("s", stored)) if name in df.columns]
        return F.coalesce(*sides).alias(name)

    return both.select("row_key", *map(cell, columns))


def _literal(value: str) -> str:
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def write_wide(wide: DataFrame, target: str, *, format: str = "parquet", mode: str = "overwrite",
               partition: Mapping[str, str] | None = None, sort_keys: bool = True, **options: str) -> None:
    """Save a wide table by path, or by table name when ``target`` has no slash.

    Sorted keys give each file a narrow key range, which is what a later key-range scan prunes on. With ``partition``,
    values of partition columns that ``wide`` does not have, only that partition is replaced. A table that exists takes
    its columns by name.
    """
    spark, partition = wide.sparkSession, partition or {}
    if sort_keys:
        wide = wide.repartitionByRange("row_key").sortWithinPartitions("row_key")
    if partition and "/" not in target and mode == "overwrite" and spark.catalog.tableExists(target):
        place = ", ".join(f"`{name}` = {_literal(value)}" for name, value in partition.items())
        columns = ", ".join(f"`{name}`" for name in wide.columns)
        spark.sql(f"INSERT OVERWRITE TABLE {target} PARTITION ({place}) ({columns}) SELECT * FROM {{wide}}", wide=wide)
        return
    writer = wide.withColumns({name: F.lit(value) for name, value in partition.items()}).write.format(format).mode(
        mode).options(**options)
    if partition:
        writer = writer.partitionBy(*partition).option("partitionOverwriteMode", "dynamic")
    writer.save(target) if "/" in target else writer.saveAsTable(target)
