"""Point statistics as text: ``point:right:total:time:undo`` joined by ``_``."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def point_text(point: Column, right: Column, total: Column, time: Column) -> Column:
    """Aggregate: one text per group, points ascending, rows without a point or answers left out.

    The list holds one entry per knowledge point of the group, never one per answer.
    """
    entry = F.struct(point.alias("point"), right.alias("right"), total.alias("total"), time.alias("time"))
    entries = F.array_sort(F.collect_list(F.when(point.isNotNull() & (total > 0), entry)))
    return F.array_join(
        F.transform(entries, lambda e: F.concat_ws(":", e.point, e.right, e.total, e.time, F.lit(0))), "_"
    )


def encode(stats: DataFrame, keys: list[str]) -> DataFrame:
    """Long point statistics to one text per key."""
    return stats.groupBy(*keys).agg(
        point_text(F.col("point"), F.col("right_num"), F.col("total_num"), F.col("time_sum")).alias("point_stats")
    )


def decode(df: DataFrame, text: str) -> DataFrame:
    """One row per point of a stored text; sentinel points (0 and below) are dropped."""
    rest = [c for c in df.columns if c != text]
    parts = F.split(F.col("_entry"), ":")
    return (
        df.select(*rest, F.explode(F.split(F.col(text), "_")).alias("_entry"))
        .where(F.col("_entry") != "")
        .select(
            *rest,
            parts[0].cast("int").alias("point"),
            parts[1].cast("bigint").alias("right_num"),
            parts[2].cast("bigint").alias("total_num"),
            parts[3].cast("bigint").alias("time_sum"),
            parts[4].cast("bigint").alias("undo_num"),
        )
        .where(F.col("point") > 0)
    )
