"""Ranks by counting, for keys of few distinct values: practice days, numbers of answers.

How many rows of a group have a higher value follows from a histogram, so no row is sorted by its value. What is left
is the tie: the place among rows of the same value. Rows are dealt once by ranges of the tie column, the same ranges for
all keys; the histogram is kept by range too, so it also says how many equal rows lie in earlier ranges, and within a
range rows are numbered where they are.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from quizlens.operators.ranking import group_ranks, rank_keys

#: Ranges of the tie column, and (group, value) pairs of a key that is counted. Their product bounds what is broadcast of a key.
PARTS, MOST_VALUES = 256, 4096


def counting_ranks(
    rows: DataFrame, ranks: Mapping[str, Column], group: str = "subject", tie: str = "user_id",
    parts: int = PARTS, most_values: int = MOST_VALUES,
) -> DataFrame:
    """The rows and columns of :func:`group_ranks`, for a numeric ``tie``.

    Keys with up to about ``most_values`` pairs of group and value are counted, the others go to :func:`group_ranks`. One
    aggregate over ``rows``, which should be cheap to read again, tells which, and where the ranges of ties begin. A range
    holds an equal share of all rows, however many of them share a value or a group.
    """
    columns, names = rows.columns, list(ranks)
    measured = rows.agg(
        F.percentile_approx(tie, [i / parts for i in range(1, parts)], 20 * parts).alias("cuts"),
        *[F.approx_count_distinct(F.xxhash64(group, key)).alias(f"values_{i}") for i, key in enumerate(ranks.values())],
    ).first()
    few = {name: key for i, (name, key) in enumerate(ranks.items()) if measured[f"values_{i}"] <= most_values}
    many = {name: key for name, key in ranks.items() if name not in few}
    ranked = group_ranks(rows, many, group, tie) if many else rows
    if not few:
        return ranked
    cuts = F.array(*[F.lit(cut) for cut in sorted(set(measured["cuts"] or []))])      # one number per range
    part = F.when(F.col(tie).isNull(), -1).otherwise(F.size(F.filter(cuts, lambda cut: cut <= F.col(tie))))

    counted = rows.select(group, part.alias("part"), F.explode(rank_keys(rows, few)).alias("k")).groupBy(
        group, "part", "k.rank_no", "k.whole", "k.real").agg(F.count(F.lit(1)).alias("n"))
    before = Window.partitionBy("rank_no", group).orderBy(
        F.col("whole").desc_nulls_last(), F.col("real").desc_nulls_last(), "part").rowsBetween(Window.unboundedPreceding, -1)
    counted = counted.withColumn("above", F.coalesce(F.sum("n").over(before), F.lit(0)))

    # Dealt by range alone: every window below finds its rows in one task and only sorts them there.
    out = ranked.withColumns({"_part": part, "_keys": rank_keys(rows, few)}).repartition("_part")
    for i, name in enumerate(few):
        key = F.col("_keys")[i]
        place = Window.partitionBy("_part", group, "_whole", "_real").orderBy(F.col(tie).asc())
        out = out.withColumns({"_whole": key["whole"], "_real": key["real"]}).withColumn("_place", F.row_number().over(place))
        here = counted.where(F.col("rank_no") == i).select(
            F.col(group).alias("c_group"), F.col("part").alias("c_part"), F.col("whole").alias("c_whole"),
            F.col("real").alias("c_real"), "above")
        same = (F.col("_part") == F.col("c_part")) & F.col(group).eqNullSafe(F.col("c_group")) & (
            F.col("_whole").eqNullSafe(F.col("c_whole")) & F.col("_real").eqNullSafe(F.col("c_real")))
        out = out.join(F.broadcast(here), same).withColumn(name, F.col("above") + F.col("_place")).drop(
            *here.columns, "_whole", "_real", "_place")
    return out.select(*columns, *names)
