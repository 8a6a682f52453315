"""Ranks and leaderboards per group.

Every rank is a row number with the tie column appended, so results do not depend on partitioning.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from quizlens.operators.materialize import materialize

# Position of a row inside its partition, as packed by monotonically_increasing_id.
_ROW_BITS = 33

#: Parts a group is cut into before the best rows of all parts compete.
TOP_PARTS = 64

_WHOLE = ("tinyint", "smallint", "int", "bigint")


def rank_keys(rows: DataFrame, ranks: Mapping[str, Column]) -> Column:
    """One entry per rank; whole numbers keep their exact value, everything else is compared as a double."""
    types = dict(rows.select(*[key.alias(name) for name, key in ranks.items()]).dtypes)
    return F.array(*[
        F.struct(F.lit(i).alias("rank_no"),
                 (key if types[name] in _WHOLE else F.lit(None)).cast("bigint").alias("whole"),
                 (F.lit(None) if types[name] in _WHOLE else key).cast("double").alias("real"))
        for i, (name, key) in enumerate(ranks.items())
    ])


def group_ranks(
    rows: DataFrame, ranks: Mapping[str, Column], group: str = "subject", tie: str = "user_id"
) -> DataFrame:
    """Adds one rank column per entry of ``ranks`` (descending, NaN first, nulls last); ties go by ``tie``, nulls first.

    All rank keys go through one range shuffle on (rank, group, key, tie). The tie column makes the sort key unique, so
    a group, or a huge set of equal keys, spreads over as many partitions as its size needs. A row's rank is its place
    in its partition plus the rows of its group in earlier partitions. Only keys are sorted; what else a row holds is
    joined once. (group, tie) must be unique, null being a value of its own, and ``rows`` cheap to read twice.
    """
    order = [F.col("rank_no").asc(), F.col(group).asc(), F.col("whole").desc_nulls_last(),
             F.col("real").desc_nulls_last(), F.col(tie).asc()]
    # Written out because offsets and rows must see the same partition borders.
    placed = materialize(
        rows.select(tie, group, F.explode(rank_keys(rows, ranks)).alias("k")).select(tie, group, "k.*")
        .repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .withColumn("_id", F.monotonically_increasing_id())
        .select(tie, group, "rank_no",
                F.shiftright("_id", _ROW_BITS).alias("part"),
                F.col("_id").bitwiseAND(F.lit((1 << _ROW_BITS) - 1)).alias("place")),
        "placed",
    )
    spans = placed.groupBy("rank_no", group, "part").agg(
        F.min("place").alias("first_place"), F.count(F.lit(1)).alias("span")
    )
    before = Window.partitionBy("rank_no", group).orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = spans.select(
        F.col("rank_no").alias("o_no"), F.col(group).alias("o_group"), F.col("part").alias("o_part"),
        (F.coalesce(F.sum("span").over(before), F.lit(0)) - F.col("first_place") + 1).alias("shift"))
    ranked = placed.join(offsets, (F.col("rank_no") == F.col("o_no")) & (F.col("part") == F.col("o_part"))
                         & F.col(group).eqNullSafe(F.col("o_group")))
    wide = ranked.groupBy(F.col(tie).alias("r_tie"), F.col(group).alias("r_group")).agg(*[
        F.max(F.when(F.col("rank_no") == i, F.col("place") + F.col("shift"))).alias(f"r_{i}")
        for i in range(len(ranks))
    ])
    same = rows[tie].eqNullSafe(wide["r_tie"]) & rows[group].eqNullSafe(wide["r_group"])
    return rows.join(wide, same).select(
        *[rows[c] for c in rows.columns], *[F.col(f"r_{i}").alias(name) for i, name in enumerate(ranks)])


def top_rows(
    rows: DataFrame, key: Column, k: int, group: str = "subject", tie: str = "user_id", rank: str = "rank"
) -> DataFrame:
    """The k best rows per group.

    Each group competes in parts first, by a hash of the tie column, so the last step sees at most k rows of each part.
    """
    order = [key.desc_nulls_last(), F.col(tie).asc()]

    def best(df: DataFrame, *by: str) -> DataFrame:
        return df.withColumn(rank, F.row_number().over(Window.partitionBy(*by).orderBy(*order))).where(F.col(rank) <= k)

    parts = best(rows.withColumn("_part", F.pmod(F.xxhash64(tie), F.lit(TOP_PARTS))), group, "_part").drop("_part", rank)
    return best(parts, group).withColumn(rank, F.col(rank).cast("bigint"))
