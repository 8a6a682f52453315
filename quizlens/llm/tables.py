"""Helpers on DataFrames that several operators share."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quizlens.operators.materialize import materialize


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def set_aside(df: DataFrame, *helpers: str) -> tuple[DataFrame, dict[str, str]]:
    """``df`` with columns that have a helper's name renamed, and the names that give them back afterwards."""
    taken, back = {c.lower() for c in (*df.columns, *helpers)}, {}
    for column in df.columns:
        if column.lower() in {h.lower() for h in helpers}:
            name = f"{column}_own"
            while name.lower() in taken:
                name += "_"
            taken.add(name.lower())
            back[name] = column
    return df.withColumnsRenamed({column: name for name, column in back.items()}) if back else df, back


def parallelism(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def number_within(df: DataFrame, key: str, name: str) -> DataFrame:
    """Add ``name``: 0, 1, 2, ... within each value of the column ``key``, in no particular order.

    Rows are sorted by range of (key, number of the row), so a key with a third of all rows spreads over as many tasks
    as its size needs. A row adds its place in its range to what earlier ranges hold of its key. The sorted rows are
    written before they are counted, so a repeated task cannot change them. ``df`` must be a written table: behind a
    shuffle a repeated task may read its rows in another order and number them anew.
    """
    order = [F.col(key), F.col("_row")]
    placed = materialize(
        df.withColumn("_row", F.monotonically_increasing_id()).repartitionByRange(*order).sortWithinPartitions(*order)
        .withColumn("_id", F.monotonically_increasing_id()).select(
            *df.columns, F.shiftright("_id", 33).alias("_part"),
            F.col("_id").bitwiseAND(F.lit((1 << 33) - 1)).alias("_place")), "numbered")
    spans = placed.groupBy(key, "_part").agg(F.min("_place").alias("_first"), F.count(F.lit(1)).alias("_span"))
    earlier = Window.partitionBy(key).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    shifts = spans.select(key, "_part", (F.coalesce(F.sum("_span").over(earlier), F.lit(0)) - F.col("_first")).alias("_shift"))
    return placed.join(shifts, [key, "_part"]).select(*df.columns, (F.col("_place") + F.col("_shift")).alias(name))


def with_run(df: DataFrame, key: str, number: str, runs: pd.DataFrame) -> DataFrame:
    """Add the columns of the run each row falls in: of its ``key``, the last whose ``first`` is not above ``number``.

    ``runs`` has key, first and further whole numbers, of every key from 0 on. It is a plan, of bounded size.
    """
    columns = [c for c in runs.columns if c != key]
    lists = runs.sort_values([key, "first"]).groupby(key)[columns].agg(list).reset_index()
    schema = ", ".join([f"{key} long", *(f"_{c} array<long>" for c in columns)])
    rows = [tuple([int(k), *([int(x) for x in v] for v in values)]) for k, *values in lists.itertuples(index=False)]
    plan = df.sparkSession.createDataFrame(rows, schema)
    at = F.size(F.filter("_first", lambda first: first <= F.col(number))) - 1
    found = df.join(plan, key).withColumn("_nth", at)
    return found.select(*df.columns, *[F.get(f"_{c}", F.col("_nth")).alias(c) for c in columns])


def components(edges: DataFrame) -> DataFrame:
    """Connected components of ``edges`` (u, v: long): rows (node, root) with the smallest node as root.

    Large-star and small-star rounds in turn; every round is a few shuffles of the edges and is written out, so lost
    executors cost a round at most. No component is gathered anywhere: minima are combined before the shuffle and the
    joins on a hub are split by adaptive execution. Null ends and loops are left out.
    """
    current = materialize(edges.where("u <> v").selectExpr("greatest(u, v) AS u", "least(u, v) AS v").distinct(), "edges")
    state = _state(current)
    while state[0]:
        both = current.union(current.selectExpr("v AS u", "u AS v"))
        large = _to_minimum(both).where("v > u").selectExpr("v AS u", "m AS v")
        directed = large.where("u <> v").distinct()
        small = _to_minimum(directed).selectExpr("v AS u", "m AS v").union(
            directed.groupBy("u").agg(F.min("v").alias("v")))
        current = materialize(small.where("u <> v").distinct(), "edges")
        before, state = state, _state(current)
        if state == before:
            break
    return current.selectExpr("u AS node", "v AS root").union(current.selectExpr("v AS node", "v AS root").distinct())


def _to_minimum(edges: DataFrame) -> DataFrame:
    least = edges.groupBy("u").agg(F.min("v").alias("m")).selectExpr("u", "least(u, m) AS m")
    return edges.join(least, "u")


def _state(edges: DataFrame) -> tuple:
    row = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
    return row[0], row[1]
