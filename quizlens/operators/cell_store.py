"""Cells kept as a catalog table of shards and buckets, so that maintenance touches only what it changes.

A shard is a partition, chosen by a hash of the row key; inside it cells lie in buckets by their whole key. An upsert reads and
rewrites the shards of the written keys alone and joins them with the writes bucket by bucket: only the writes are
shuffled. A row with very many cells stays in one shard but spreads over its buckets.

A shard is replaced as a whole when a job commits, and the newest write of a cell wins, so a job that failed half way can
simply run again. There must be one writer at a time.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from quizlens.operators.cells import CELL, WRITTEN, newest_cells
from quizlens.operators.materialize import materialize

COLUMNS = (*CELL, *WRITTEN, "value")
SHARDS, BUCKETS = 64, 8


def shard_of(shards: int) -> Column:
    return F.pmod(F.xxhash64("row_key"), F.lit(shards)).cast("int")


def create_store(cells: DataFrame, name: str, shards: int = SHARDS, buckets: int = BUCKETS, newest: bool = True, **options) -> None:
    """Store cells under a table name, only the newest of each unless all versions are asked for.

    The number of shards is written into the table's properties, so that later calls agree on it. A shard is one file per
    bucket: choose both so that a file has some hundred megabytes.
    """
    rows = newest_cells(cells) if newest else cells
    (rows.select(*COLUMNS, shard_of(shards).alias("shard")).repartition(buckets, *CELL)
     .write.partitionBy("shard").bucketBy(buckets, *CELL).sortBy(*CELL).options(**options).saveAsTable(name))
    cells.sparkSession.sql(f"ALTER TABLE {name} SET TBLPROPERTIES ('cells.shards' = '{shards}')")


def _shards(spark: SparkSession, name: str) -> int:
    return int(spark.sql(f"SHOW TBLPROPERTIES {name} ('cells.shards')").first().value)


def _touched(keys: DataFrame) -> list[int]:
    return sorted(r.shard for r in keys.select("shard").distinct().collect())     # never more than there are shards


def shards_of(spark: SparkSession, name: str, shards: list[int]) -> DataFrame:
    return spark.table(name).where(F.col("shard").isin(shards))


@contextmanager
def _partitions_by_content(spark: SparkSession) -> Iterator[None]:
    """Overwriting replaces the partitions that have rows, not the table. Writing to a table goes by the session's setting."""
    key = "spark.sql.sources.partitionOverwriteMode"
    before = spark.conf.get(key)
    spark.conf.set(key, "dynamic")
    try:
        yield
    finally:
        spark.conf.set(key, before)


def _replace(spark: SparkSession, name: str, rows: DataFrame, shards: list[int]) -> None:
    """Put ``rows`` in the place of the given shards; those left without rows are dropped."""
    written = materialize(rows.select(*COLUMNS, "shard"), "shards")
    filled = _touched(written)
    buckets = next(int(r.data_type) for r in spark.sql(f"DESCRIBE EXTENDED {name}").collect() if r.col_name == "Num Buckets")
    with _partitions_by_content(spark):
        written.repartition(buckets, *CELL).write.mode("overwrite").insertInto(name)
    for shard in sorted(set(shards) - set(filled)):
        spark.sql(f"ALTER TABLE {name} DROP IF EXISTS PARTITION (shard = {shard})")


def merged(stored: DataFrame, new: DataFrame) -> DataFrame:
    """Stored cells with new ones written over them; both hold each cell once. The stored side keeps its buckets."""
    old = stored.select(*CELL, F.struct(*WRITTEN, "value").alias("old"), F.col("shard").alias("old_shard"))
    both = old.join(new.select(*CELL, F.struct(*WRITTEN, "value").alias("new"), F.col("shard").alias("new_shard")), [*CELL], "full")
    return both.select(*CELL, F.greatest("old", "new").alias("top"), F.coalesce("old_shard", "new_shard").alias("shard")).select(
        *CELL, *[f"top.{c}" for c in (*WRITTEN, "value")], "shard")


def upsert_store(spark: SparkSession, name: str, written: DataFrame) -> list[int]:
    """Apply writes to a store of newest cells; the shards that were rewritten."""
    new = materialize(newest_cells(written).withColumn("shard", shard_of(_shards(spark, name))), "writes")
    shards = _touched(new)
    if shards:
        _replace(spark, name, merged(shards_of(spark, name, shards), new), shards)
    return shards


def delete_from_store(spark: SparkSession, name: str, keys: DataFrame) -> list[int]:
    """Take whole rows out; the shards that were rewritten. A key set that is small is broadcast, a large one is joined by
    a shuffle of its shards."""
    gone = materialize(keys.select("row_key").distinct().withColumn("shard", shard_of(_shards(spark, name))), "deletes")
    shards = _touched(gone)
    if shards:
        _replace(spark, name, shards_of(spark, name, shards).join(gone.select("row_key"), "row_key", "left_anti"), shards)
    return shards


def add_versions(spark: SparkSession, name: str, written: DataFrame) -> None:
    """Append versions to a store that keeps them."""
    rows = written.select(*COLUMNS, shard_of(_shards(spark, name)).alias("shard"))
    rows.write.mode("append").insertInto(name)


def retain_versions(spark: SparkSession, name: str, versions: int = 24) -> list[int]:
    """Keep the newest versions of every cell; only shards with a cell that has more are rewritten. Counting and ranking go
    by the stored buckets, without a shuffle."""
    over = spark.table(name).groupBy("shard", *CELL).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > versions)
    shards = _touched(over)
    if shards:
        newest = Window.partitionBy(*CELL).orderBy(*[F.col(c).desc() for c in (*WRITTEN, "value")])
        ranked = shards_of(spark, name, shards).withColumn("version_no", F.row_number().over(newest))
        _replace(spark, name, ranked.where(F.col("version_no") <= versions), shards)
    return shards
