"""Zone maps: the smallest and largest row key of every file, so that a key-range scan opens only files that can hold it."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

ZONES = "_zones"        # Spark's readers pass by names that start so


def write_zones(spark: SparkSession, path: str) -> None:
    """Make the zone map of a folder of wide rows; it reads the key column only."""
    (spark.read.parquet(path).groupBy(F.col("_metadata.file_path").alias("file"))
     .agg(F.min("row_key").alias("first"), F.max("row_key").alias("last"), F.count_if(F.col("row_key").isNull()).alias("none"))
     .coalesce(1).write.mode("overwrite").parquet(f"{path.rstrip('/')}/{ZONES}"))


def files_in_range(spark: SparkSession, path: str, low: str, high: str) -> list[str]:
    """Files that may hold keys from ``low`` up to but excluding ``high``: those whose zone meets the range, and those the
    zone map does not know, because they are newer."""
    listed = spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet").option(
        "recursiveFileLookup", "true").load(path).select(F.col("path").alias("file")).where(~F.col("path").contains(f"/{ZONES}/"))
    zones = spark.read.parquet(f"{path.rstrip('/')}/{ZONES}")
    key = F.regexp_replace("file", "^file:/+", "file:/")
    met = zones.withColumn("key", key).select("key", ((F.col("last") >= low) & (F.col("first") < high)).alias("met"))
    found = listed.withColumn("key", key).join(met, "key", "left").where(F.coalesce("met", F.col("met").isNull()))
    return sorted(r.file for r in found.select("file").collect())


def scan_range(spark: SparkSession, path: str, low: str, high: str, columns: Sequence[str]) -> DataFrame:
    """Rows with low <= key < high in byte order; the plan lists only files that can hold them."""
    everything = spark.read.parquet(path)
    files = files_in_range(spark, path, low, high)
    table = spark.read.schema(everything.schema).option("basePath", path).parquet(*files) if files else everything.limit(0)
    return table.where((F.col("row_key") >= low) & (F.col("row_key") < high)).select("row_key", *columns)
