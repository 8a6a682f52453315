"""Maintenance of wide key-value tables.

A cell is (row_key, family, column, version, seq, value); ``seq`` is the write order among equal versions.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

CELL = ("row_key", "family", "column")
WRITTEN = ("version", "seq")


def to_cells(wide: DataFrame, family: str, version: int, seq: int = 0, key: str = "row_key") -> DataFrame:
    """Wide rows to cells; empty cells are not written."""
    names = [c for c in wide.columns if c != key]
    pairs = F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("value")) for c in names])
    return (
        wide.select(F.col(key).alias("row_key"), F.explode(pairs).alias("c"))
        .where(F.col("c.value").isNotNull())
        .select("row_key", F.lit(family).alias("family"), "c.column", F.lit(version).cast("bigint").alias("version"),
                F.lit(seq).cast("bigint").alias("seq"), "c.value")
    )


def newest_cells(cells: DataFrame) -> DataFrame:
    """The newest value of every cell; the last write wins among equal versions."""
    return cells.groupBy(*CELL).agg(
        F.max(F.struct(*WRITTEN, "value")).alias("top")
    ).select(*CELL, "top.version", "top.seq", "top.value")


def upsert_cells(stored: DataFrame, written: DataFrame) -> DataFrame:
    """Stored cells with new writes applied."""
    return newest_cells(stored.unionByName(written))


def delete_rows(cells: DataFrame, keys: DataFrame) -> DataFrame:
    """Cells whose row key is not among ``keys``; adaptive execution broadcasts a key set that turns out small."""
    return cells.join(keys.select("row_key"), "row_key", "left_anti")


def keep_versions(cells: DataFrame, versions: int = 24) -> DataFrame:
    """The newest versions of every cell; each map task drops the rest before the shuffle."""
    newest = Window.partitionBy(*CELL).orderBy(*[F.col(c).desc() for c in (*WRITTEN, "value")])
    kept = cells.withColumn("version_no", F.row_number().over(newest)).where(F.col("version_no") <= versions)
    return kept.withColumn("version_no", F.col("version_no").cast("bigint"))


def scan_rows(table: DataFrame, low: str, high: str, columns: Sequence[str]) -> DataFrame:
    """Rows with low <= key < high in byte order, limited to one family's columns."""
    return table.where((F.col("row_key") >= low) & (F.col("row_key") < high)).select("row_key", *columns)


def newest_rows(cells: DataFrame, family: str, fields: Mapping[str, str]) -> DataFrame:
    """Cells of one family as wide rows of typed columns, newest values only; one shuffle on the row key."""
    written = F.struct(*WRITTEN, "value")
    return cells.where(F.col("family") == family).groupBy("row_key").agg(*[
        F.max(F.when(F.col("column") == name, written)).getField("value").cast(kind).alias(name)
        for name, kind in fields.items()
    ])


def typed_lookup(cells: DataFrame, keys: DataFrame, family: str, fields: Mapping[str, str]) -> DataFrame:
    """Newest values of the asked rows as typed columns; keys without cells give no row.

    ``fields`` maps column to type. Rows are put together first: partial aggregates shrink hot rows, and the join
    with the asked keys reuses the aggregate's partitioning.
    """
    return newest_rows(cells, family, fields).join(keys.select("row_key"), "row_key", "left_semi")
