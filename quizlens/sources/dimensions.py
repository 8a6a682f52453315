"""Dimension tables over JDBC. Connection details are always passed in, never kept here."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession


def jdbc_options(
    connection: Mapping[str, str], table: str, *,
    split_on: str | None = None, lower: int | None = None, upper: int | None = None, parts: int | None = None,
    fetch_size: int = 10_000,
) -> dict[str, str]:
    """Reader options; with ``split_on`` the table is read by several tasks instead of one."""
    if "url" not in connection:
        raise ValueError("connection needs a url")
    options = {**connection, "dbtable": table, "fetchsize": str(fetch_size)}
    if split_on is not None:
        if lower is None or upper is None or parts is None:
            raise ValueError("split_on needs lower, upper and parts")
        options |= {"partitionColumn": split_on, "lowerBound": str(lower), "upperBound": str(upper),
                    "numPartitions": str(parts)}
    return options


def read_dimension(
    spark: SparkSession, connection: Mapping[str, str], table: str, *, view: str | None = None, **split
) -> DataFrame:
    """Load one table and, if asked, name it for SQL."""
    df = spark.read.format("jdbc").options(**jdbc_options(connection, table, **split)).load()
    if view is not None:
        df.createOrReplaceTempView(view)
    return df
