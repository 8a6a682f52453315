import os

import pytest

from quizlens.plans import wide
from quizlens.sources import zones


@pytest.fixture
def many_files(spark):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "12")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    yield
    spark.conf.set("spark.sql.shuffle.partitions", before)
    spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def wide_rows(spark, n=2000):
    return spark.range(n).selectExpr("CAST(id AS STRING) AS row_key", "id * 2 AS a", "'x' AS b")


def test_a_narrow_range_opens_few_files(spark, tmp_path, many_files):
    path = f"{tmp_path}/wide"
    wide.write_wide(wide_rows(spark), path)
    zones.write_zones(spark, path)
    assert spark.read.parquet(path).count() == 2000            # the zone map is no part of the table
    total = len([f for f in os.listdir(path) if f.endswith(".parquet")])
    for low, high in [("150", "155"), ("2", "3"), ("", "~"), ("5", "5"), ("~", "~~")]:
        got = zones.scan_range(spark, path, low, high, ["a"])
        assert sorted(map(tuple, got.collect())) == sorted(
            (str(i), i * 2) for i in range(2000) if low <= str(i) < high), (low, high)
        opened = len(zones.files_in_range(spark, path, low, high))
        assert opened <= (total if high == "~" else 3 if low == "2" else 2)
    assert total > 8
    assert len(zones.scan_range(spark, path, "150", "155", ["a"]).inputFiles()) <= 2


def test_files_the_map_does_not_know_are_read(spark, tmp_path):
    path = f"{tmp_path}/wide"
    wide.write_wide(wide_rows(spark, 100), path)
    zones.write_zones(spark, path)
    wide.write_wide(wide_rows(spark, 120).where("a >= 200"), path, mode="append")
    assert zones.scan_range(spark, path, "1", "2", ["a"]).count() == sum(str(i) < "2" and str(i) >= "1" for i in range(120))


def test_partitioned_tables(spark, tmp_path):
    path = f"{tmp_path}/week"
    for label in ("2001-29", "2001-30"):
        wide.write_wide(wide_rows(spark, 50), path, partition={"week": label})
    zones.write_zones(spark, path)
    got = zones.scan_range(spark, path, "10", "12", ["a", "week"])
    assert sorted(map(tuple, got.collect())) == sorted((k, 2 * int(k), w) for k in ("10", "11") for w in ("2001-29", "2001-30"))
