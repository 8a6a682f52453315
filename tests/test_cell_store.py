import os

import pytest
from pyspark.sql import functions as F

from checks import fixture as fx
from quizlens.operators import cell_store, cells
from tests.conftest import SF_DIR
from tests.test_cells import FIELDS, keys


@pytest.fixture
def store(spark):
    name = "cells_of_test"
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    yield name
    spark.sql(f"DROP TABLE IF EXISTS {name}")


def rows(df):
    return sorted(map(tuple, df.select(*cell_store.COLUMNS).collect()), key=str)


def files(spark, name):
    """Data files by shard with their time of change."""
    found = {}
    for path in spark.table(name).inputFiles():
        path = path.removeprefix("file:").replace("//", "/")
        found.setdefault(path.split("shard=")[1].split("/")[0], set()).add((path, os.stat(path).st_mtime_ns))
    return found


def test_an_upsert_touches_the_shards_of_its_keys_only(spark, store):
    everything = fx.cells(spark, SF_DIR)
    old = everything.where("version < 1705276800000000")
    cell_store.create_store(old, store, shards=32, buckets=4)
    before = files(spark, store)
    some = [r.row_key for r in everything.select("row_key").distinct().orderBy("row_key").limit(3).collect()]
    writes = everything.where(F.col("row_key").isin(some) & (F.col("version") >= 1705276800000000)).unionByName(
        spark.createDataFrame([(some[0], "info", "new", 5, 1, "x"), (some[0], "info", "click", 1, 1, "too old")], FIELDS))
    shards = cell_store.upsert_store(spark, store, writes)
    after = files(spark, store)
    assert 0 < len(shards) <= 3
    assert {s for s in before.keys() | after.keys() if before.get(s) != after.get(s)} == {str(s) for s in shards}
    assert rows(spark.table(store)) == rows(cells.upsert_cells(old, writes))
    assert cell_store.upsert_store(spark, store, writes) == shards       # again: the same cells
    assert rows(spark.table(store)) == rows(cells.upsert_cells(old, writes))
    assert cell_store.upsert_store(spark, store, writes.limit(0)) == []


def test_the_stored_side_is_not_shuffled(spark, store):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    everything = fx.cells(spark, SF_DIR)
    cell_store.create_store(everything, store, shards=8, buckets=4)
    stored = cell_store.shards_of(spark, store, [1, 2])
    new = cells.newest_cells(everything.limit(50)).withColumn("shard", cell_store.shard_of(8))
    plan = cell_store.merged(stored, new)._jdf.queryExecution().executedPlan().toString()
    left, right = plan.split("SortMergeJoin")[1].split("\n   :- ")[0], plan
    side = plan[plan.index(":- ") : plan.index("+- Sort", plan.index("FileScan"))] if "+- Sort" in plan else plan
    assert "Exchange" not in side and "FileScan" in side and "PartitionFilters: [shard" in side
    assert "SelectedBucketsCount: 4 out of 4" in side
    kept = spark.table(store).groupBy("shard", *cells.CELL).count()
    assert "Exchange" not in kept._jdf.queryExecution().executedPlan().toString()
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


@pytest.mark.parametrize("limit", ["10m", "-1"])
def test_deletes_and_shards_left_empty(spark, store, limit):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
    data = spark.createDataFrame([(str(k), "info", c, 1, k, "v") for k in range(40) for c in "ab"], FIELDS)
    cell_store.create_store(data, store, shards=16, buckets=2)
    gone = [str(k) for k in range(0, 40, 3)] + ["unknown"]
    shards = cell_store.delete_from_store(spark, store, keys(spark, *gone))
    assert 0 < len(shards) <= 15 and rows(spark.table(store)) == rows(cells.delete_rows(data, keys(spark, *gone)))
    cell_store.delete_from_store(spark, store, keys(spark, *[str(k) for k in range(40)]))
    assert spark.table(store).count() == 0
    cell_store.upsert_store(spark, store, data)
    assert rows(spark.table(store)) == rows(data)
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_versions_are_kept_by_shard(spark, store):
    data = spark.createDataFrame(
        [(str(k), "info", "a", v, v, str(v)) for k in range(30) for v in range(1 + k % 3)] + [("7", "info", "hot", v, v, "x") for v in range(60)], FIELDS)
    cell_store.create_store(data, store, shards=16, buckets=2, newest=False)
    shards = cell_store.retain_versions(spark, store, 24)
    assert len(shards) == 1
    assert rows(spark.table(store)) == rows(cells.keep_versions(data, 24))
    cell_store.add_versions(spark, store, spark.createDataFrame([("3", "info", "a", 100 + v, v, "y") for v in range(30)], FIELDS))
    assert len(cell_store.retain_versions(spark, store, 24)) == 1
    assert spark.table(store).where("row_key = '3'").agg(F.min("version")).first()[0] == 106
    assert cell_store.retain_versions(spark, store, 24) == []
