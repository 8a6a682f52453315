import pytest

from quizlens.operators import cells

FIELDS = "row_key string, family string, column string, version bigint, seq bigint, value string"


@pytest.fixture
def stored(spark):
    return spark.createDataFrame([
        ("10", "info", "hits", 1, 1, "138"), ("10", "info", "hits", 2, 2, "140"), ("10", "info", "rate", 1, 3, "0.55"),
        ("10", "info", "day", 1, 4, "2018-06-13"), ("9", "info", "hits", 5, 5, "7"), ("9", "other", "hits", 9, 6, "8"),
    ], FIELDS)


def keys(spark, *values):
    return spark.createDataFrame([(v,) for v in values], "row_key string")


def test_later_write_wins(spark, stored):
    new = spark.createDataFrame([("10", "info", "hits", 2, 7, "141"), ("10", "info", "rate", 0, 8, "old"),
                                 ("11", "info", "hits", 1, 9, "1")], FIELDS)
    got = {(r.row_key, r.family, r.column): r.value for r in cells.upsert_cells(stored, new).collect()}
    assert got == {("10", "info", "hits"): "141", ("10", "info", "rate"): "0.55", ("10", "info", "day"): "2018-06-13",
                   ("9", "info", "hits"): "7", ("9", "other", "hits"): "8", ("11", "info", "hits"): "1"}


@pytest.mark.parametrize("limit", ["10m", "-1"])
def test_lookup_and_delete_with_and_without_broadcast(spark, stored, limit, monkeypatch):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
    asked = keys(spark, "10", "77")
    fields = {"hits": "bigint", "rate": "double", "day": "string", "none": "string"}
    row, = cells.typed_lookup(stored, asked, "info", fields).collect()
    assert row.asDict() == {"row_key": "10", "hits": 140, "rate": 0.55, "day": "2018-06-13", "none": None}
    assert {r.row_key for r in cells.delete_rows(stored, asked).collect()} == {"9"}
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_row_with_other_cells_only_is_still_found(spark, stored):
    row, = cells.typed_lookup(stored, keys(spark, "9"), "info", {"rate": "double"}).collect()
    assert row.asDict() == {"row_key": "9", "rate": None}


def test_versions(spark):
    df = spark.createDataFrame([("1", "f", "c", v, v, str(v)) for v in range(40)], FIELDS)
    kept = cells.keep_versions(df)
    assert sorted(r.version for r in kept.collect()) == list(range(16, 40))
    assert "WindowGroupLimit" in kept._jdf.queryExecution().executedPlan().toString()


def test_range_is_half_open_in_byte_order(spark):
    rows = [(k, "a", "b") for k in ("1", "10", "2", "20", "3")]
    df = spark.createDataFrame(rows, "row_key string, x string, y string")
    got = cells.scan_rows(df, "10", "3", ["x"])
    assert got.columns == ["row_key", "x"]
    assert sorted(r.row_key for r in got.collect()) == ["10", "2", "20"]


def test_wide_rows_to_cells(spark):
    df = spark.createDataFrame([("k", 1, None)], "row_key string, a int, b string")
    assert [tuple(r) for r in cells.to_cells(df, "f", version=3).collect()] == [("k", "f", "a", 3, 0, "1")]
