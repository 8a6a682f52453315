from datetime import date

import pytest

from quizlens.sources.cards import between_days

DAY = date(2001, 7, 26)
STORED = {
    "string": (["20010725", "20010726", "20010727", None, "x"], "GreaterThanOrEqual(createTime,20010726)"),
    "date": (["2001-07-25", "2001-07-26", "2001-07-27", None, None], "GreaterThanOrEqual(createTime,2001-07-26)"),
    "timestamp": (["2001-07-25 23:59:59", "2001-07-26 13:00:00", "2001-07-27 00:00:00", None, "2001-07-26 00:00:00"],
                  "GreaterThanOrEqual(createTime,2001-07-26 00:00:00.0)"),
    "timestamp_ntz": (["2001-07-25 23:59:59", "2001-07-26 13:00:00", "2001-07-27 00:00:00", None, "2001-07-26 00:00:00"],
                      "GreaterThanOrEqual(createTime,2001-07-26T00:00)"),
    "bigint": ([996105599999, 996152400000, 996192000000, None, 996105600000], "GreaterThanOrEqual(createTime,996105600000)"),
}


@pytest.mark.parametrize("kind", STORED)
def test_day_bounds_reach_the_scan_and_keep_the_whole_day(spark, tmp_path, kind):
    values, pushed = STORED[kind]
    plain = spark.createDataFrame([(v,) for v in values], "createTime bigint" if kind == "bigint" else "createTime string")
    plain.select(plain.createTime.cast(kind).alias("createTime")).write.parquet(f"{tmp_path}/cards")
    kept = between_days(spark.read.parquet(f"{tmp_path}/cards"), DAY, DAY)
    assert kept.count() == (1 if kind in ("string", "date") else 2)
    assert pushed in kept._jdf.queryExecution().executedPlan().toString()
