import random

import pytest
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from quizlens.operators.materialize import materialize
from quizlens.operators.ranking import group_ranks, top_rows


def window_ranks(rows, ranks, group="subject", tie="user_id"):
    """The same by one window per rank, each group in one task."""
    for name, key in ranks.items():
        order = Window.partitionBy(group).orderBy(key.desc_nulls_last(), F.col(tie).asc())
        rows = rows.withColumn(name, F.row_number().over(order).cast("bigint"))
    return rows


@pytest.fixture
def keys(spark):
    return {"rank": F.col("score"), "rank2": F.col("n")}


@pytest.fixture
def rows(spark):
    rnd = random.Random(5)
    # Half of the rows sit in one subject, most of them with the same score.
    data = [(user, rnd.choice([1, 1, 2, 3]), rnd.choice([0.0, 0.0, 0.0, 12.5, None, rnd.random()]), rnd.randrange(40))
            for user in range(2000)]
    return spark.createDataFrame(data, "user_id bigint, subject int, score double, n bigint")


def collected(df):
    columns = sorted(df.columns)
    return sorted(map(repr, (tuple(r[c] for c in columns) for r in df.collect())))


def test_equal_window_ranks(spark, rows, keys, many_partitions):
    ranged = group_ranks(materialize(rows, "rows"), keys)
    assert ranged.columns == [*rows.columns, *keys]
    assert ranged.count() == 2000
    assert collected(ranged) == collected(window_ranks(rows, keys))


def test_groups_cross_partitions(spark, rows, keys, many_partitions, monkeypatch):
    from quizlens.operators import ranking

    seen = {}

    def spy(df, label):
        out = materialize(df, label)
        seen["parts"] = out.select("part").distinct().count()
        seen["per_subject"] = out.groupBy("rank_no", "subject").agg(F.countDistinct("part").alias("p")).agg(
            F.max("p")).first()[0]
        return out

    monkeypatch.setattr(ranking, "materialize", spy)
    group_ranks(materialize(rows, "rows"), keys)
    assert seen["parts"] > 3 and seen["per_subject"] > 1


def test_large_whole_numbers_nan_and_nulls(spark, many_partitions):
    data = [(1, None, 2**53, float("nan")), (2, None, 2**53 + 1, 1.0), (3, None, None, None), (None, 1, 5, 2.0),
            (4, 1, 5, float("inf")), (5, 1, -2**63, float("-inf")), (6, 1, 2**63 - 1, None), (7, 2, None, float("nan"))]
    df = materialize(spark.createDataFrame(data, "user_id bigint, subject int, n bigint, score double"), "rows")
    ranks = {"rank": F.col("n"), "rank2": F.col("score")}
    got = group_ranks(df, ranks)
    assert got.count() == len(data)
    assert collected(got) == collected(window_ranks(df, ranks))
    assert {r.user_id: r["rank"] for r in got.where("subject IS NULL").collect()} == {2: 1, 1: 2, 3: 3}


def test_no_rows(spark, rows, keys):
    assert group_ranks(rows.limit(0), keys).count() == 0
    assert top_rows(rows.limit(0), F.col("score"), 3).count() == 0


@pytest.mark.parametrize("k", [1, 5, 1001, 5000])
def test_top_rows(spark, rows, many_partitions, k):
    ranked = window_ranks(rows, {"rank": F.col("score")})
    assert collected(top_rows(rows, F.col("score"), k)) == collected(ranked.where(f"rank <= {k}"))


def test_top_rows_are_pruned_in_the_map_stage(spark, rows):
    assert "WindowGroupLimit" in top_rows(rows, F.col("score"), 5)._jdf.queryExecution().executedPlan().toString()
