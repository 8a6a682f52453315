import random

import pytest
from pyspark.sql import functions as F

from quizlens.operators.counting import counting_ranks
from quizlens.operators.materialize import materialize
from tests.test_ranking import collected, window_ranks


@pytest.fixture
def rows(spark):
    rnd = random.Random(11)
    data = [(user * 3 - 900, rnd.choice([1, 1, 2, None]), rnd.choice([0, 0, 0, 1, 5, None]), rnd.choice([0.5, -0.0, 0.0, None, float("nan")]),
             rnd.random()) for user in range(1500)]
    data += [(None, 1, 5, 0.5, 0.1), (None, 2, 0, None, None)]
    return materialize(spark.createDataFrame(data, "user_id bigint, subject int, n bigint, share double, score double"), "rows")


@pytest.mark.parametrize("parts", [1, 2, 16, 256])
def test_equal_window_ranks(rows, many_partitions, parts):
    keys = {"rank": F.col("score"), "rank2": F.col("n"), "rank3": F.col("share")}
    got = counting_ranks(rows, keys, parts=parts, most_values=100)
    assert got.columns == [*rows.columns, *keys]
    assert collected(got) == collected(window_ranks(rows, keys))


def test_rows_are_dealt_once_for_all_counted_keys(rows):
    one, three = {"a": F.col("n")}, {"a": F.col("n"), "b": F.col("share"), "c": -F.col("n")}

    def shuffled(keys):
        plan = counting_ranks(rows, keys)._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" not in plan and "rangepartitioning" not in plan
        return plan.count("Exchange hashpartitioning(_part")

    assert shuffled(one) == shuffled(three) == 1


def test_all_keys_counted_or_none(rows, many_partitions):
    keys = {"rank": F.col("n"), "rank2": F.col("share")}
    expected = collected(window_ranks(rows, keys))
    assert collected(counting_ranks(rows, keys)) == expected
    assert collected(counting_ranks(rows, keys, most_values=0)) == expected


def test_one_value_and_no_rows(spark, rows, many_partitions):
    same = {"rank": F.lit(7)}
    assert collected(counting_ranks(rows, same)) == collected(window_ranks(rows, same))
    assert counting_ranks(materialize(rows.limit(0), "none"), same).count() == 0
