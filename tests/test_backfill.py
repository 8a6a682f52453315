from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from checks import fixture as fx
from quizlens.functions import calendar
from quizlens.operators.answers import daily_rollup, explode_answers
from quizlens.operators.materialize import materialize
from quizlens.plans import backfill
from quizlens.plans.base import base_from_cards
from quizlens.plans.week import week_ranks, week_rows
from tests.conftest import SF_DIR

MOMENTS = [datetime(2001, 7, 29, 12), datetime(2001, 7, 22, 23), datetime(2001, 7, 2, 3), datetime(2000, 12, 31, 12)]


@pytest.mark.parametrize("settings", [fx.SETTINGS, fx.SETTINGS.with_(active_days=None, week_time_answered_only=True, min_answered=20)])
def test_four_weeks_equal_four_single_runs(spark, settings):
    cards = fx.cards(spark, SF_DIR).where("user_id % 3 = 0")
    sums = materialize(daily_rollup(explode_answers(cards)), "sums")
    got = materialize(backfill.weeks_rows(sums, MOMENTS, settings, with_text=True), "weeks")
    ranked = backfill.weeks_ranks(got, settings)
    for moment in MOMENTS:
        one = settings.with_(as_of=moment)
        want = materialize(week_rows(base_from_cards(cards, one, with_text=True), one), "week")
        mine = got.where(F.col("week") == one.week_label).drop("week").select(want.columns)
        assert sorted(mine.collect()) == sorted(want.collect()) != []
        if moment == MOMENTS[0]:
            want = week_ranks(want, one)
            assert sorted(ranked.where(F.col("week") == one.week_label).select(want.columns).collect()) == sorted(want.collect())
    assert got.select("week").distinct().count() == 4


def test_one_pass(spark):
    df = backfill.weeks_rows(explode_answers(fx.cards(spark, SF_DIR)), MOMENTS, fx.SETTINGS)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1 and plan.count("Exchange hashpartitioning") == 2
    with pytest.raises(ValueError):
        backfill.weeks_rows(df, [MOMENTS[0], datetime(2001, 7, 27, 12)], fx.SETTINGS)
    with pytest.raises(ValueError):
        backfill.weeks_rows(df, [], fx.SETTINGS)


def test_labels_and_bounds(spark):
    assert calendar.label_bounds("2001-30") == (date(2001, 7, 23), date(2001, 7, 29))
    assert calendar.label_bounds("2019-1") == (date(2018, 12, 31), date(2019, 1, 6))
    for day in range(0, 4000, 13):
        moment = datetime.fromordinal(date(2010, 1, 1).toordinal() + day).replace(hour=12)
        label = calendar.week_label(moment)
        assert calendar.label_bounds(label) == calendar.week_bounds(moment) == calendar.week_bounds(calendar.moment_of(label))
    for bad in ("2001", "2001-54", "x-1", "2001-0"):
        with pytest.raises(ValueError):
            calendar.label_bounds(bad)
    rows = spark.createDataFrame([(x,) for x in ("2001-30", "2019-1", "2020-53", "2019-53", "2001-0", "2001-54", "x-1", "", None)], "label string")
    got = [r[0] for r in rows.select(calendar.label_monday(F.col("label"))).collect()]
    assert got == [date(2001, 7, 23), date(2018, 12, 31), date(2020, 12, 28), None, None, None, None, None, None]
