import pytest
from pyspark.sql import functions as F

from checks.fixture import SETTINGS
from quizlens.functions.rules import SCORED_SUBJECTS, rule_rows
from quizlens.functions.score_text import decode
from quizlens.operators.answers import MEASURES
from quizlens.plans.base import user_subject_base
from tests import model

EVERYONE = SETTINGS.with_(active_days=None)
FIELDS = "user_id bigint, subject int, day string, point int, " + ", ".join(f"{m} bigint" for m in MEASURES)


def scores(spark, groups, **options):
    """groups: {(user, subject): {point: [right, total]}}; returns {key: (score, week score)}."""
    rows = [(user, subject, "2001-07-25", point, right, total, 0, total, 0, 0, 0, 0)
            for (user, subject), points in groups.items() for point, (right, total) in points.items()]
    rows += [(user, subject, "2001-07-25", None, 0, 0, 0, 0, 0, 0, 0, 1) for user, subject in groups]
    df = spark.createDataFrame(rows, FIELDS).withColumn("day", F.to_date("day"))
    return {(r.user_id, r.subject): (r.score, r.week_score)
            for r in user_subject_base(df, EVERYONE.with_(**options)).collect()}


# The text and its score.
def test_golden_text(spark):
    text = "435:6:15:196:0_392:10:26:141:0_754:2:4:175:0"
    df = spark.createDataFrame([(1, text)], "user_id bigint, t string")
    points = {r.point: [r.right_num, r.total_num] for r in decode(df, "t").collect()}
    assert points == {435: [6, 15], 392: [10, 26], 754: [2, 4]}
    total, week = scores(spark, {(1, 1): points})[1, 1]
    assert week == pytest.approx(24.957264957264954, abs=1e-6)
    assert total == 0.0  # 47 answers do not reach the gate


def test_all_subjects_against_formula(spark):
    groups = {}
    for user, share in enumerate([1, 2, 3]):
        for subject in SCORED_SUBJECTS:
            points = [p for s, p, *_ in rule_rows() if s == subject]
            groups[user, subject] = {p: [5 + i * share, 40 + 7 * i] for i, p in enumerate(points[::share])}
    got = scores(spark, groups)
    for (user, subject), points in groups.items():
        total, week = got[user, subject]
        assert total == pytest.approx(model.score(points, subject, 120), abs=1e-6)
        assert week == pytest.approx(model.score(points, subject, None), abs=1e-6)


def test_gate_counts_missing_points(spark):
    # Six points; five missing ones add one each.
    got = scores(spark, {(1, 2): {3125: [57, 114]}, (2, 2): {3125: [57, 115]}})
    assert got[1, 2][0] == 0.0
    assert got[2, 2][0] == pytest.approx(100 * 57 / 120, abs=1e-6)


def test_double_counted_denominator(spark):
    points = {66089: [50, 100], 65902: [30, 40]}
    as_run = scores(spark, {(1, 200100056): points})[1, 200100056][0]
    fixed = scores(spark, {(1, 200100056): points}, fix_denominators=True)[1, 200100056][0]
    assert as_run == pytest.approx(100 * 80 / (200 + 6), abs=1e-6)
    assert fixed == pytest.approx(100 * 80 / (140 + 6), abs=1e-6)


def test_unknown_subject_and_foreign_points(spark):
    got = scores(spark, {(1, 42): {3125: [90, 200]}, (2, 2): {392: [90, 200]}})
    assert got[1, 42] == (0.0, 0.0)
    assert got[2, 2] == (0.0, 0.0)  # six missing points: zero of six


def test_decode_drops_sentinels(spark):
    df = spark.createDataFrame([(1, "-1:0:0:0:0_-1:0:0:0:0"), (2, ""), (3, "-1:0:0:0:0_7:1:2:3:0")], "u int, t string")
    assert [tuple(r) for r in decode(df, "t").collect()] == [(3, 7, 1, 2, 3, 0)]
