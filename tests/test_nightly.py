import os
from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from checks import fixture as fx
from quizlens.operators import knowledge as kn
from quizlens.operators.materialize import scratch_folder
from quizlens.plans import nightly, wide
from quizlens.plans.base import base_from_cards
from quizlens.plans.totals import days_pass_count
from quizlens.settings import older_job
from tests.conftest import SF_DIR


@pytest.fixture(scope="module")
def points(spark):
    rows = kn.knowledge_subject(*fx.knowledge_tables(spark, SF_DIR)).collect()
    return spark.createDataFrame(rows, "subject int, point bigint, name string")


def test_writes_all_tables_and_cleans_up(spark, points, tmp_path):
    targets = {name: f"{tmp_path}/{name}" for name in ("total", "week", "week_top", "contact")}
    contacts = kn.user_contacts(fx.users(spark, SF_DIR), "updated")
    parent = os.path.dirname(scratch_folder(spark))
    before = set(os.listdir(parent))
    nightly.run(fx.cards(spark, SF_DIR), fx.SETTINGS, targets, points, contacts)
    assert set(os.listdir(parent)) == before
    tables = {name: spark.read.parquet(path) for name, path in targets.items()}
    base = base_from_cards(fx.cards(spark, SF_DIR), fx.SETTINGS)
    assert tables["total"].count() == tables["contact"].count() == base.count() > 0
    assert tables["week"].count() == base.where("week_answered_num > 0").count() > 0
    for name, table in tables.items():
        assert table.select("row_key").distinct().count() == table.count()
    assert all(r.row_key.endswith("-2001-30") for r in tables["week"].select("row_key").collect())
    assert len(tables["total"].columns) == 1 + 15 + 6
    assert len(tables["week"].columns) == 1 + 15 + 5 + 1
    assert len(tables["week_top"].columns) == 1 + 8 + 1


def test_only_its_own_week_is_replaced(spark, points, tmp_path):
    targets = {"week": f"{tmp_path}/week"}
    earlier = fx.SETTINGS.with_(as_of=datetime(2001, 7, 20, 12))
    for settings in (earlier, fx.SETTINGS, fx.SETTINGS):
        nightly.run(fx.cards(spark, SF_DIR), settings, targets, points)
    got = spark.read.parquet(targets["week"])
    assert {r.week for r in got.select("week").distinct().collect()} == {"2001-29", "2001-30"}
    assert got.count() == got.select("row_key").distinct().count()


def test_stored_total_rows_are_carried_over(spark, points, tmp_path):
    first, second = f"{tmp_path}/first", f"{tmp_path}/second"
    nightly.run(fx.cards(spark, SF_DIR), fx.SETTINGS.with_(active_days=None), {"total": first}, points)
    nightly.run(fx.cards(spark, SF_DIR), fx.SETTINGS.with_(active_days=3), {"total": second}, points,
                stored_total=spark.read.parquet(first))
    old, new = spark.read.parquet(first), spark.read.parquet(second)
    assert new.count() == old.count()
    few = base_from_cards(fx.cards(spark, SF_DIR), fx.SETTINGS.with_(active_days=3)).count()
    assert 0 < old.join(new, ["row_key", "user_count", "rank5"], "left_anti").count() <= few < old.count()


def test_merge_keeps_cells_not_written(spark):
    stored = spark.createDataFrame([("a", "1", "x"), ("b", "2", "y")], "row_key string, p string, q string")
    new = spark.createDataFrame([("a", None, "n"), ("c", "3", "m")], "row_key string, p string, r string")
    got = {r.row_key: (r.p, r.q, r.r) for r in wide.merge_wide(stored, new).collect()}
    assert got == {"a": ("1", "x", "n"), "b": ("2", "y", None), "c": ("3", None, "m")}


def test_cells_and_views(spark, points, tmp_path):
    nightly.run(fx.cards(spark, SF_DIR), fx.SETTINGS, {"total": f"{tmp_path}/cells"}, points, family="info")
    cells = spark.read.parquet(f"{tmp_path}/cells")
    assert cells.columns == ["row_key", "family", "column", "version", "seq", "value"]
    assert cells.where("column = 'rank5'").count() == cells.select("row_key").distinct().count()
    snap = nightly.snapshot(fx.cards(spark, SF_DIR), fx.SETTINGS)
    nightly.register_views(snap)
    assert spark.sql("SELECT count(*) FROM user_subject_base").first()[0] == snap.base.count()


def test_legacy_names(spark, points):
    settings = fx.SETTINGS.with_(legacy_names=True)
    snap = nightly.snapshot(fx.cards(spark, SF_DIR), settings, points)
    tables = nightly.output_tables(snap, settings)
    row = tables["total"].first()
    assert ":" in row.grade and float(row.predictScore) >= 0 and row.sp is not None
    assert {"exeDayPassMan", "undoCount", "rank5"} <= set(tables["total"].columns)
    assert {"week_speek", "timeTotal", "undoNum"} <= set(tables["week"].columns)
    assert set(tables["week_top"].columns) == {"row_key", "userId", "grade", "predict_score", "subject", "rank",
                                               "exerciseNum", "exerciseTime", "sortScore"}


def test_older_job(spark):
    settings = older_job(fx.AS_OF)
    snap = nightly.snapshot(fx.cards(spark, SF_DIR), settings)
    tables = nightly.output_tables(snap, settings)
    assert len(tables["total"].columns) == 1 + 10 + 4
    assert len(tables["week"].columns) == 1 + 11 + 4
    assert len(tables["week_top"].columns) == 1 + 7
    assert tables["total"].where("subject = '200100054' AND user_count <> '0'").count() == 0
    assert tables["week_top"].where("CAST(rank AS INT) > 10").count() == 0


def test_days_passed_is_strict_and_over_all_subjects(spark):
    base = spark.createDataFrame([(1, 1, 3), (2, 2, 1), (3, 1, 3), (4, 2, 5)],
                                 "user_id bigint, subject int, practice_days bigint")
    got = {r.user_id: r.days_pass_count for r in days_pass_count(base).collect()}
    assert got == {1: 1, 2: 0, 3: 1, 4: 3}


def test_sorted_keys_prune_a_key_range(spark, tmp_path):
    path = f"{tmp_path}/wide"
    df = spark.range(1000).selectExpr("CAST(id AS STRING) AS row_key", "'x' AS a")
    wide.write_wide(df, path)
    plan = spark.read.parquet(path).where("row_key >= '2' AND row_key < '3'")
    assert "PushedFilters: [IsNotNull(row_key), GreaterThanOrEqual(row_key,2), LessThan(row_key,3)]" in \
        plan._jdf.queryExecution().executedPlan().toString()
    assert plan.count() == 111


def test_command_line(spark, tmp_path):
    cards, out = f"{tmp_path}/cards", f"{tmp_path}/out"
    fx.raw_cards(spark, SF_DIR).write.parquet(cards)
    knowledge, links = fx.knowledge_tables(spark, SF_DIR)
    knowledge.write.parquet(f"{tmp_path}/knowledge")
    links.write.parquet(f"{tmp_path}/links")
    nightly.main([cards, f"{out}/top", f"{out}/week", f"{out}/total", "--as-of", fx.AS_OF.isoformat(),
                  "--knowledge", f"{tmp_path}/knowledge", "--bridge", f"{tmp_path}/links"])
    assert spark.read.parquet(f"{out}/total").count() > 0
    with pytest.raises(SystemExit):
        nightly.main([cards, f"{out}/a", f"{out}/b", f"{out}/c", "--as-of", fx.AS_OF.isoformat()])


@pytest.mark.parametrize("by_name", [False, True])
def test_rewriting_one_week_keeps_the_others(spark, points, tmp_path, by_name):
    target = "weeks_by_name" if by_name else f"{tmp_path}/weeks"
    earlier = fx.SETTINGS.with_(as_of=datetime(2001, 7, 20, 12))
    counts = []
    for settings in (earlier, fx.SETTINGS, fx.SETTINGS):
        nightly.run(fx.cards(spark, SF_DIR), settings, {"week": target}, points)
        got = spark.table(target) if by_name else spark.read.parquet(target)
        counts.append({r.week: r["count"] for r in got.groupBy("week").count().collect()})
    assert set(counts[0]) == {"2001-29"} and set(counts[1]) == {"2001-29", "2001-30"} and counts[1] == counts[2]
    assert counts[1]["2001-29"] == counts[0]["2001-29"]
    if by_name:
        spark.sql(f"DROP TABLE {target}")


def test_rollup_and_one_day_equal_a_full_run(spark, points, tmp_path):
    day, path = date(2001, 7, 25), f"{tmp_path}/rollup"
    cards = fx.cards(spark, SF_DIR).where(F.col("day") <= F.lit(day))
    nightly.write_rollup(cards.where(F.col("day") < F.lit(day)), path)
    today = fx.cards(spark, SF_DIR, day, day)
    for _ in range(2):      # a day that runs again does not count twice
        stored = nightly.read_rollup(spark, path, day)
        assert "PartitionFilters: [" in stored._jdf.queryExecution().executedPlan().toString()
        nightly.run(today, fx.SETTINGS, {"total": f"{tmp_path}/one"}, points, rollup=stored)
        nightly.write_rollup(today, path)
    nightly.run(cards, fx.SETTINGS, {"total": f"{tmp_path}/full"}, points)
    one, full = (spark.read.parquet(f"{tmp_path}/{n}") for n in ("one", "full"))
    assert one.count() == full.count() > 0 and one.exceptAll(full).isEmpty()
    with pytest.raises(ValueError):
        nightly.snapshot(today, fx.SETTINGS.with_(running_right=True), rollup=stored)


def test_days_passed_of_other_rows(spark):
    base = spark.createDataFrame([(3,), (1,)], "practice_days bigint")
    rows = spark.createDataFrame([(2,), (3,), (9,), (None,)], "practice_days bigint")
    got = {r.practice_days: r.days_pass_count for r in days_pass_count(rows, base).collect()}
    assert got == {2: 1, 3: 1, 9: 2, None: 0}
