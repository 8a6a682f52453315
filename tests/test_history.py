import os
import random
import shutil
from datetime import date

import pytest
from pyspark.sql import functions as F

from checks import fixture as fx
from quizlens.operators import prefix
from quizlens.operators.answers import (
    MEASURES, ROLLUP_KEYS, daily_rollup, explode_answers, narrowed, point_stats)
from quizlens.operators.running import running_right
from quizlens.plans import history, nightly
from quizlens.plans.base import base_from_cards, user_subject_base
from quizlens.sources.cards import normalise_cards, read_cards
from tests import model
from tests.conftest import SF_DIR
from tests.test_answers import EVERYONE, random_cards

SETTINGS = fx.SETTINGS


def awkward_cards(seed, n=240):
    """Unreadable and null days, ids that interleave, cards split into two rows, cards without an id."""
    r = random.Random(seed)
    rows = []
    for card in random_cards(seed, n):
        day = r.choice([card[3]] * 6 + ["bad", None, "20010726", "99999999"])
        rows.append((r.choice([card[0]] * 9 + [None, 7]), *card[1:3], day, *card[4:]))
    return rows


def store(spark, rows, path):
    spark.createDataFrame(rows, model.CARD_FIELDS).coalesce(1).write.mode("append").parquet(path)


def same_as_full(spark, root, rows):
    cards = normalise_cards(spark.createDataFrame(rows, model.CARD_FIELDS), card_id="cardId")
    sums = history.stored_sums(spark, root)
    assert sorted(user_subject_base(sums, EVERYONE, with_text=True).collect()) == sorted(
        base_from_cards(cards, EVERYONE, with_text=True).collect())
    assert sorted(point_stats(sums).collect()) == sorted(point_stats(explode_answers(cards)).collect())
    assert sorted(history.stored_running(spark, root, SETTINGS.week).collect()) == sorted(
        running_right(explode_answers(cards), SETTINGS.week).collect())


@pytest.mark.parametrize("split", ["random", "by day"])
def test_any_split_into_files_equals_a_full_run(spark, many_partitions, tmp_path, split):
    rows = awkward_cards(11)
    source, root = f"{tmp_path}/cards", f"{tmp_path}/history"
    r = random.Random(2)
    part = (lambda c: r.randrange(3)) if split == "random" else (lambda c: 0 if (c[3] or "") < "20010718" else 1 if c[3] < "3" else 2)
    parts = [[], [], []]
    for row in rows:
        parts[part(row)].append(row)
    for some in parts:
        store(spark, some, source)
        assert history.load_files(spark, source, root, card_id="cardId") is not None
        assert history.load_files(spark, source, root, card_id="cardId") is None       # nothing new
    assert len(history.current_loads(spark, root)) == 3
    same_as_full(spark, root, rows)
    before = history.stored_sums(spark, root).count()
    assert history.compact(spark, root) and history.compact(spark, root) is None
    assert len(history.current_loads(spark, root)) == 1 and history.stored_sums(spark, root).count() <= before
    same_as_full(spark, root, rows)
    assert len(history.drop_superseded(spark, root)) == 3
    more = awkward_cards(12, 40)
    store(spark, more, source)
    assert history.load_files(spark, source, root, card_id="cardId")
    same_as_full(spark, root, rows + more)


def test_a_changed_file_replaces_what_it_held(spark, tmp_path):
    source, root = f"{tmp_path}/cards", f"{tmp_path}/history"
    store(spark, awkward_cards(1, 60), f"{source}/a")
    store(spark, awkward_cards(2, 60), f"{source}/b")
    first = history.add_slices(read_cards(spark, f"{source}/a", card_id="cardId"), history.card_files(spark, f"{source}/a"), root)
    history.add_slices(read_cards(spark, f"{source}/b", card_id="cardId"), history.card_files(spark, f"{source}/b"), root)
    name, = [n for n in os.listdir(f"{source}/a") if n.endswith(".parquet")]
    store(spark, awkward_cards(3, 70), f"{source}/new")
    other, = [n for n in os.listdir(f"{source}/new") if n.endswith(".parquet")]
    shutil.copy(f"{source}/new/{other}", f"{source}/a/{name}")
    os.remove(f"{source}/a/.{name}.crc")
    assert history.load_files(spark, f"{source}/a", root, card_id="cardId") != first
    same_as_full(spark, root, awkward_cards(3, 70) + awkward_cards(2, 60))


def test_files_of_one_load_are_replaced_together(spark, tmp_path):
    source, root = f"{tmp_path}/cards", f"{tmp_path}/history"
    for i in (1, 2):
        store(spark, awkward_cards(i, 30), source)
    history.load_files(spark, source, root, card_id="cardId")
    cards = read_cards(spark, source, card_id="cardId")
    one = history.card_files(spark, source).orderBy("slice").limit(1).withColumn("stamp", F.lit("other"))
    with pytest.raises(ValueError, match="loaded together"):
        history.add_slices(cards, one, root)
    same_as_full(spark, root, awkward_cards(1, 30) + awkward_cards(2, 30))


def test_a_run_that_failed_leaves_nothing_that_counts(spark, tmp_path, monkeypatch):
    source, root = f"{tmp_path}/cards", f"{tmp_path}/history"
    store(spark, awkward_cards(4, 50), source)
    with monkeypatch.context() as m:
        m.setattr(history, "_enter", lambda *_: (_ for _ in ()).throw(RuntimeError("lost")))
        with pytest.raises(RuntimeError):
            history.load_files(spark, source, root, card_id="cardId")
    assert os.listdir(f"{root}/sums") and history.stored_sums(spark, root).count() == 0
    half = os.listdir(f"{root}/sums")
    assert f"load={history.load_files(spark, source, root, card_id='cardId')}" in half
    same_as_full(spark, root, awkward_cards(4, 50))


def test_days_in_order_never_read_cards_again(spark, tmp_path, monkeypatch):
    """Loads of whole days: the running figure comes from the day states alone."""
    root = f"{tmp_path}/history"
    rows = [c for c in awkward_cards(5) if c[0] is not None and c[3] and c[3][:3] == "200"]
    for i, chosen in enumerate((lambda d: d < "20010715", lambda d: "20010715" <= d < "20010726", lambda d: d >= "20010726")):
        cards = spark.createDataFrame([c for c in rows if chosen(c[3])], model.CARD_FIELDS)
        history.add_slices(normalise_cards(cards, card_id="cardId"), spark.createDataFrame([(f"s{i}", "1")], "slice string, stamp string"), root)
    read, parts = history._read, []
    monkeypatch.setattr(history, "_read", lambda s, r, part, loads: parts.append(part) or read(s, r, part, loads))
    same_as_full(spark, root, rows)
    assert "running" in parts and "scored" not in parts


def test_empty_history_and_cards_without_ids(spark, tmp_path):
    root, source = f"{tmp_path}/history", f"{tmp_path}/cards"
    assert history.stored_sums(spark, root).count() == 0 == history.stored_running(spark, root, SETTINGS.week).count()
    spark.createDataFrame([], model.CARD_FIELDS).write.parquet(source)
    history.load_files(spark, source, root, card_id="cardId")
    assert history.stored_running(spark, root, SETTINGS.week).count() == 0
    store(spark, awkward_cards(6, 20), source)
    history.load_files(spark, source, root)
    with pytest.raises(ValueError, match="without card ids"):
        history.stored_running(spark, root, SETTINGS.week)


def test_bounded_loads_keep_unreadable_days_apart(spark, tmp_path):
    """Four cards, one with an unreadable and one with a null day: counted once however the days are cut."""
    path, rollup = f"{tmp_path}/cards", f"{tmp_path}/rollup"
    cards = [(i, 1, 1, day, [1], [1], [1], [392]) for i, day in enumerate(["20010710", "20010725", "bad", None])]
    store(spark, cards, path)
    nightly.write_rollup(read_cards(spark, path), rollup)
    for day in (date(2001, 7, 20), date(2001, 7, 20), date(2001, 7, 26)):
        new = read_cards(spark, path, day_from=day)
        snap = nightly.snapshot(new, EVERYONE, rollup=nightly.read_rollup(spark, rollup, day))
        assert snap.base.first().answered_num == (4 if day < date(2001, 7, 25) else 4)
        nightly.write_rollup(new, rollup)
        assert nightly.read_rollup(spark, rollup).agg(F.sum("card_num")).first()[0] == 4
    assert nightly.read_rollup(spark, f"{tmp_path}/none", date(2001, 7, 1)).count() == 0
    assert read_cards(spark, path, day_to=date(2001, 7, 31)).count() == 2


def test_command_line_with_rollup_and_running_figure(spark, tmp_path):
    cards, root = f"{tmp_path}/cards", f"{tmp_path}/history"
    knowledge, links = fx.knowledge_tables(spark, SF_DIR)
    knowledge.write.parquet(f"{tmp_path}/knowledge")
    links.write.parquet(f"{tmp_path}/links")
    raw = fx.raw_cards(spark, SF_DIR)
    common = ["--as-of", fx.AS_OF.isoformat(), "--knowledge", f"{tmp_path}/knowledge", "--bridge", f"{tmp_path}/links",
              "--running-right", "cardId"]
    raw.where("cardId % 3 = 0").write.parquet(cards)
    history.load_files(spark, cards, root, card_id="cardId")
    raw.where("cardId % 3 <> 0").write.mode("append").parquet(cards)
    out = f"{tmp_path}/out"
    nightly.main([cards, f"{out}/top", f"{out}/week", f"{out}/total", *common, "--rollup", root])
    full = f"{tmp_path}/full"
    nightly.main([cards, f"{full}/top", f"{full}/week", f"{full}/total", *common])
    for name in ("top", "week", "total"):
        one, other = (spark.read.parquet(f"{folder}/{name}") for folder in (out, full))
        assert one.count() == other.count() > 0 and one.exceptAll(other).isEmpty()
    with pytest.raises(SystemExit):
        nightly.main([cards, "/a", "/b", "/c", *common, "--rollup", root, "--day-from", "2001-07-01"])


def test_filter_of_active_users_goes_before_the_first_sum(spark):
    cards, recent = fx.cards(spark, SF_DIR), fx.cards(spark, SF_DIR, day_from=date(2001, 7, 25))
    settings = SETTINGS.with_(active_days=4)
    assert settings.active_since == date(2001, 7, 25)
    plain, filtered = base_from_cards(cards, settings), base_from_cards(cards, settings, recent=recent)
    lines = filtered._jdf.queryExecution().executedPlan().toString().splitlines()
    assert sorted(filtered.collect()) == sorted(plain.collect()) != []
    at = next(i for i, line in enumerate(lines) if "Filter ((Subquery" in line)
    above = lines[:at]
    assert any("Generate explode" in line for line in above) and sum("Exchange hashpartitioning" in line for line in above) == 2
    scan = next(line for line in lines[at:] if "FileScan" in line and "l_linenumber" in line)
    assert not any("Aggregate" in line and "partial_sum" in line for line in lines[at:]) and "Subquery" in scan
    recent_scan = next(line for line in lines[at:] if "FileScan" in line and "l_linenumber" not in line)
    assert "PushedFilters" in recent_scan and "GreaterThanOrEqual(l_shipdate" in recent_scan
    first_shuffle = lambda df: df.select("user_id").distinct().count()
    from quizlens.operators.bloom import key_filter, might_hold
    users = recent.select("user_id").distinct()
    passed = cards.where(might_hold(key_filter(users, "user_id"), "user_id"))
    assert users.count() == first_shuffle(passed) < first_shuffle(cards)


def test_filter_works_out_its_key_twice(spark):
    """A key's expression stands in the scan as often as its hash does; nine times made the scan's code too long to compile."""
    from quizlens.operators.bloom import key_filter, might_hold
    rows = spark.range(1000).selectExpr("id * 3 AS k")
    passed = rows.where(might_hold(key_filter(rows.where("k % 2 = 0"), "k"), "k"))
    condition = next(line for line in passed._jdf.queryExecution().optimizedPlan().toString().splitlines() if "Filter (" in line)
    assert condition.count("xxhash64") == 2
    assert 500 <= passed.count() < 505


def test_small_and_empty_filters(spark):
    from quizlens.operators.bloom import key_filter, might_hold
    rows = spark.range(1000).selectExpr("IF(id = 0, NULL, id) AS k")
    few = rows.where("k % 10 = 0 OR k IS NULL")
    assert rows.where(might_hold(key_filter(few, "k", 2), "k", 2)).join(few, ["k"], "left_semi").count() == 99
    assert rows.where(might_hold(key_filter(few.limit(0), "k", 64), "k", 64)).count() == 0
    exact = rows.where(might_hold(key_filter(few, "k"), "k"))
    assert 100 <= exact.count() < 105 and exact.where("k IS NULL").count() == 1


def load_in_turn(spark, root, *parts):
    for i, rows in enumerate(parts):
        cards = normalise_cards(spark.createDataFrame(rows, model.CARD_FIELDS), card_id="cardId")
        history.add_slices(cards, spark.createDataFrame([(f"s{i}", "1")], "slice string, stamp string"), root)


def exchanges(df):
    df.collect()
    return str(df._jdf.queryExecution().executedPlan()).split("== Initial Plan ==")[0].count("Exchange")


def test_a_load_and_a_fold_shuffle_once(spark, many_partitions):
    rows = awkward_cards(21)
    cards = normalise_cards(spark.createDataFrame(rows, model.CARD_FIELDS), card_id="cardId")
    answers = explode_answers(cards)
    sums = prefix.daily_rollup_with_states(explode_answers(narrowed(cards).repartition("user_id", "subject", "day")))
    assert exchanges(sums) == 1
    assert sorted(map(str, sums.select(*ROLLUP_KEYS, *MEASURES).collect())) == sorted(
        map(str, daily_rollup(answers).select(*ROLLUP_KEYS, *MEASURES).collect()))
    scored = prefix.scored_cards(answers).groupBy(*prefix.DAY, "card_id").agg(F.sum("right_num").alias("right_num"))
    states = sums.where("point IS NOT NULL").withColumnRenamed("right_num", "s")
    columns = [*prefix.DAY, "n", "s", "q", "first_card", "last_card", "loose"]
    assert sorted(map(str, states.select(columns).collect())) == sorted(
        map(str, prefix.day_states(scored).select(columns).collect()))
    assert exchanges(prefix.point_folds(states.localCheckpoint(), SETTINGS.week)) == 1


def test_compacting_loads_of_different_days_merges_nothing(spark, tmp_path, monkeypatch):
    """Only the days that both loads have are merged, the day of unreadable cards among them."""
    rows = awkward_cards(22)
    early, late = ([c for c in rows if c[3] and c[3][:3] == "200" and (c[3] < "20010720") == first] for first in (True, False))
    merged = []
    merge = history.merge_loads
    monkeypatch.setattr(history, "merge_loads", lambda states, scored: merged.append(states.count()) or merge(states, scored))
    load_in_turn(spark, f"{tmp_path}/apart", early, late)
    assert history.compact(spark, f"{tmp_path}/apart") and merged == [0]
    same_as_full(spark, f"{tmp_path}/apart", early + late)
    bad = [(*c[:3], "bad", *c[4:]) for c in rows[:30]]
    load_in_turn(spark, f"{tmp_path}/bad", early + bad, late + bad)
    assert history.compact(spark, f"{tmp_path}/bad") and merged[1] > 0
    same_as_full(spark, f"{tmp_path}/bad", early + late + bad + bad)


def test_loads_of_the_earlier_layout_are_read(spark, tmp_path):
    """Day states in a folder of their own, as earlier runs stored them."""
    root, rows, more = f"{tmp_path}/history", awkward_cards(23, 80), awkward_cards(24, 60)
    load_in_turn(spark, root, rows)
    load, = history.current_loads(spark, root)
    states = history._read(spark, root, "running", [load])
    states.write.parquet(f"{root}/running/load={load}")
    sums = history.stored_sums(spark, root)
    sums.write.parquet(f"{tmp_path}/sums")
    spark.read.parquet(f"{tmp_path}/sums").write.mode("overwrite").parquet(f"{root}/sums/load={load}")
    same_as_full(spark, root, rows)
    cards = normalise_cards(spark.createDataFrame(more, model.CARD_FIELDS), card_id="cardId")
    history.add_slices(cards, spark.createDataFrame([("more", "1")], "slice string, stamp string"), root)
    same_as_full(spark, root, rows + more)
    assert history.compact(spark, root)
    same_as_full(spark, root, rows + more)


def test_a_load_and_a_fold_sort_once(spark):
    """The load's roll-up and the fold of day states: one sort and one window each, answers summed up once (partial and final)."""
    cards = normalise_cards(spark.createDataFrame(awkward_cards(25, 40), model.CARD_FIELDS), card_id="cardId")
    sums = prefix.daily_rollup_with_states(explode_answers(narrowed(cards).repartition("user_id", "subject", "day")))
    states = sums.where("point IS NOT NULL").withColumnRenamed("right_num", "s").localCheckpoint()

    def steps(df):
        plan = df._jdf.queryExecution().executedPlan().toString()
        return [plan.count(step) for step in ("Sort [", "Window [", "Aggregate(")]

    assert steps(sums) == steps(prefix.point_folds(states, SETTINGS.week)) == [1, 1, 2]
    # A state of one card may come without q, which is its s.
    short = states.withColumn("q", F.when(F.col("n") != 1, F.col("q")))
    assert short.where("q IS NULL AND s > 0").count() > 0
    fold = lambda rows: sorted(map(str, prefix.point_folds(rows, SETTINGS.week).collect()))
    assert fold(short) == fold(states) != []


def test_folds_tell_loads_in_clear_order(spark):
    """Days of two loads: one behind the other, interleaved, touching, with a card without an id, and the unreadable day."""
    day, n = date(2001, 7, 24), [0]

    def state(point, first, last, day=day, loose=False):
        n[0] += 1
        return 1, 1, point, day, 2, n[0], None if first == last else 2 * n[0], first, last, loose

    pairs = {1: [(1, 2), (3, 4)], 2: [(1, 3), (2, 4)], 3: [(1, 2), (2, 3)], 4: [(1, 4), (2, 3)]}
    rows = [state(point, *cards) for point, loads in pairs.items() for cards in loads]
    rows += [state(5, 1, 2), state(5, 3, 4, loose=True), state(6, 1, 2, loose=True), state(6, 3, 4, date(2001, 7, 25))]
    rows += [state(7, 1, 3, None), state(7, 2, 4, None), state(8, 1, 3, None), state(8, 2, 4)]
    schema = "user_id long, subject int, point int, day date, n long, s long, q long, first_card long, last_card long, loose boolean"
    found = {r.point: r for r in prefix.point_folds(spark.createDataFrame(rows, schema), SETTINGS.week).collect()}
    assert {p for p, r in found.items() if r.tangled} == {2, 3, 4, 5, 7}
    # s is 1, 2 and q twice that: 2 + 4 + the later load's two cards times the earlier load's 1.
    assert (found[1].lifetime, found[1].in_week) == (8, 8)
    early, late = rows[-2][5], rows[-1][5]
    assert (found[8].lifetime, found[8].in_week) == (2 * early + 2 * late + 2 * early, 2 * late)
