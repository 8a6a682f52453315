"""One query per operator, over the whole test tables."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from checks import fixture as fx
from quizlens.functions import calendar, score_text
from quizlens.operators import answers as ans
from quizlens.operators import cell_store
from quizlens.operators import cells as cl
from quizlens.operators import knowledge as kn
from quizlens.operators.counting import counting_ranks
from quizlens.operators.materialize import materialize, scratch_folder
from quizlens.operators.ranking import group_ranks, top_rows
from quizlens.operators.running import running_right
from quizlens.plans import base as bs
from quizlens.plans import backfill, history, nightly, sql, totals, week, wide
from quizlens.settings import older_job
from quizlens.sources import cards as src
from quizlens.sources import zones

S = fx.SETTINGS
OLDER = older_job(fx.AS_OF)
RUNNING = S.with_(running_right=True)
CUT_DAY = date(2000, 1, 1)             # stored roll-up before, new cards from here on
CUT_VERSION = 1_705_276_800_000_000    # 2024-01-15, stored cells before, new writes from here on
LOOKUP_FIELDS = {"click": "double", "view": "bigint", "signup": "bigint", "error": "string"}
BACKFILL = ["2001-30", "2001-29", "2001-26", "2000-52"]
BASE_COLUMNS = ["user_id", "subject", "answered_num", "answered_time", "practice_days", "right_num", "undone_num"]


def _answers(spark: SparkSession, sf: str) -> DataFrame:
    return ans.explode_answers(fx.cards(spark, sf))


def _base(spark: SparkSession, sf: str, settings=S, **options) -> DataFrame:
    return bs.base_from_cards(fx.cards(spark, sf), settings, **options)


def _kept_base(spark: SparkSession, sf: str, *columns: str) -> DataFrame:
    return materialize(_base(spark, sf).select("user_id", "subject", *columns), "base")


def _week(spark: SparkSession, sf: str, settings=S) -> DataFrame:
    return week.week_rows(_base(spark, sf, settings), settings)


def _lists(spark: SparkSession, sf: str) -> DataFrame:
    return kn.subject_points(kn.knowledge_subject(*fx.knowledge_tables(spark, sf)))


def _snapshot(spark: SparkSession, sf: str, settings=S) -> nightly.Snapshot:
    points = None
    if settings.with_extra_ranks:
        points = kn.knowledge_subject(*fx.knowledge_tables(spark, sf))
    return nightly.snapshot(fx.cards(spark, sf), settings, points)


def _joined(name: str) -> Column:
    return F.concat_ws(",", F.col(name).cast("array<string>")).alias(name)


# Sources


def cards_scan(spark: SparkSession, sf: str) -> DataFrame:
    """Cards written in their stored form and read again."""
    path = f"{scratch_folder(spark)}/cards-{uuid.uuid4().hex}"
    fx.raw_cards(spark, sf).write.parquet(path)
    return src.read_cards(spark, path, card_id="cardId").select(
        "card_id", "user_id", "subject", F.date_format("day", "yyyy-MM-dd").alias("day"),
        *map(_joined, ("question", "correct", "answer_time", "point")),
    )


def cards_volume(spark: SparkSession, sf: str) -> DataFrame:
    return src.cards_volume(fx.cards(spark, sf)).withColumn("day", F.date_format("day", "yyyy-MM-dd"))


def cards_on_day(spark: SparkSession, sf: str) -> DataFrame:
    day = date(2001, 7, 25)
    return src.cards_on_day(fx.cards(spark, sf, day, day), day).select(
        "card_id", "user_id", "subject", *map(_joined, ("question", "correct", "answer_time", "point"))
    )


def active_users(spark: SparkSession, sf: str) -> DataFrame:
    return bs.active_users(fx.cards(spark, sf, day_from=S.active_since), S)


# Answers, statistics, scores


def point_stats(spark: SparkSession, sf: str) -> DataFrame:
    return ans.point_stats(_answers(spark, sf))


def user_subject_stats(spark: SparkSession, sf: str) -> DataFrame:
    return _base(spark, sf, S.with_(active_days=None)).select(
        *BASE_COLUMNS, F.lit(0).cast("bigint").alias("undo_num"))


def week_stats(spark: SparkSession, sf: str) -> DataFrame:
    everyone = S.with_(active_days=None)
    in_week = fx.cards(spark, sf, *S.week)
    return week.week_rows(bs.base_from_cards(in_week, everyone), everyone).select(
        "user_id", "subject", "week_answered_num", "week_time", "week_right_num", "week_speed", "week_accuracy",
        "week_undo_num", "week_undone_num")


def legacy_running_correct(spark: SparkSession, sf: str) -> DataFrame:
    return running_right(_answers(spark, sf), S.week)


def merge_point_stats(spark: SparkSession, sf: str) -> DataFrame:
    """A stored roll-up of the days before, read again, and the answers of the new days, summed up once."""
    day = F.col("day")
    before = ans.explode_answers(fx.cards(spark, sf).where((day < F.lit(CUT_DAY)) | day.isNull()))
    new = ans.explode_answers(fx.cards(spark, sf, day_from=CUT_DAY))
    return ans.point_stats(materialize(ans.daily_rollup(before), "rollup").unionByName(new, allowMissingColumns=True))


def older_day_total_wide(spark: SparkSession, sf: str) -> DataFrame:
    """The earlier program over the cards of one day, as it ran."""
    day = date(2001, 7, 25)
    cards = src.cards_on_day(fx.cards(spark, sf, day, day), day)
    return wide.total_wide(nightly.snapshot(cards, OLDER).base, None, OLDER)


def running_total_wide(spark: SparkSession, sf: str) -> DataFrame:
    snap = _snapshot(spark, sf, RUNNING)
    return wide.total_wide(snap.base, snap.subject_lists, RUNNING)


def running_week_wide(spark: SparkSession, sf: str) -> DataFrame:
    snap = _snapshot(spark, sf, RUNNING)
    return wide.week_wide(snap.week, snap.subject_lists, RUNNING)


def legacy_week_top_wide(spark: SparkSession, sf: str) -> DataFrame:
    legacy = S.with_(legacy_names=True)
    return wide.week_top_wide(week.week_rows(_base(spark, sf, with_text=True), legacy), legacy)


def active_user_scores(spark: SparkSession, sf: str) -> DataFrame:
    """Scores of the users in a list of active ones that is made apart from the base."""
    users = bs.active_users(fx.cards(spark, sf, day_from=S.active_since), S)
    return bs.semi_join_users(predicted_score(spark, sf), users)


def top_cards(spark: SparkSession, sf: str) -> DataFrame:
    """The thousand cards of each subject that took longest."""
    time = _answers(spark, sf).groupBy("subject", "card_id").agg(F.sum("all_time").alias("card_time"))
    return top_rows(time, F.col("card_time"), S.top_k, tie="card_id")


def predicted_score(spark: SparkSession, sf: str) -> DataFrame:
    return _base(spark, sf, S.with_(active_days=None)).select("user_id", "subject", "score", "sort_score")


def week_predicted_score(spark: SparkSession, sf: str) -> DataFrame:
    return _base(spark, sf, S.with_(active_days=None)).select("user_id", "subject", "week_score")


def active_total(spark: SparkSession, sf: str) -> DataFrame:
    return _base(spark, sf).select(*BASE_COLUMNS, "score")


def encode_score_string(spark: SparkSession, sf: str) -> DataFrame:
    return score_text.encode(point_stats(spark, sf), ["user_id", "subject"])


def decode_score_string(spark: SparkSession, sf: str) -> DataFrame:
    return score_text.decode(encode_score_string(spark, sf), "point_stats")


# Lifetime and week results


def subject_totals(spark: SparkSession, sf: str) -> DataFrame:
    return totals.subject_totals(_base(spark, sf), S)


def week_subject_totals(spark: SparkSession, sf: str) -> DataFrame:
    return week.week_subject_totals(_week(spark, sf), S)


def days_histogram(spark: SparkSession, sf: str) -> DataFrame:
    return totals.days_histogram(_base(spark, sf))


def days_pass_count(spark: SparkSession, sf: str) -> DataFrame:
    return totals.days_pass_count(_kept_base(spark, sf, "practice_days"))


def total_ranks(spark: SparkSession, sf: str) -> DataFrame:
    base = _kept_base(spark, sf, "score", "sort_score", "practice_days", "answered_time", "answered_num")
    return group_ranks(base, totals.total_rank_keys(S))


def week_ranks(spark: SparkSession, sf: str) -> DataFrame:
    rows = _week(spark, sf).select(
        "user_id", "subject", "week_score", "week_sort_score", "week_answered_num", "week_speed", "week_accuracy")
    return group_ranks(materialize(rows, "week"), week.week_rank_keys(S))


def counted_total_ranks(spark: SparkSession, sf: str) -> DataFrame:
    base = _kept_base(spark, sf, "score", "sort_score", "practice_days", "answered_time", "answered_num")
    return counting_ranks(base, totals.total_rank_keys(S))


def counted_week_ranks(spark: SparkSession, sf: str) -> DataFrame:
    rows = _week(spark, sf).select(
        "user_id", "subject", "week_score", "week_sort_score", "week_answered_num", "week_speed", "week_accuracy")
    return counting_ranks(materialize(rows, "week"), week.week_rank_keys(S))


def total_top(spark: SparkSession, sf: str) -> DataFrame:
    return totals.total_top(_base(spark, sf), S).select("user_id", "subject", "sort_score", "rank")


def week_top(spark: SparkSession, sf: str) -> DataFrame:
    return week.week_top(_week(spark, sf), S.with_(top_k=10)).select(
        "user_id", "subject", "week_score", "week_sort_score", "week_answered_num", "week_time", "rank")


# Dimensions


def knowledge_subject(spark: SparkSession, sf: str) -> DataFrame:
    return kn.knowledge_subject(*fx.knowledge_tables(spark, sf))


def subject_points(spark: SparkSession, sf: str) -> DataFrame:
    return _lists(spark, sf)


def subject_points_enrich(spark: SparkSession, sf: str) -> DataFrame:
    return kn.attach_subject_points(
        _base(spark, sf).select("user_id", "subject", "score"), materialize(_lists(spark, sf), "subject-points"))


def user_contact_enrich(spark: SparkSession, sf: str) -> DataFrame:
    rows = _base(spark, sf).select("user_id", "subject", "score")
    return kn.attach_contacts(rows, kn.user_contacts(fx.users(spark, sf), "updated"))


def total_with_subject_totals(spark: SparkSession, sf: str) -> DataFrame:
    base = _kept_base(spark, sf, "score", "answered_num", "answered_time", "right_num", "undone_num")
    columns = ["user_count", "qualified_user_count", "question_count", "time_total", "right_total", "undo_total"]
    return totals.attach_totals(base.select("user_id", "subject", "score"), totals.subject_totals(base, S), columns)


# Wide tables


def total_wide(spark: SparkSession, sf: str) -> DataFrame:
    snap = _snapshot(spark, sf)
    return wide.total_wide(snap.base, snap.subject_lists, S)


def week_wide(spark: SparkSession, sf: str) -> DataFrame:
    snap = _snapshot(spark, sf)
    return wide.week_wide(snap.week, snap.subject_lists, S)


def week_top_wide(spark: SparkSession, sf: str) -> DataFrame:
    rows = week.week_rows(_base(spark, sf, with_text=True), S)
    return wide.week_top_wide(rows, S)


def older_total_wide(spark: SparkSession, sf: str) -> DataFrame:
    return wide.total_wide(_snapshot(spark, sf, OLDER).base, None, OLDER)


def older_week_wide(spark: SparkSession, sf: str) -> DataFrame:
    return wide.week_wide(_snapshot(spark, sf, OLDER).week, None, OLDER)


def older_week_top_wide(spark: SparkSession, sf: str) -> DataFrame:
    rows = week.week_rows(_base(spark, sf, OLDER, with_text=True), OLDER)
    return wide.week_top_wide(rows, OLDER)


def contact_total_wide(spark: SparkSession, sf: str) -> DataFrame:
    contacts = kn.user_contacts(fx.users(spark, sf), "updated")
    return wide.contact_wide(_base(spark, sf, with_text=True), contacts, S)


def rowkey_range(spark: SparkSession, sf: str) -> DataFrame:
    """Newest cells as rows, keys from '2' up to but excluding '6' in byte order."""
    rows = cl.newest_rows(fx.cells(spark, sf), "info", dict.fromkeys(LOOKUP_FIELDS | {"purchase": ""}, "string"))
    return cl.scan_rows(rows, "2", "6", ["click", "purchase"])


def typed_lookup(spark: SparkSession, sf: str) -> DataFrame:
    keys = fx.table(spark, sf, "customer").where(F.col("c_acctbal") > 0).select(
        F.col("c_custkey").cast("string").alias("row_key"))
    return cl.typed_lookup(fx.cells(spark, sf), keys, "info", LOOKUP_FIELDS)


def cell_upsert(spark: SparkSession, sf: str) -> DataFrame:
    cells = fx.cells(spark, sf)
    stored = cells.where(F.col("version") < CUT_VERSION)
    return cl.upsert_cells(stored, cells.where(F.col("version") >= CUT_VERSION))


def key_delete(spark: SparkSession, sf: str) -> DataFrame:
    gone = fx.table(spark, sf, "customer").where(F.col("c_acctbal") < 0).select(
        F.col("c_custkey").cast("string").alias("row_key"))
    return cl.delete_rows(fx.cells(spark, sf), gone)


def version_retention(spark: SparkSession, sf: str) -> DataFrame:
    """Cells with some hundred versions each, of which the newest stay."""
    return cl.keep_versions(fx.cells(spark, sf, "user_id % 10"), 24)


def version_retention_short(spark: SparkSession, sf: str) -> DataFrame:
    return cl.keep_versions(fx.cells(spark, sf), 10)


# Calendar and counts


def calendar_features(spark: SparkSession, sf: str) -> DataFrame:
    events = fx.table(spark, sf, "events").select(
        F.lit("events").alias("source"), F.col("event_id").alias("id"), "ts",
        F.expr("trim(TRAILING '}' FROM ltrim(substring_index(props, ':', -1)))").alias("text"))
    orders = fx.table(spark, sf, "orders").select(
        F.lit("orders").alias("source"), F.col("o_orderkey").alias("id"), F.col("o_orderdate").alias("ts"),
        F.col("o_orderpriority").alias("text"))
    rows = calendar.calendar_features(events.unionByName(orders), "ts", add_days=10, number_text="text")
    return rows.drop("ts", "text").withColumns({
        "compact_again": calendar.compact_from_dashed(F.col("day_dashed")),
        "dashed_again": calendar.dashed_from_compact(F.col("day_compact")),
    })


# Stored forms


def _stored_history(spark: SparkSession, sf: str) -> str:
    """Cards arriving as files in three runs, late ones among them; every run is repeated, two are put together."""
    folder = f"{scratch_folder(spark)}/history-{uuid.uuid4().hex}"
    raw = fx.raw_cards(spark, sf)
    late = "cardId % 11 = 0"
    early = f"createTime < '{CUT_DAY:%Y%m%d}'"
    for i, arriving in enumerate([f"{early} AND NOT {late}", f"NOT {early} AND NOT {late}", late]):
        raw.where(arriving).write.mode("append").parquet(f"{folder}/cards", compression="zstd")
        for _ in range(2):
            history.load_files(spark, f"{folder}/cards", f"{folder}/history", card_id="cardId")
        if i == 1:
            history.compact(spark, f"{folder}/history")
    return f"{folder}/history"


def history_point_stats(spark: SparkSession, sf: str) -> DataFrame:
    return ans.point_stats(history.stored_sums(spark, _stored_history(spark, sf)))


def history_user_stats(spark: SparkSession, sf: str) -> DataFrame:
    """Figures and the running figure from stored sums and day states alone."""
    root = _stored_history(spark, sf)
    base = bs.user_subject_base(history.stored_sums(spark, root), S)
    return bs.replace_right(base, history.stored_running(spark, root, S.week)).select(*BASE_COLUMNS, "week_right_num", "score")


def filtered_active_total(spark: SparkSession, sf: str) -> DataFrame:
    """As ``active_total``, with a filter of active users in the scan of all cards."""
    recent = fx.cards(spark, sf, day_from=S.active_since)
    return _base(spark, sf, recent=recent).select(*BASE_COLUMNS, "score")


def cards_of_user(spark: SparkSession, sf: str) -> DataFrame:
    """Cards of one user and subject within a year."""
    year = date(2000, 1, 1), date(2000, 12, 31)
    return src.cards_on_day(fx.cards(spark, sf, *year), *year, user_id=0, subject=1).select(
        "card_id", "user_id", "subject", *map(_joined, ("question", "correct", "answer_time", "point")))


def min_answered_total(spark: SparkSession, sf: str) -> DataFrame:
    return _base(spark, sf, S.with_(min_answered=200)).select(*BASE_COLUMNS, "score")


def _weeks(spark: SparkSession, sf: str) -> DataFrame:
    return backfill.weeks_rows(_answers(spark, sf), [calendar.moment_of(label) for label in BACKFILL], S)


def backfill_weeks(spark: SparkSession, sf: str) -> DataFrame:
    """Week figures of four weeks, given by label, from one pass."""
    return _weeks(spark, sf).drop("week_undo_num")


def backfill_ranks(spark: SparkSession, sf: str) -> DataFrame:
    rows = _weeks(spark, sf).select("week", "user_id", "subject", "week_score", "week_sort_score", "week_answered_num",
                                    "week_speed", "week_accuracy")
    return backfill.weeks_ranks(materialize(rows, "weeks"), S)


def stored_weeks(spark: SparkSession, sf: str) -> DataFrame:
    """Two weeks written as partitions, one of them first with rows that its second writing replaces; both read back."""
    path = f"{scratch_folder(spark)}/weeks-{uuid.uuid4().hex}"
    rows = materialize(_weeks(spark, sf).selectExpr(
        "concat_ws('-', user_id, subject) AS row_key", "week", "CAST(week_answered_num AS STRING) AS answered"), "weeks")
    for label, chosen in [(BACKFILL[0], "answered > '2'"), (BACKFILL[1], "true"), (BACKFILL[0], "true")]:
        wide.write_wide(rows.where((F.col("week") == label) & F.expr(chosen)).drop("week"), path, partition={"week": label})
    return spark.read.parquet(path)


def zone_range(spark: SparkSession, sf: str) -> DataFrame:
    """As ``rowkey_range``, over a stored table whose zone map tells which files to open."""
    path = f"{scratch_folder(spark)}/wide-{uuid.uuid4().hex}"
    rows = cl.newest_rows(fx.cells(spark, sf), "info", dict.fromkeys(LOOKUP_FIELDS | {"purchase": ""}, "string"))
    wide.write_wide(rows, path)
    zones.write_zones(spark, path)
    return zones.scan_range(spark, path, "2", "6", ["click", "purchase"])


def store_maintenance(spark: SparkSession, sf: str) -> DataFrame:
    """Cells in a bucketed store: later writes applied, then the rows of some keys taken out."""
    name = f"cells_{uuid.uuid4().hex}"
    cells = fx.cells(spark, sf)
    cell_store.create_store(cells.where(F.col("version") < CUT_VERSION), name, shards=16, buckets=4,
                            path=f"{scratch_folder(spark)}/{name}")
    cell_store.upsert_store(spark, name, cells.where(F.col("version") >= CUT_VERSION))
    gone = fx.table(spark, sf, "customer").where(F.col("c_acctbal") < 0).select(
        F.col("c_custkey").cast("string").alias("row_key"))
    cell_store.delete_from_store(spark, name, gone)
    return spark.table(name).drop("shard")


def sql_subject_report(spark: SparkSession, sf: str) -> DataFrame:
    """SQL text with named parameters over the named results of a run."""
    return sql.ask(_snapshot(spark, sf), sql.SUBJECT_REPORT, floor=30.0, days=3, subject=None)


def string_count(spark: SparkSession, sf: str) -> DataFrame:
    return ans.row_count(fx.table(spark, sf, "orders"), "o_orderpriority")


ALL = [
    cards_scan, cards_volume, cards_on_day, active_users,
    point_stats, user_subject_stats, week_stats, legacy_running_correct, merge_point_stats,
    predicted_score, week_predicted_score, active_total, encode_score_string, decode_score_string,
    subject_totals, week_subject_totals, days_histogram, days_pass_count,
    total_ranks, week_ranks, counted_total_ranks, counted_week_ranks, total_top, week_top,
    knowledge_subject, subject_points, subject_points_enrich, user_contact_enrich, total_with_subject_totals,
    total_wide, week_wide, week_top_wide, older_total_wide, older_week_wide, older_week_top_wide,
    contact_total_wide, older_day_total_wide, running_total_wide, running_week_wide, legacy_week_top_wide,
    active_user_scores, top_cards,
    rowkey_range, typed_lookup, cell_upsert, key_delete, version_retention, version_retention_short,
    calendar_features, string_count,
    history_point_stats, history_user_stats, filtered_active_total, cards_of_user, min_answered_total,
    backfill_weeks, backfill_ranks, stored_weeks, zone_range, store_maintenance, sql_subject_report,
]


def registry() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {query.__name__: query for query in ALL}
