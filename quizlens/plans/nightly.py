"""The nightly job: read cards and dimensions, write the total, week and leaderboard tables.

    python -m quizlens.plans.nightly CARDS WEEK_TOP WEEK TOTAL --as-of 2001-07-29T12:00 \\
        --knowledge PATH --bridge PATH
"""

from __future__ import annotations

import argparse
from collections.abc import Sequence
from dataclasses import dataclass
from datetime import date, datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quizlens.operators.answers import MEASURES, ROLLUP_KEYS, daily_rollup, explode_answers
from quizlens.operators.cells import to_cells
from quizlens.operators.knowledge import knowledge_subject, subject_points
from quizlens.operators.materialize import materialize, scratch_run
from quizlens.plans.base import base_from_cards, replace_right, user_subject_base
from quizlens.plans.history import SUMS, exists, load_files, stored_running, stored_sums
from quizlens.plans.week import week_rows
from quizlens.plans.wide import contact_wide, merge_wide, total_wide, week_top_wide, week_wide, write_wide
from quizlens.settings import Settings, older_job
from quizlens.sources.cards import read_cards


@dataclass(frozen=True)
class Snapshot:
    """The shared inputs of all tables, written once and read by each of them."""

    base: DataFrame
    week: DataFrame
    subject_lists: DataFrame | None


def snapshot(
    cards: DataFrame, settings: Settings, points: DataFrame | None = None, rollup: DataFrame | None = None,
    recent: DataFrame | None = None,
) -> Snapshot:
    """``rollup`` holds the days before ``cards``; both are summed up together, once."""
    if rollup is None:
        base = base_from_cards(cards, settings, recent=recent, with_text=True)
    elif settings.running_right:
        raise ValueError("the running figure needs all cards or a history, a roll-up does not tell their order")
    else:
        columns = [*ROLLUP_KEYS, *MEASURES]
        answers = explode_answers(cards).select(columns).unionByName(rollup.select(columns))
        base = user_subject_base(answers, settings, with_text=True)
    return _snapshot_of(base, settings, points)


def _snapshot_of(base: DataFrame, settings: Settings, points: DataFrame | None) -> Snapshot:
    base = materialize(base, "base")
    lists = None if points is None else materialize(subject_points(points), "subject-points")
    return Snapshot(base, week_rows(base, settings), lists)


def history_snapshot(spark: SparkSession, root: str, settings: Settings, points: DataFrame | None = None) -> Snapshot:
    """The shared inputs from a stored history alone; no cards are read, for the running figure neither."""
    base = user_subject_base(stored_sums(spark, root), settings, with_text=True)
    if settings.running_right:
        base = replace_right(base, stored_running(spark, root, settings.week))
    return _snapshot_of(base, settings, points)


def write_rollup(cards: DataFrame, target: str) -> None:
    """Add the days of ``cards`` to the stored roll-up, a folder partitioned by day; days it has are replaced.

    Cards read between day bounds hold no unreadable day, so those stored by a run without bounds stay. Where cards arrive
    late or files are loaded again, ``plans.history`` keeps a ledger instead.
    """
    daily_rollup(explode_answers(cards)).repartitionByRange("day", "user_id").write.mode("overwrite").partitionBy("day").option(
        "partitionOverwriteMode", "dynamic").parquet(target)


def read_rollup(spark: SparkSession, source: str, before: date | None = None) -> DataFrame:
    """The stored days, or those before a day; cards without a readable day are always among them. No folder holds no days."""
    if not exists(spark, source):
        return spark.createDataFrame([], SUMS).drop("load")
    stored = spark.read.parquet(source).withColumn("day", F.col("day").cast("date"))
    return stored if before is None else stored.where((F.col("day") < F.lit(before)) | F.col("day").isNull())


def register_views(snap: Snapshot) -> None:
    """Name the shared inputs for SQL."""
    snap.base.createOrReplaceTempView("user_subject_base")
    snap.week.createOrReplaceTempView("user_subject_week")
    if snap.subject_lists is not None:
        snap.subject_lists.createOrReplaceTempView("subject_points")


def output_tables(snap: Snapshot, settings: Settings) -> dict[str, DataFrame]:
    return {
        "total": total_wide(snap.base, snap.subject_lists, settings),
        "week": week_wide(snap.week, snap.subject_lists, settings),
        "week_top": week_top_wide(snap.week, settings),
    }


def run(
    cards: DataFrame, settings: Settings, targets: dict[str, str], points: DataFrame | None = None,
    contacts: DataFrame | None = None, stored_total: DataFrame | None = None, family: str | None = None,
    rollup: DataFrame | None = None, recent: DataFrame | None = None, **writer,
) -> None:
    """Write the tables named in ``targets`` (total, week, week_top, contact).

    Week tables are partitioned by week and replace their own week only. ``stored_total`` is the previous
    total table, read from another place than its target: its rows of users no longer active are carried over.
    With ``family`` the tables are written as cells of that family, the form key-value stores load. With ``rollup``,
    the stored sums of earlier days, ``cards`` need to hold only the days after it. ``recent``, a scan of the cards since
    the activity bound, keeps users without one out of the first shuffle.
    """
    with scratch_run(cards.sparkSession):
        _write_tables(snapshot(cards, settings, points, rollup, recent), settings, targets, contacts, stored_total, family, writer)


def run_from_history(
    spark: SparkSession, root: str, settings: Settings, targets: dict[str, str], points: DataFrame | None = None,
    contacts: DataFrame | None = None, stored_total: DataFrame | None = None, family: str | None = None, **writer,
) -> None:
    """The same tables from a stored history (see :mod:`quizlens.plans.history`)."""
    with scratch_run(spark):
        _write_tables(history_snapshot(spark, root, settings, points), settings, targets, contacts, stored_total, family, writer)


def _write_tables(
    snap: Snapshot, settings: Settings, targets: dict[str, str], contacts: DataFrame | None, stored_total: DataFrame | None,
    family: str | None, writer: dict,
) -> None:
    tables = output_tables(snap, settings)
    if contacts is not None:
        tables["contact"] = contact_wide(snap.base, contacts, settings)
    if stored_total is not None:
        tables["total"] = merge_wide(stored_total, tables["total"])
    for name, target in targets.items():
        table = tables[name]
        if family is not None:
            table = to_cells(table, family, version=_millis(settings.as_of))
        by_week = name in ("week", "week_top")
        write_wide(table, target, partition={"week": settings.week_label} if by_week else None, **writer)


def _millis(moment: datetime) -> int:
    if moment.tzinfo is None:
        moment = moment.replace(tzinfo=timezone.utc)
    return int(moment.timestamp() * 1000)


def main(argv: Sequence[str] | None = None) -> None:
    parser = argparse.ArgumentParser(description=__doc__, formatter_class=argparse.RawDescriptionHelpFormatter)
    parser.add_argument("cards")
    parser.add_argument("week_top")
    parser.add_argument("week")
    parser.add_argument("total")
    parser.add_argument("--as-of", required=True, type=datetime.fromisoformat)
    parser.add_argument("--knowledge", help="knowledge dimension, path or table")
    parser.add_argument("--bridge", help="knowledge-subject links, path or table")
    parser.add_argument("--older-job", action="store_true", help="totals and ranks of the earlier program")
    parser.add_argument("--day-from", type=date.fromisoformat, help="first card day to read")
    parser.add_argument("--day-to", type=date.fromisoformat, help="last card day to read")
    parser.add_argument("--stored-total", help="previous total table, merged into the new one")
    parser.add_argument("--family", help="write cells of this column family instead of wide rows")
    parser.add_argument("--rollup", help="folder of stored sums: files of CARDS it does not have are added to it, then the "
                        "tables are made from it alone")
    parser.add_argument("--running-right", metavar="CARD_ID", help="count right answers as a running total per card, "
                        "with this column as the cards' identifier")
    parser.add_argument("--fix-denominators", action="store_true")
    parser.add_argument("--legacy-names", action="store_true")
    parser.add_argument("--format", default="parquet")
    args = parser.parse_args(argv)

    spark = SparkSession.builder.appName("quizlens-nightly").getOrCreate()
    settings = older_job(args.as_of) if args.older_job else Settings(as_of=args.as_of)
    settings = settings.with_(legacy_names=args.legacy_names, running_right=args.running_right is not None,
                              fix_denominators=args.fix_denominators)

    def read(source: str) -> DataFrame:
        return spark.read.parquet(source) if "/" in source else spark.table(source)

    points = None
    if settings.with_extra_ranks:
        if not (args.knowledge and args.bridge):
            parser.error("--knowledge and --bridge are needed for the subject points")
        points = knowledge_subject(read(args.knowledge), read(args.bridge))
    targets = {"total": args.total, "week": args.week, "week_top": args.week_top}
    stored = read(args.stored_total) if args.stored_total else None
    if args.rollup:
        if args.day_from or args.day_to:
            parser.error("--rollup takes whole files and knows which are new; it goes without --day-from and --day-to")
        with scratch_run(spark):
            load_files(spark, args.cards, args.rollup, card_id=args.running_right)
        run_from_history(spark, args.rollup, settings, targets, points, stored_total=stored, family=args.family,
                         format=args.format)
        return
    cards = read_cards(spark, args.cards, day_from=args.day_from, day_to=args.day_to, card_id=args.running_right)
    recent = None
    if settings.active_since is not None:
        since = max(settings.active_since, args.day_from or settings.active_since)
        recent = read_cards(spark, args.cards, day_from=since, day_to=args.day_to)
    run(cards, settings, targets, points, stored_total=stored, family=args.family, recent=recent, format=args.format)


if __name__ == "__main__":
    main()
