"""What earlier loads of answer cards held, summed up and stored, with a ledger of the slices that were loaded.

A slice is a set of cards that arrives as a whole, by default a file. The ledger names every slice with a stamp (for files
length and time of change) and the load that holds it. A slice in the ledger is never loaded again, whatever days its
cards have; a slice whose stamp has changed takes its load's place together with the other slices of that load. So late
cards, cards without a readable day and repeated runs count exactly once, and the sums equal those of all cards.

    <root>/sums/load=.../       daily sums per (user, subject, day, point); where cards have an id, with the day
                                states of the running figure: right_num is their s, no last_card means the first,
                                no q of one card means s
    <root>/scored/load=.../     right answers of scored cards, by day, not added up; only where cards have an id
    <root>/ledger/              slice, stamp, load, seq, with_cards

Cards are shuffled once, whole, by user, subject and day, and everything stored is made where they lie. The largest group of
that shuffle is one user's one day in one subject; cards without a readable day are one day.

A load is written before its ledger rows are; a folder that no ledger row names is not read. The name of a load follows from
its slices, so a run that is repeated after a failure writes the same folder. There must be one writer at a time.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quizlens.operators.answers import MEASURES, ROLLUP_KEYS, daily_rollup, explode_answers, merge_rollups, narrowed
from quizlens.operators.materialize import materialize
from quizlens.operators.prefix import DAY, daily_rollup_with_states, merge_loads, running_of_loads, scored_cards
from quizlens.sources.cards import normalise_cards

LEDGER = "slice string, stamp string, load string, seq bigint, with_cards boolean"
DAYS = "user_id bigint, subject int, point int, day date"
SCORED = f"{DAYS}, card_id CARD, right_num bigint, load string"
STATE = ("n", "q", "first_card", "last_card", "loose")
STATES = "n bigint, q decimal(38,0), first_card CARD, last_card CARD, loose boolean"
SUMS = f"user_id bigint, subject int, day date, point int, {', '.join(f'{m} bigint' for m in MEASURES)}, load string"


def _folder(spark: SparkSession, path: str):
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), path


def exists(spark: SparkSession, path: str) -> bool:
    fs, at = _folder(spark, path)
    return fs.exists(at)


def ledger(spark: SparkSession, root: str) -> DataFrame:
    """The newest entry of every slice."""
    if not exists(spark, f"{root}/ledger"):
        return spark.createDataFrame([], LEDGER)
    entry = F.struct("seq", "stamp", "load", "with_cards")
    return (
        spark.read.schema(LEDGER).parquet(f"{root}/ledger").groupBy("slice").agg(F.max(entry).alias("e"))
        .select("slice", "e.stamp", "e.load", "e.seq", "e.with_cards"))


def current_loads(spark: SparkSession, root: str) -> dict[str, bool]:
    """Loads that still hold slices, and whether they hold scored cards; one per run since the last compaction."""
    return {r.load: r.with_cards for r in ledger(spark, root).select("load", "with_cards").distinct().collect()}


def _read(spark: SparkSession, root: str, part: str, loads: list[str]) -> DataFrame:
    """The rows of some loads, others are pruned as partitions: ``sums``, ``scored``, ``running`` (day states) or ``both``, sums
    with day states. A state of one card may have no q, which is its s."""

    def of(folder: str, schema: str, chosen: list[str]) -> DataFrame:
        return spark.read.schema(schema).parquet(f"{root}/{folder}").where(F.col("load").isin(chosen))

    if part == "sums":
        return of("sums", SUMS, loads)
    card = spark.read.parquet(f"{root}/scored/load={loads[0]}").schema["card_id"].dataType.simpleString()
    if part == "scored":
        return of("scored", SCORED.replace("CARD", card), loads)
    both, states = f"{STATES}, {SUMS}".replace("CARD", card), STATES.replace("CARD", card)
    if part == "both":
        return of("sums", both, loads).withColumn("last_card", F.coalesce("last_card", "first_card"))
    apart = _apart(spark, root, loads)
    rows = _read(spark, root, "both", loads).where(F.col("point").isNotNull() & ~F.col("load").isin(apart)).select(
        *DAY, F.col("right_num").alias("s"), *STATE)
    return rows.unionByName(of("running", f"{DAYS}, s bigint, {states}, load string", apart).drop("load")) if apart else rows


def _apart(spark: SparkSession, root: str, loads: list[str]) -> list[str]:
    """Loads of the earlier layout, whose day states lie in a folder of their own."""
    return [load for load in loads if exists(spark, f"{root}/running/load={load}")]


def stored_sums(spark: SparkSession, root: str) -> DataFrame:
    """Daily sums of all loads, not yet added up; what ``user_subject_base`` and ``point_stats`` take."""
    loads = list(current_loads(spark, root))
    if not loads:
        return spark.createDataFrame([], SUMS).drop("load")
    return _read(spark, root, "sums", loads).drop("load")


def stored_running(spark: SparkSession, root: str, week: tuple[date, date]) -> DataFrame:
    """The running figure per (user, subject), from day states; scored cards are read only of days whose loads interleave."""
    loads = current_loads(spark, root)
    everyone = stored_sums(spark, root)
    lacking = [load for load, with_cards in loads.items() if not with_cards]
    if lacking:
        raise ValueError(f"loads without card ids have no running figure: {', '.join(sorted(lacking))}")
    if not loads:
        none = F.lit(0).cast("bigint")
        return everyone.select("user_id", "subject").withColumns({"running_right_num": none, "week_running_right_num": none})
    loads = list(loads)
    return running_of_loads(
        _read(spark, root, "running", loads), lambda days: _read(spark, root, "scored", loads).where(_among(days)), everyone, week)


def _among(days: list[date | None]) -> Column:
    readable = [F.lit(d) for d in days if d is not None]
    return F.when(F.col("day").isNull(), F.lit(None in days)).otherwise(F.col("day").isin(readable))


def _write_load(root: str, load: str, sums: DataFrame, scored: DataFrame | None) -> None:
    """Rows are written as they come; those that lie by user, subject, day and point take the least room."""
    short = {"q": F.when(F.col("n") != 1, F.col("q")), "last_card": F.nullif("last_card", "first_card")}
    state = [] if scored is None else [short[c].alias(c) if c in short else c for c in STATE]
    sums.select(*ROLLUP_KEYS, *MEASURES, *state).write.mode("overwrite").parquet(f"{root}/sums/load={load}", compression="zstd")
    if scored is not None:
        scored.select(*DAY, "card_id", "right_num").write.mode("overwrite").parquet(
            f"{root}/scored/load={load}", compression="zstd")


def _enter(slices: DataFrame, root: str, load: str, with_cards: bool) -> None:
    """Ledger rows of a written load; from here on it counts."""
    spark = slices.sparkSession
    last = ledger(spark, root).agg(F.max("seq")).first()[0]
    slices.select(
        "slice", "stamp", F.lit(load).alias("load"), F.lit(0 if last is None else last + 1).cast("bigint").alias("seq"),
        F.lit(with_cards).alias("with_cards")).coalesce(1).write.mode("append").parquet(f"{root}/ledger")


def _name(slices: DataFrame, prefix: str = "") -> str:
    n, mix = slices.agg(F.count(F.lit(1)), F.sum(F.xxhash64("slice", "stamp").cast("decimal(38,0)"))).first()
    return f"{prefix}{n}x{int(mix or 0) % (1 << 64):016x}"


def add_slices(cards: DataFrame, slices: DataFrame, root: str) -> str | None:
    """Load ``cards``, which are all cards of ``slices`` (slice, stamp), and return the load's name.

    Nothing happens where the ledger has all of them with these stamps. Otherwise those it has are replaced, so the other
    slices of their loads must be among ``slices``.
    """
    spark = cards.sparkSession
    slices = materialize(slices.select("slice", "stamp").distinct(), "slices")
    known = ledger(spark, root)
    same = slices.join(known, ["slice", "stamp"], "left_semi").count()
    if same == slices.count():
        return None
    touched = known.join(slices, "slice", "left_semi").select("load").distinct()
    left = known.join(touched, "load", "left_semi").join(slices, "slice", "left_anti").limit(5).collect()
    if left:
        raise ValueError(f"loaded together with slices to replace: {', '.join(r.slice for r in left)}")
    load = _name(slices)
    with_cards = "card_id" in cards.columns
    if with_cards:
        sums = daily_rollup_with_states(explode_answers(narrowed(cards).repartition("user_id", "subject", "day")))
        _write_load(root, load, sums, scored_cards(explode_answers(cards)).sortWithinPartitions("day"))
    else:
        _write_load(root, load, daily_rollup(explode_answers(cards)).sortWithinPartitions(*ROLLUP_KEYS), None)
    _enter(slices, root, load, with_cards)
    return load


def card_files(spark: SparkSession, source: str) -> DataFrame:
    """The files of a card table or folder as slices, by listing only: path, and length with time of change as stamp."""
    raw = spark.read.parquet(source) if "/" in source else spark.table(source)
    files = raw.inputFiles()
    if not files:
        return spark.createDataFrame([], "slice string, stamp string")
    return spark.read.format("binaryFile").load(files).select(
        F.col("path").alias("slice"), F.concat_ws("/", "length", F.unix_micros("modificationTime")).alias("stamp"))


def load_files(spark: SparkSession, source: str, root: str, *, card_id: str | None = None, null_mode: str = "empty") -> str | None:
    """Add the files of ``source`` that the ledger does not have, and no others; the load's name, or None.

    Exactly the listed files are read, so a file that arrives meanwhile waits for the next run. Files that changed are read
    again together with those they were loaded with. Files that are gone stay counted.
    """
    files = materialize(card_files(spark, source), "card-files")
    known = ledger(spark, root)
    fresh = files.join(known, ["slice", "stamp"], "left_anti")
    changed = known.join(fresh, "slice", "left_semi").select("load").distinct()
    mates = known.join(changed, "load", "left_semi").select("slice")
    slices = materialize(files.join(fresh.select("slice").union(mates).distinct(), "slice", "left_semi"), "new-files")
    gone = mates.join(files, "slice", "left_anti").limit(5).collect()
    if gone:
        raise ValueError(f"a file changed that was loaded together with files that are gone: {', '.join(r.slice for r in gone)}")
    paths = [r.slice for r in slices.select("slice").collect()]      # a list of files, as any scan's plan holds
    if not paths:
        return None
    reader = spark.read if "/" not in source else spark.read.option("basePath", source)
    cards = normalise_cards(reader.parquet(*paths), card_id=card_id, null_mode=null_mode)
    return add_slices(cards, slices, root)


def compact(spark: SparkSession, root: str) -> str | None:
    """Put all loads into one. Sums are added up, days become one state each; the ledger gets a new entry per slice.

    Only rows of days that several loads have are shuffled and merged, the others are taken over. At most one row per day of
    the calendar comes to the driver.
    """
    loads = current_loads(spark, root)
    if len(loads) < 2:
        return None
    slices = materialize(ledger(spark, root).select("slice", "stamp"), "slices")
    load, with_cards = _name(slices, "all"), all(loads.values())
    names = list(loads)
    stored = _read(spark, root, "both" if with_cards else "sums", names)
    days = stored.select("day", "load").distinct().groupBy("day").agg(F.count(F.lit(1)).alias("loads"))
    shared = _among([r.day for r in days.where("loads > 1").collect()])
    if with_cards and _apart(spark, root, names):
        shared = F.lit(True)
    sums, scored = merge_rollups(stored.where(shared)), None
    if with_cards:
        scored = _read(spark, root, "scored", names)
        merged = merge_loads(_read(spark, root, "running", names).where(shared), lambda days: scored.where(_among(days)))
        merged = merged.select(*[F.col(c).alias(f"_{c}") for c in DAY], *STATE)
        sums = sums.join(merged, [sums[c].eqNullSafe(merged[f"_{c}"]) for c in DAY], "left")
    columns = [*ROLLUP_KEYS, *MEASURES, *(STATE if with_cards else [])]
    sums = sums.select(columns).sortWithinPartitions(*ROLLUP_KEYS)
    _write_load(root, load, stored.where(~shared).select(columns).unionByName(sums), scored)
    _enter(slices, root, load, with_cards)
    return load


def drop_superseded(spark: SparkSession, root: str) -> list[str]:
    """Delete folders of loads that no slice is in any more, those of runs that failed included; their names."""
    kept = current_loads(spark, root)
    dropped = set()
    for part in ("sums", "scored", "running"):
        fs, at = _folder(spark, f"{root}/{part}")
        for entry in fs.listStatus(at) if fs.exists(at) else []:
            name = entry.getPath().getName()
            if name.startswith("load=") and name[5:] not in kept:
                fs.delete(entry.getPath(), True)
                dropped.add(name[5:])
    return sorted(dropped)
