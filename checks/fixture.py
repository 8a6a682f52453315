"""The engine's inputs, derived row by row from the test tables.

Every row of ``lineitem`` is one stored card of up to seven questions. Arrays are built from the row itself, so
the adapter needs no join, no grouping and no shuffle, and lengths differ on purpose.
"""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quizlens.operators.materialize import materialize
from quizlens.settings import Settings
from quizlens.sources.cards import normalise_cards, read_cards

AS_OF = datetime(2001, 7, 29, 12)
SETTINGS = Settings(as_of=AS_OF)

# Subjects by l_orderkey % 7, each with the points its cards ask about.
SUBJECT_POINTS = [
    (1, [392, 435, 482, 642, 754]),
    (2, [3125, 3195, 3250, 3280, 3298, 3332]),
    (200100054, [36667, 65836, 65877, 65903, 65904, 65905]),
    (200100055, [36667, 65836, 65877, 65903, 65904, 65905]),
    (200100056, [36667, 65836, 65877, 65903, 65904, 65905, 66089, 65902]),
    (200100057, [36667, 65836, 65877, 65903, 65904, 65905]),
    (100100175, [36667, 37098, 37099, 37100, 37101, 37175]),
]
MAX_QUESTIONS = 7


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _literal(values: list) -> str:
    return f"array({', '.join(map(str, values))})"


def raw_cards(spark: SparkSession, sf_dir: str, day_from: date | None = None, day_to: date | None = None) -> DataFrame:
    """Cards in the stored form: camelCase names, yyyyMMdd text dates, int arrays. Day bounds reach the scan.

    With i counting from 0 to ``asked`` - 1:
    question = part * 10 % 2147483640 + i; point = the (part + i) % (points + 1)-th of 0 and the subject's points;
    answerTime = (quantity + 7 i) % 40 + userId % 3 * 5; correct = 0 or 3 where (part + 3 i) % 9 is 0 or 1, else
    1 where (7 part + 3 supp + 13 i) % 100 < 35 + userId % 60, else 2. One element is cut from question, correct
    or answerTime where the discount is 3 %, it is 5 %, or the flag is R.
    """
    li = table(spark, sf_dir, "lineitem")
    if day_from is not None:
        li = li.where(F.col("l_shipdate") >= F.lit(day_from).cast("timestamp_ntz"))
    if day_to is not None:
        li = li.where(F.col("l_shipdate") < F.date_add(F.lit(day_to), 1).cast("timestamp_ntz"))

    subjects = _literal([subject for subject, _ in SUBJECT_POINTS])
    # Cycles, so that one slice gives all points, or all times, of a card.
    point_cycles = _literal([_literal(([0, *points] * 3)[: 2 * MAX_QUESTIONS + 2]) for _, points in SUBJECT_POINTS])
    point_num = _literal([len(points) + 1 for _, points in SUBJECT_POINTS])
    time_cycles = _literal([_literal([7 * j % 40 + 5 * k for j in range(40 + MAX_QUESTIONS)]) for k in range(3)])
    correct = ", ".join(
        f"CASE (part + {3 * i}) % 9 WHEN 0 THEN 0 WHEN 1 THEN 3 ELSE IF((luck + {13 * i}) % 100 < ability, 1, 2) END"
        for i in range(MAX_QUESTIONS)
    )
    needed = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_discount", "l_tax",
              "l_returnflag", "l_shipdate"]
    return li.select(*needed).selectExpr(
        "l_orderkey * 8 + l_linenumber AS cardId",
        "(l_suppkey * CAST(round(l_tax * 100) AS BIGINT)) div 8 AS userId",
        "CAST(l_orderkey % 7 AS INT) AS kind",
        "l_linenumber - CAST(l_quantity >= 46 AS INT) AS asked",
        "l_partkey AS part", "l_partkey * 7 + l_suppkey * 3 AS luck", "CAST(l_quantity AS INT) AS quantity",
        "CAST(round(l_discount * 100) AS INT) AS discount", "l_returnflag AS flag",
        "date_format(l_shipdate, 'yyyyMMdd') AS createTime",
    ).selectExpr(
        "*", "35 + userId % 60 AS ability", "CAST(part * 10 % 2147483640 AS INT) AS first_question",
        "greatest(0, asked - CAST(discount = 3 AS INT)) AS question_num",
        "greatest(0, asked - CAST(discount = 5 AS INT)) AS correct_num",
        "greatest(0, asked - CAST(flag = 'R' AS INT)) AS time_num",
    ).selectExpr(
        "cardId", "userId", f"{subjects}[kind] AS subject", "createTime",
        f"slice(sequence(first_question, first_question + {MAX_QUESTIONS - 1}), 1, question_num) AS question",
        f"slice(array({correct}), 1, correct_num) AS correct",
        f"slice({time_cycles}[CAST(userId % 3 AS INT)], quantity * 23 % 40 + 1, time_num) AS answerTime",
        f"slice({point_cycles}[kind], CAST(part % {point_num}[kind] AS INT) + 1, asked) AS point",
    )


_stored: dict[str, str] = {}


def store_cards(spark: SparkSession, sf_dir: str, path: str) -> None:
    """Write the cards of a table folder once; from then on :func:`cards` reads them there."""
    raw_cards(spark, sf_dir).repartition(spark.sparkContext.defaultParallelism, "cardId").write.parquet(path)
    _stored[sf_dir] = path


def cards(spark: SparkSession, sf_dir: str, day_from: date | None = None, day_to: date | None = None) -> DataFrame:
    if sf_dir in _stored:
        return read_cards(spark, _stored[sf_dir], day_from=day_from, day_to=day_to, card_id="cardId")
    return normalise_cards(raw_cards(spark, sf_dir, day_from, day_to), card_id="cardId")


def knowledge_tables(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Knowledge dimension and its links to subjects: the points found in the cards, with the number of times
    they are asked about in the name. Some are of level 2, some inactive."""
    asked = materialize(
        cards(spark, sf_dir).selectExpr("subject", "explode(point) AS point").where("point <> 0")
        .groupBy("subject", "point").agg(F.count(F.lit(1)).alias("asked_num")),
        "asked",
    )
    knowledge = asked.groupBy("point").agg(F.sum("asked_num").alias("asked_num")).selectExpr(
        "CAST(point AS BIGINT) AS id",
        "concat('KP_', point, '_', asked_num % 10) AS name",
        "IF(point % 4 = 0, 2, 1) AS level",
        "IF(point % 5 = 0, 0, 1) AS status",
    )
    links = asked.selectExpr(
        "CAST(point AS BIGINT) AS knowledge_id", "subject AS subject_id",
        "IF((point + subject) % 7 = 0, 0, 1) AS status",
    )
    return knowledge, links


def users(spark: SparkSession, sf_dir: str) -> DataFrame:
    """User dimension: several rows per user, phones made from customer names."""
    digits = F.regexp_extract("c_name", "([0-9]+)$", 1)
    return table(spark, sf_dir, "customer").withColumn("digits", digits).select(
        F.expr("c_custkey div 3 AS user_id"),
        F.expr("concat('138', lpad(digits, greatest(8, length(digits)), '0')) AS reg_phone"),
        F.col("c_custkey").alias("updated"),
    )


def cells(spark: SparkSession, sf_dir: str, row_key: str = "user_id") -> DataFrame:
    """Wide-table cells: one write per event, every fifth to another family. Signups and views hold whole numbers."""
    whole = F.col("event_type").isin("signup", "view")
    return table(spark, sf_dir, "events").select(
        F.expr(row_key).cast("string").alias("row_key"),
        F.when(F.col("event_id") % 5 == 0, "more").otherwise("info").alias("family"),
        F.col("event_type").alias("column"),
        F.expr("timestampdiff(MICROSECOND, timestamp_ntz'1970-01-01 00:00:00', ts)").alias("version"),
        F.col("event_id").alias("seq"),
        F.when(whole, F.floor("value").cast("string")).otherwise(F.col("value").cast("string")).alias("value"),
    )
