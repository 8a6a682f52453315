"""Knowledge points per subject, and user contacts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


#: Copies of each subject's lists, so that the rows of a large subject are joined by as many tasks.
LIST_COPIES = 32


def knowledge_subject(knowledge: DataFrame, bridge: DataFrame, level: int = 1) -> DataFrame:
    """Points of one level with their subject.

    Both status conditions belong to the ON clause, so an inactive point, or one without an active link,
    stays as a row of subject 0.
    """
    k, b = knowledge.alias("k"), bridge.alias("b")
    active = (F.col("k.id") == F.col("b.knowledge_id")) & (F.col("k.status") == 1) & (F.col("b.status") == 1)
    return k.where(F.col("k.level") == level).join(b, active, "left").select(
        F.coalesce(F.col("b.subject_id"), F.lit(0)).cast("int").alias("subject"),
        F.col("k.id").alias("point"), F.col("k.name").alias("name"),
    )


def subject_points(points: DataFrame) -> DataFrame:
    """Comma-separated point ids and names per subject, in point order.

    One output row per subject by definition, so it holds what the knowledge dimension holds for it.
    """
    by_point = F.array_sort(F.collect_list(F.struct("point", "name")))
    return points.groupBy("subject").agg(by_point.alias("p")).select(
        "subject",
        F.array_join(F.transform("p", lambda e: e.point.cast("string")), ",").alias("points"),
        F.array_join(F.transform("p", lambda e: F.coalesce(e["name"], F.lit(""))), ",").alias("point_names"),
    )


def attach_subject_points(rows: DataFrame, subject_lists: DataFrame) -> DataFrame:
    """Adds the lists by subject, '' where the subject has none.

    There are few subjects, so rows carry a number by user as well and meet one of the copies of their lists.
    """
    copies = subject_lists.select("*", F.explode(F.sequence(F.lit(0), F.lit(LIST_COPIES - 1))).alias("_copy"))
    salted = rows.withColumn("_copy", F.pmod(F.hash("user_id"), F.lit(LIST_COPIES)))
    return salted.join(copies, ["subject", "_copy"], "left").drop("_copy").withColumns({
        "points": F.coalesce("points", F.lit("")), "point_names": F.coalesce("point_names", F.lit("")),
    })


def user_contacts(users: DataFrame, *order: str) -> DataFrame:
    """One contact per user; of several, the last in ``order``. Phones leave hashed and masked only."""
    last = users.groupBy("user_id").agg(F.max_by("reg_phone", F.struct(*order)).alias("reg_phone"))
    phone = F.col("reg_phone")
    return last.select(
        "user_id",
        F.sha2(phone, 256).alias("phone_hash"),
        F.concat(phone.substr(1, 3), F.lit("****"), F.right(phone, F.lit(4))).alias("phone_masked"),
    )


def attach_contacts(rows: DataFrame, contacts: DataFrame) -> DataFrame:
    """Users grow with the data, so this stays a shuffle join unless the contacts prove small."""
    return rows.join(contacts, "user_id", "left")
