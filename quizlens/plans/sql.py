"""The shared results of a run by name, for SQL text with named parameters."""

from __future__ import annotations

from pyspark.sql import DataFrame

from quizlens.plans.nightly import Snapshot, register_views

#: Best users of a subject with what they practised in the week and the points the subject asks about.
SUBJECT_REPORT = """
SELECT b.user_id, b.subject, b.score, b.practice_days, w.week_answered_num, w.week_score, p.points
FROM user_subject_base AS b
LEFT JOIN user_subject_week AS w ON w.user_id = b.user_id AND w.subject = b.subject
LEFT JOIN subject_points AS p ON p.subject = b.subject
WHERE b.score >= :floor AND b.practice_days >= :days AND (:subject IS NULL OR b.subject = :subject)"""


def ask(snap: Snapshot, text: str, **parameters) -> DataFrame:
    """The answer to SQL over ``user_subject_base``, ``user_subject_week`` and, where the run has them, ``subject_points``.

    Values go in as parameters and are never put into the text. A name that the text does not use is an error, as is one that
    it uses and that is not given.
    """
    unused = [name for name in parameters if f":{name}" not in text]
    if unused:
        raise ValueError(f"parameters the text does not use: {', '.join(unused)}")
    register_views(snap)
    return snap.base.sparkSession.sql(text, args=parameters)
