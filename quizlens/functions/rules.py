"""Score rules as data: which points count for a subject, and with which weights."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

# Fixed values. Subject 1 is scored by weighted accuracy per point.
WEIGHTED_POINTS = {
    1: {392: 20, 435: 40, 482: 15, 642: 40, 754: 20},
}

# Fixed values. The other subjects are scored by pooled accuracy over their points.
POOLED_POINTS = {
    2: [3125, 3195, 3250, 3280, 3298, 3332],
    100100175: [36667, 37098, 37099, 37100, 37101, 37175],
    200100054: [36667, 65836, 65877, 65903, 65904, 65905],
    200100055: [36667, 65836, 65877, 65903, 65904, 65905],
    200100056: [36667, 65836, 65877, 65902, 65903, 65904, 65905, 66089],
    200100057: [36667, 65836, 65877, 65903, 65904, 65905],
}

# Fixed values. Subject 200100056 divides by the answers of 66089 twice and of 65902 never.
DENOMINATOR_WEIGHTS = {
    (200100056, 65902): 0,
    (200100056, 66089): 2,
}

SCORED_SUBJECTS = tuple(sorted([*WEIGHTED_POINTS, *POOLED_POINTS]))


def rule_rows(fix_denominators: bool = False) -> list[tuple[int, int, float | None, int, int]]:
    """(subject, point, share, w_right, w_total); share is null for pooled subjects."""
    overrides = {} if fix_denominators else DENOMINATOR_WEIGHTS
    rows = []
    for subject, weights in WEIGHTED_POINTS.items():
        whole = sum(weights.values())
        rows += [(subject, point, weight / whole, 1, 1) for point, weight in weights.items()]
    for subject, points in POOLED_POINTS.items():
        rows += [(subject, p, None, 1, overrides.get((subject, p), 1)) for p in points]
    return rows


def rule_table(spark: SparkSession, fix_denominators: bool = False) -> DataFrame:
    """One row per (subject, point). A constant of a few dozen rows, so safe to broadcast."""
    values = ", ".join(
        f"({subject}, {point}, {'NULL' if share is None else repr(share) + 'D'}, {w_right}, {w_total})"
        for subject, point, share, w_right, w_total in rule_rows(fix_denominators)
    )
    return spark.sql(
        "SELECT CAST(subject AS INT) AS subject, CAST(point AS INT) AS point, CAST(share AS DOUBLE) AS share, "
        "CAST(w_right AS INT) AS w_right, CAST(w_total AS INT) AS w_total "
        f"FROM VALUES {values} AS t(subject, point, share, w_right, w_total)"
    )


def full_denominator(subject: str, fix_denominators: bool = False) -> str:
    """SQL for the sum of the denominator weights of all points of a subject; null when it has no rules."""
    sums: dict[int, int] = {}
    for code, _, _, _, w_total in rule_rows(fix_denominators):
        sums[code] = sums.get(code, 0) + w_total
    cases = " ".join(f"WHEN {code} THEN {total}" for code, total in sums.items())
    return f"CASE {subject} {cases} END"
