"""Parameters of a run. Nothing reads the clock: ``as_of`` says when "now" is."""

from __future__ import annotations

from dataclasses import dataclass, replace
from datetime import date, datetime, timedelta

from quizlens.functions.calendar import week_bounds, week_label
from quizlens.functions.rules import SCORED_SUBJECTS


@dataclass(frozen=True)
class Settings:
    as_of: datetime
    active_days: int | None = 30        # None keeps users without a recent card
    min_answered: int = 0               # optional floor on lifetime answers
    qualified_score: float = 20.0
    score_gate: int = 120               # fewer answers in the scored points: no total score
    week_min_answered: int = 300        # lifetime answers needed to compete in the week ranking
    week_min_seconds: float = 20.0      # lifetime seconds per question needed for it
    week_needs_answers: bool = True     # drop week rows with nothing answered
    week_time_answered_only: bool = False
    running_right: bool = False         # right answers as a running total per card, as the older aggregate did
    fix_denominators: bool = False      # every scored point of a subject once in its denominator
    sort_by_raw_score: bool = False     # older job: rank on the score itself
    speed_ascending: bool = False       # True ranks the fastest first
    top_k: int = 1000
    totals_subjects: tuple[int, ...] = SCORED_SUBJECTS
    missing_total: str | None = None    # cell text when a subject has no totals
    with_extra_ranks: bool = True       # sort score, fifth rank, subject points, days passed
    legacy_names: bool = False          # original cell labels, swapped score and statistics included

    @property
    def week(self) -> tuple[date, date]:
        return week_bounds(self.as_of)

    @property
    def week_label(self) -> str:
        return week_label(self.as_of)

    @property
    def active_since(self) -> date | None:
        if self.active_days is None:
            return None
        return (self.as_of - timedelta(days=self.active_days)).date()

    def with_(self, **changes) -> "Settings":
        return replace(self, **changes)


def older_job(as_of: datetime) -> Settings:
    """The earlier program: no activity filter, raw scores ranked, four totals, top 10."""
    return Settings(
        as_of=as_of,
        active_days=None,
        week_needs_answers=False,
        sort_by_raw_score=True,
        top_k=10,
        totals_subjects=(1, 2, 3, 100100175),
        missing_total="0",
        with_extra_ranks=False,
    )
