"""Plain-Python answer to what the engine computes, card by card."""

from __future__ import annotations

from collections import defaultdict
from datetime import date, datetime, timedelta

from quizlens.functions.rules import rule_rows

CARD_FIELDS = "cardId bigint, userId bigint, subject int, createTime string, question array<int>, " \
              "correct array<int>, answerTime array<int>, point array<int>"


def run(cards: list[tuple], week: tuple[date, date]) -> dict[tuple[int, int], dict]:
    """cards: (card_id, user, subject, yyyymmdd, question, correct, time, point)."""
    out: dict[tuple[int, int], dict] = {}
    for _, user, subject, created, questions, corrects, times, points in sorted(cards, key=lambda c: (c[3], c[0])):
        g = out.setdefault((user, subject), {
            "points": defaultdict(lambda: [0, 0, 0]), "week_points": defaultdict(lambda: [0, 0, 0]), "days": set(),
            "answered": 0, "time": 0, "week_answered": 0, "week_time": 0, "running": 0, "week_running": 0,
            "undone": 0})
        day = datetime.strptime(created, "%Y%m%d").date()
        in_week = week[0] <= day <= week[1]
        g["days"].add(day)
        touched = set()
        for point, correct, time in zip(points or [], corrects or [], times or []):
            if point and correct in (1, 2):
                touched.add(point)
                for stats in [g["points"]] + [g["week_points"]] * in_week:
                    stats[point][0] += correct == 1
                    stats[point][1] += 1
                    stats[point][2] += time
        g["running"] += sum(g["points"][p][0] for p in touched)
        if in_week:
            g["week_running"] += sum(g["week_points"][p][0] for p in touched)
        answered = sum(c in (1, 2) for _, c in zip(questions or [], corrects or []))
        g["answered"] += answered
        g["time"] += sum(t for t, c in zip(times or [], corrects or []) if c in (1, 2))
        g["undone"] += sum(c not in (1, 2) for c in corrects or [])
        if in_week:
            g["week_answered"] += answered
            g["week_time"] += sum(times or [])
    return out


def score(points: dict[int, list[int]], subject: int, gate: int | None) -> float:
    rules = [r for r in rule_rows() if r[0] == subject]
    if not rules:
        return 0.0
    seen = {p: points[p] if p in points else [0, 1] for _, p, *_ in rules}
    tries = sum(w_total * seen[p][1] for _, p, _, _, w_total in rules)
    if gate is not None and tries < gate:
        return 0.0
    if rules[0][2] is not None:
        return 100 * sum(share * seen[p][0] / seen[p][1] for _, p, share, _, _ in rules)
    return 100 * sum(seen[p][0] for _, p, *_ in rules) / tries


def text(points: dict[int, list[int]]) -> str:
    return "_".join(f"{p}:{r}:{n}:{t}:0" for p, (r, n, t) in sorted(points.items()))


def days_before(day: date, n: int) -> date:
    return day - timedelta(days=n)
