"""The same results as plain SQL over the test tables, written row by row and without arrays.

Missing scored points, week sums and ranks are spelled out the long way here (outer joins on the full rule list,
plain windows), so that agreement says something about the shorter ways the engine takes.
"""

from __future__ import annotations

from checks.fixture import MAX_QUESTIONS, SUBJECT_POINTS

# Fixed values, apart from the engine's: the week of 2001-07-29 12:00, 30 days before, and the score rules.
MONDAY, SUNDAY, LABEL = "2001-07-23", "2001-07-29", "2001-30"
ACTIVE_SINCE = "2001-06-29"
WEIGHTED = [(1, 392, 20), (1, 435, 40), (1, 482, 15), (1, 642, 40), (1, 754, 20)]
POOLED = [
    (2, 3125), (2, 3195), (2, 3250), (2, 3280), (2, 3298), (2, 3332),
    (200100054, 36667), (200100054, 65836), (200100054, 65877), (200100054, 65903), (200100054, 65904), (200100054, 65905),
    (200100055, 36667), (200100055, 65836), (200100055, 65877), (200100055, 65903), (200100055, 65904), (200100055, 65905),
    (200100056, 36667), (200100056, 65836), (200100056, 65877), (200100056, 65903), (200100056, 65904), (200100056, 65905),
    (200100056, 65902), (200100056, 66089),
    (200100057, 36667), (200100057, 65836), (200100057, 65877), (200100057, 65903), (200100057, 65904), (200100057, 65905),
    (100100175, 36667), (100100175, 37098), (100100175, 37099), (100100175, 37100), (100100175, 37101), (100100175, 37175),
]
TWICE, NEVER = (200100056, 66089), (200100056, 65902)     # in the denominator


def _pick(kind: str, values: list) -> str:
    return f"CASE {kind} " + " ".join(f"WHEN {i} THEN {v}" for i, v in enumerate(values)) + " END"


_POINT = _pick("kind", [
    "CASE place " + " ".join(f"WHEN {j} THEN {p}" for j, p in enumerate([0, *points])) + " END"
    for _, points in SUBJECT_POINTS
])

CTES: dict[str, tuple[list[str], str]] = {}


def _cte(name: str, needs: list[str], sql: str) -> None:
    CTES[name] = (needs, sql)


_cte("card", [], f"""
  SELECT *, {_pick('kind', [s for s, _ in SUBJECT_POINTS])} AS subject
  FROM (
    SELECT l_orderkey * 8 + l_linenumber AS card_id, l_orderkey % 7 AS kind,
           (l_suppkey * CAST(round(l_tax * 100) AS BIGINT)) // 8 AS user_id,
           CAST(l_shipdate AS DATE) AS day, l_partkey AS part, l_suppkey AS supp,
           CAST(l_quantity AS BIGINT) AS quantity,
           l_linenumber - CASE WHEN l_quantity >= 46 THEN 1 ELSE 0 END AS asked,
           CASE WHEN round(l_discount * 100) = 3 THEN 1 ELSE 0 END AS question_cut,
           CASE WHEN round(l_discount * 100) = 5 THEN 1 ELSE 0 END AS correct_cut,
           CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END AS time_cut
    FROM lineitem) AS c""")

# One row per array position; columns are null past the end of their array.
_cte("item", ["card"], f"""
  SELECT card_id, user_id, subject, day, i,
         CASE WHEN i < asked - question_cut THEN part * 10 % 2147483640 + i END AS question,
         CASE WHEN i < asked - correct_cut THEN
           CASE WHEN (part + 3 * i) % 9 = 0 THEN 0
                WHEN (part + 3 * i) % 9 = 1 THEN 3
                WHEN (7 * part + 3 * supp + 13 * i) % 100 < 35 + user_id % 60 THEN 1
                ELSE 2 END END AS correct,
         CASE WHEN i < asked - time_cut THEN (quantity + 7 * i) % 40 + user_id % 3 * 5 END AS answer_time,
         {_POINT} AS point
  FROM (SELECT card.*, n.i, (part + n.i) % {_pick('kind', [len(p) + 1 for _, p in SUBJECT_POINTS])} AS place
        FROM card, (SELECT unnest(range({MAX_QUESTIONS})) AS i) AS n
        WHERE n.i < card.asked) AS x""")

_cte("hit", ["item"], """
  SELECT card_id, user_id, subject, day, point, answer_time, CASE WHEN correct = 1 THEN 1 ELSE 0 END AS is_right
  FROM item WHERE correct IN (1, 2) AND answer_time IS NOT NULL AND point <> 0""")

_cte("point_stats", ["hit"], """
  SELECT user_id, subject, point, CAST(sum(is_right) AS BIGINT) AS right_num, count(*) AS total_num,
         CAST(sum(answer_time) AS BIGINT) AS time_sum
  FROM hit GROUP BY ALL""")

_cte("week_point_stats", ["hit"], f"""
  SELECT user_id, subject, point, CAST(sum(is_right) AS BIGINT) AS right_num, count(*) AS total_num,
         CAST(sum(answer_time) AS BIGINT) AS time_sum
  FROM hit WHERE day BETWEEN DATE '{MONDAY}' AND DATE '{SUNDAY}' GROUP BY ALL""")

_cte("card_stats", ["card"], """
  SELECT user_id, subject, count(DISTINCT day) AS practice_days FROM card GROUP BY ALL""")

_cte("item_stats", ["item"], """
  SELECT user_id, subject,
         count(*) FILTER (WHERE correct IN (1, 2) AND question IS NOT NULL) AS answered_num,
         coalesce(sum(answer_time) FILTER (WHERE correct IN (1, 2)), 0) AS answered_time,
         count(*) FILTER (WHERE correct NOT IN (1, 2)) AS undone_num,
         count(*) FILTER (WHERE correct = 1 AND answer_time IS NOT NULL AND point <> 0) AS right_num
  FROM item GROUP BY ALL""")

_cte("week_item_stats", ["item"], f"""
  SELECT user_id, subject,
         count(*) FILTER (WHERE correct IN (1, 2) AND question IS NOT NULL) AS answered_num,
         coalesce(sum(answer_time), 0) AS all_time,
         count(*) FILTER (WHERE correct NOT IN (1, 2)) AS undone_num,
         count(*) FILTER (WHERE correct = 1 AND answer_time IS NOT NULL AND point <> 0) AS right_num
  FROM item WHERE day BETWEEN DATE '{MONDAY}' AND DATE '{SUNDAY}' GROUP BY ALL""")

_RULES = ", ".join([f"({s}, {p}, {w / 135!r}, 1, 1)" for s, p, w in WEIGHTED] + [
    f"({s}, {p}, NULL, 1, {2 if (s, p) == TWICE else 0 if (s, p) == NEVER else 1})" for s, p in POOLED])
_cte("rule", [], f"""
  SELECT * FROM (VALUES {_RULES}) AS r(subject, point, share, w_right, w_total)""")


def _score(stats: str, gate: bool) -> str:
    value = """round(CASE WHEN min(share) IS NULL
      THEN CAST(sum(w_right * coalesce(right_num, 0)) AS DOUBLE) / CAST(sum(w_total * coalesce(total_num, 1)) AS DOUBLE)
      ELSE sum(CAST(share AS DOUBLE) * CAST(coalesce(right_num, 0) AS DOUBLE) / CAST(coalesce(total_num, 1) AS DOUBLE))
      END * 100, 6)"""
    if gate:
        value = f"CASE WHEN sum(w_total * coalesce(total_num, 1)) < 120 THEN 0.0 ELSE {value} END"
    return f"""
  SELECT c.user_id, c.subject, {value} AS score
  FROM card_stats AS c JOIN rule AS r USING (subject)
  LEFT JOIN {stats} AS p ON p.user_id = c.user_id AND p.subject = c.subject AND p.point = r.point
  GROUP BY c.user_id, c.subject"""


_cte("total_score", ["card_stats", "rule", "point_stats"], _score("point_stats", True))
_cte("week_score", ["card_stats", "rule", "week_point_stats"], _score("week_point_stats", False))

_cte("running", ["hit", "card_stats"], f"""
  SELECT user_id, subject, coalesce(running_right_num, 0) AS running_right_num,
         coalesce(week_running_right_num, 0) AS week_running_right_num
  FROM card_stats LEFT JOIN (
SELECT user_id, subject, CAST(sum(so_far) AS BIGINT) AS running_right_num,
       CAST(coalesce(sum(week_so_far) FILTER (WHERE in_week), 0) AS BIGINT) AS week_running_right_num
FROM (SELECT user_id, subject, in_week,
             sum(c) OVER (PARTITION BY user_id, subject, point ORDER BY day, card_id
                          ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS so_far,
             sum(CASE WHEN in_week THEN c ELSE 0 END) OVER (PARTITION BY user_id, subject, point ORDER BY day, card_id
                          ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS week_so_far
      FROM (SELECT user_id, subject, point, day, card_id, sum(is_right) AS c,
                   day BETWEEN DATE '{MONDAY}' AND DATE '{SUNDAY}' AS in_week
            FROM hit GROUP BY ALL) AS x) AS y
GROUP BY user_id, subject) AS r USING (user_id, subject)""")

_cte("everyone", ["card_stats", "item_stats", "week_item_stats", "total_score", "week_score"], """
  SELECT c.user_id, c.subject, c.practice_days,
         coalesce(i.answered_num, 0) AS answered_num, CAST(coalesce(i.answered_time, 0) AS BIGINT) AS answered_time,
         coalesce(i.undone_num, 0) AS undone_num, coalesce(i.right_num, 0) AS right_num,
         coalesce(w.answered_num, 0) AS week_answered_num, CAST(coalesce(w.all_time, 0) AS BIGINT) AS week_time,
         coalesce(w.undone_num, 0) AS week_undone_num, coalesce(w.right_num, 0) AS week_right_num,
         t.score, CASE WHEN t.score < 20 THEN 0.0 ELSE t.score END AS sort_score, s.score AS week_score
  FROM card_stats AS c
  LEFT JOIN item_stats AS i USING (user_id, subject)
  LEFT JOIN week_item_stats AS w USING (user_id, subject)
  LEFT JOIN total_score AS t USING (user_id, subject)
  LEFT JOIN week_score AS s USING (user_id, subject)""")

_cte("active", ["card"], f"SELECT DISTINCT user_id FROM card WHERE day >= DATE '{ACTIVE_SINCE}'")

_cte("base", ["everyone", "active"], "SELECT * FROM everyone WHERE user_id IN (SELECT user_id FROM active)")


def _week_rows(source: str, guard: bool) -> str:
    sort = """CASE WHEN answered_num < 300 OR CAST(answered_time AS DOUBLE) / answered_num < 20 THEN 0.0
              ELSE week_score END""" if guard else "week_score"
    where = "WHERE week_answered_num > 0" if guard else ""
    return f"""
  SELECT user_id, subject, week_score, week_answered_num, week_time, week_right_num,
         round(CAST(week_time AS DOUBLE) / nullif(week_answered_num, 0), 6) AS week_speed,
         round(CAST(week_right_num AS DOUBLE) / nullif(week_answered_num, 0), 6) AS week_accuracy,
         CAST(0 AS BIGINT) AS week_undo_num, week_undone_num, {sort} AS week_sort_score
  FROM {source} {where}"""


_cte("week", ["base"], _week_rows("base", True))
_cte("older_week", ["everyone"], _week_rows("everyone", False))


def _texts(stats: str) -> str:
    return f"""
  SELECT user_id, subject,
         string_agg(concat_ws(':', point, right_num, total_num, time_sum, 0), '_' ORDER BY point) AS point_stats
  FROM {stats} GROUP BY ALL"""


_cte("total_text", ["point_stats"], _texts("point_stats"))
_cte("week_text", ["week_point_stats"], _texts("week_point_stats"))


def _subject_totals(source: str, subjects: str) -> str:
    return f"""
  SELECT subject, count(*) AS user_count, count(*) FILTER (WHERE score >= 20) AS qualified_user_count,
         CAST(sum(answered_num) AS BIGINT) AS question_count, CAST(sum(answered_time) AS BIGINT) AS time_total,
         CAST(sum(right_num) AS BIGINT) AS right_total,
         CAST(0 AS BIGINT) AS undo_total, CAST(sum(undone_num) AS BIGINT) AS undone_total
  FROM {source} WHERE subject IN ({subjects}) GROUP BY subject"""


def _week_totals(source: str, subjects: str) -> str:
    return f"""
  SELECT subject, count(*) AS user_count, CAST(sum(week_answered_num) AS BIGINT) AS question_count,
         CAST(sum(week_time) AS BIGINT) AS time_total, CAST(sum(week_right_num) AS BIGINT) AS right_total,
         CAST(0 AS BIGINT) AS undo_total, CAST(sum(week_undone_num) AS BIGINT) AS undone_total
  FROM {source} WHERE subject IN ({subjects}) GROUP BY subject"""


_ALL_SUBJECTS = ", ".join(str(s) for s, _ in SUBJECT_POINTS)
_OLD_SUBJECTS = "1, 2, 3, 100100175"
_cte("subject_total", ["base"], _subject_totals("base", _ALL_SUBJECTS))
_cte("older_subject_total", ["everyone"], _subject_totals("everyone", _OLD_SUBJECTS))
_cte("week_total", ["week"], _week_totals("week", _ALL_SUBJECTS))
_cte("older_week_total", ["older_week"], _week_totals("older_week", _OLD_SUBJECTS))


def _rank(key: str, name: str) -> str:
    return f"row_number() OVER (PARTITION BY subject ORDER BY {key} DESC NULLS LAST, user_id ASC) AS {name}"


def _ranks(*keys: str) -> str:
    return ", ".join(_rank(key, f"rank{i or ''}") for i, key in zip([0, 2, 3, 4, 5], keys))


_cte("total_rank", ["base"], f"""
  SELECT *, {_ranks('sort_score', 'practice_days', 'answered_time', 'answered_num', 'score')} FROM base""")
_cte("week_rank", ["week"], f"""
  SELECT *, {_ranks('week_sort_score', 'week_answered_num', 'week_speed', 'week_accuracy', 'week_score')} FROM week""")
_cte("older_total_rank", ["everyone"], f"""
  SELECT *, {_ranks('score', 'practice_days', 'answered_time', 'answered_num')} FROM everyone""")
_cte("older_week_rank", ["older_week"], f"""
  SELECT *, {_ranks('week_score', 'week_answered_num', 'week_speed', 'week_accuracy')} FROM older_week""")

_cte("passed", ["base"], """
  SELECT a.practice_days, coalesce(sum(b.n), 0) AS days_pass_count
  FROM (SELECT DISTINCT practice_days FROM base) AS a
  LEFT JOIN (SELECT practice_days, count(*) AS n FROM base GROUP BY ALL) AS b ON b.practice_days < a.practice_days
  GROUP BY a.practice_days""")

_cte("asked_point", ["item"], """
  SELECT subject, point, count(*) AS asked_num FROM item WHERE point <> 0 GROUP BY ALL""")
_cte("knowledge", ["asked_point"], """
  SELECT point AS id, 'KP_' || point || '_' || CAST(sum(asked_num) % 10 AS INT) AS name,
         CASE WHEN point % 4 = 0 THEN 2 ELSE 1 END AS level, CASE WHEN point % 5 = 0 THEN 0 ELSE 1 END AS status
  FROM asked_point GROUP BY point""")
_cte("knowledge_link", ["asked_point"], """
  SELECT point AS knowledge_id, subject AS subject_id,
         CASE WHEN (point + subject) % 7 = 0 THEN 0 ELSE 1 END AS status
  FROM asked_point""")
_cte("subject_point", ["knowledge", "knowledge_link"], """
  SELECT coalesce(b.subject_id, 0) AS subject, CAST(k.id AS BIGINT) AS point, k.name
  FROM knowledge AS k
  LEFT JOIN knowledge_link AS b ON k.id = b.knowledge_id AND k.status = 1 AND b.status = 1
  WHERE k.level = 1""")
_cte("subject_list", ["subject_point"], """
  SELECT subject, string_agg(CAST(point AS VARCHAR), ',' ORDER BY point) AS points,
         string_agg(name, ',' ORDER BY point) AS point_names
  FROM subject_point GROUP BY subject""")
_cte("contact", [], """
  SELECT user_id, sha256(reg_phone) AS phone_hash,
         substr(reg_phone, 1, 3) || '****' || right(reg_phone, 4) AS phone_masked
  FROM (SELECT c_custkey // 3 AS user_id,
               '138' || CASE WHEN length(digits) < 8 THEN lpad(digits, 8, '0') ELSE digits END AS reg_phone,
               row_number() OVER (PARTITION BY c_custkey // 3 ORDER BY c_custkey DESC) AS n
        FROM (SELECT *, regexp_extract(c_name, '([0-9]+)$', 1) AS digits FROM customer) AS d) AS u
  WHERE n = 1""")

_cte("cell", [], """
  SELECT CAST(user_id AS VARCHAR) AS row_key, CASE WHEN event_id % 5 = 0 THEN 'more' ELSE 'info' END AS family, event_type AS "column", epoch_us(ts) AS version,
         event_id AS seq,
         CASE WHEN event_type IN ('signup', 'view') THEN CAST(CAST(floor(value) AS BIGINT) AS VARCHAR)
              ELSE CAST(value AS VARCHAR) END AS value
  FROM events""")
_cte("cell_version", ["cell"], """
  SELECT *, row_number() OVER (PARTITION BY row_key, family, "column" ORDER BY version DESC, seq DESC) AS version_no
  FROM cell""")
_cte("shared_cell_version", ["cell"], """
  SELECT * REPLACE (CAST(CAST(row_key AS BIGINT) % 10 AS VARCHAR) AS row_key),
         row_number() OVER (PARTITION BY CAST(row_key AS BIGINT) % 10, family, "column"
                            ORDER BY version DESC, seq DESC) AS version_no
  FROM cell""")
_cte("newest", ["cell_version"], """SELECT * EXCLUDE (version_no) FROM cell_version WHERE version_no = 1""")


def _with(needs: list[str], body: str) -> str:
    order: list[str] = []

    def visit(name: str) -> None:
        if name not in order:
            for need in CTES[name][0]:
                visit(need)
            order.append(name)

    for name in needs:
        visit(name)
    if not order:
        return body.strip()
    return "WITH " + ",\n".join(f"{n} AS ({CTES[n][1]})" for n in order) + "\n" + body.strip()


def _text_columns(*names: str) -> str:
    return ", ".join(f"CAST({n.split(' AS ')[0]} AS VARCHAR) AS {n.split(' AS ')[-1].split('.')[-1]}" for n in names)


_LIST = "string_agg(CAST({c} AS VARCHAR), ',' ORDER BY i) FILTER (WHERE {c} IS NOT NULL)"
_CARD_LISTS = ", ".join(
    f"coalesce({_LIST.format(c=c)}, '') AS {c}" for c in ("question", "correct", "answer_time", "point"))
_FEATURES = """
  SELECT source, id, strftime(ts, '%Y-%m-%d') AS day_dashed, strftime(ts, '%Y%m%d') AS day_compact,
         strftime(ts + INTERVAL 10 DAY, '%Y-%m-%d') AS day_added,
         CAST(hour(ts) AS INT) AS hour, CAST(minute(ts) AS INT) AS minute, CAST(second(ts) AS INT) AS second,
         strftime(ts, '%H') AS hour_padded, CAST(minute(ts) AS VARCHAR) AS minute_stripped,
         CAST(isodow(ts) AS INT) AS iso_weekday, isodow(ts) >= 6 AS is_rest_day,
         isoyear(ts) || '-' || weekofyear(ts) AS week_label,
         TRY_CAST(CASE WHEN regexp_full_match(text, '[0-9]+') THEN text END AS BIGINT) AS parsed_number,
         strftime(ts, '%Y%m%d') AS compact_again, strftime(ts, '%Y-%m-%d') AS dashed_again
  FROM (SELECT 'events' AS source, event_id AS id, ts, regexp_extract(props, ': *(.*)[}]$', 1) AS text FROM events
        UNION ALL SELECT 'orders', o_orderkey, o_orderdate, o_orderpriority FROM orders) AS t"""

# Rows of the same stored card id stay separate cards, so list order needs a row identity.
_cte("numbered", ["card"], "SELECT *, row_number() OVER () AS row_no FROM card")
_cte("card_lists", ["numbered"], CTES["item"][1]
     .replace("SELECT card_id,", "SELECT row_no, card_id,").replace("card.*", "numbered.*")
     .replace("FROM card,", "FROM numbered,").replace("card.asked", "numbered.asked"))


def _card_rows(where: str, day: str) -> str:
    return _with(["numbered", "card_lists"], f"""
SELECT c.card_id, c.user_id, c.subject, {day} coalesce(question, '') AS question, coalesce(correct, '') AS correct,
       coalesce(answer_time, '') AS answer_time, coalesce(point, '') AS point
FROM numbered AS c LEFT JOIN (SELECT row_no, {_CARD_LISTS} FROM card_lists GROUP BY row_no) AS l USING (row_no)
{where}""")


ORACLE: dict[str, str] = {
    "cards_scan": _card_rows("", "strftime(c.day, '%Y-%m-%d') AS day,"),
    "cards_volume": _with(["card"], """
SELECT strftime(day, '%Y-%m-%d') AS day, count(*) AS card_num FROM card GROUP BY day"""),
    "cards_on_day": _card_rows("WHERE c.day = DATE '2001-07-25'", ""),
    "active_users": _with(["active"], "SELECT user_id FROM active"),
    "point_stats": _with(["point_stats"], "SELECT * FROM point_stats"),
    "merge_point_stats": _with(["point_stats"], "SELECT * FROM point_stats"),
    "decode_score_string": _with(["point_stats"], "SELECT *, CAST(0 AS BIGINT) AS undo_num FROM point_stats"),
    "encode_score_string": _with(["total_text"], "SELECT * FROM total_text"),
    "user_subject_stats": _with(["everyone"], """
SELECT user_id, subject, answered_num, answered_time, practice_days, right_num, undone_num,
       CAST(0 AS BIGINT) AS undo_num FROM everyone"""),
    "week_stats": _with(["everyone"], f"""
SELECT user_id, subject, week_answered_num, week_time, week_right_num, week_speed, week_accuracy, week_undo_num,
       week_undone_num
FROM ({_week_rows('everyone', True)}) AS w"""),
    "legacy_running_correct": _with(["running"], "SELECT * FROM running"),
    "predicted_score": _with(["everyone"], "SELECT user_id, subject, score, sort_score FROM everyone"),
    "week_predicted_score": _with(["everyone"], "SELECT user_id, subject, week_score FROM everyone"),
    "active_total": _with(["base"], """
SELECT user_id, subject, answered_num, answered_time, practice_days, right_num, undone_num, score FROM base"""),
    "subject_totals": _with(["subject_total"], "SELECT * FROM subject_total"),
    "week_subject_totals": _with(["week_total"], "SELECT * FROM week_total"),
    "days_histogram": _with(["base"], "SELECT practice_days, count(*) AS row_num FROM base GROUP BY practice_days"),
    "days_pass_count": _with(["base", "passed"], """
SELECT user_id, subject, practice_days, CAST(days_pass_count AS BIGINT) AS days_pass_count
FROM base JOIN passed USING (practice_days)"""),
    "total_ranks": _with(["total_rank"], """
SELECT user_id, subject, score, sort_score, practice_days, answered_time, answered_num,
       rank, rank2, rank3, rank4, rank5 FROM total_rank"""),
    "week_ranks": _with(["week_rank"], """
SELECT user_id, subject, week_score, week_sort_score, week_answered_num, week_speed, week_accuracy,
       rank, rank2, rank3, rank4, rank5 FROM week_rank"""),
    "total_top": _with(["total_rank"], "SELECT user_id, subject, sort_score, rank FROM total_rank WHERE rank <= 1000"),
    "week_top": _with(["week_rank"], """
SELECT user_id, subject, week_score, week_sort_score, week_answered_num, week_time, rank
FROM week_rank WHERE rank <= 10"""),
    "knowledge_subject": _with(["subject_point"], "SELECT * FROM subject_point"),
    "subject_points": _with(["subject_list"], "SELECT * FROM subject_list"),
    "subject_points_enrich": _with(["base", "subject_list"], """
SELECT user_id, base.subject, score, coalesce(points, '') AS points, coalesce(point_names, '') AS point_names
FROM base LEFT JOIN subject_list AS l ON l.subject = base.subject"""),
    "user_contact_enrich": _with(["base", "contact"], """
SELECT base.user_id, subject, score, phone_hash, phone_masked FROM base LEFT JOIN contact USING (user_id)"""),
    "total_with_subject_totals": _with(["base", "subject_total"], """
SELECT user_id, base.subject, score, user_count, qualified_user_count, question_count, time_total, right_total,
       undo_total
FROM base LEFT JOIN subject_total AS t ON t.subject = base.subject"""),
    "total_wide": _with(["total_rank", "total_text", "subject_list", "passed", "subject_total"], f"""
SELECT r.user_id || '-' || r.subject AS row_key, coalesce(x.point_stats, '') AS point_stats,
       {_text_columns('r.score', 'r.answered_num', 'r.answered_time', 'r.practice_days', 'r.subject', 'rank', 'rank2',
                      'rank3', 'rank4')},
       coalesce(points, '') AS points, coalesce(point_names, '') AS point_names,
       {_text_columns('days_pass_count', 'r.sort_score', 'rank5', 'user_count', 'qualified_user_count',
                      'question_count', 'time_total', 'right_total', 'undo_total')}
FROM total_rank AS r
LEFT JOIN total_text AS x ON x.user_id = r.user_id AND x.subject = r.subject
LEFT JOIN subject_list AS l ON l.subject = r.subject
LEFT JOIN passed AS p ON p.practice_days = r.practice_days
LEFT JOIN subject_total AS t ON t.subject = r.subject"""),
    "week_wide": _with(["week_rank", "week_text", "subject_list", "week_total"], f"""
SELECT r.user_id || '-' || r.subject || '-{LABEL}' AS row_key, coalesce(x.point_stats, '') AS week_point_stats,
       {_text_columns('r.week_score', 'r.subject', 'rank', 'r.week_answered_num', 'r.week_time', 'rank2', 'rank3',
                      'rank4', 'r.week_speed', 'r.week_accuracy')},
       coalesce(points, '') AS points, coalesce(point_names, '') AS point_names,
       {_text_columns('r.week_sort_score', 'rank5', 'user_count', 'question_count', 'time_total', 'right_total',
                      'undo_total')}
FROM week_rank AS r
LEFT JOIN week_text AS x ON x.user_id = r.user_id AND x.subject = r.subject
LEFT JOIN subject_list AS l ON l.subject = r.subject
LEFT JOIN week_total AS t ON t.subject = r.subject"""),
    "week_top_wide": _with(["week_rank", "week_text"], f"""
SELECT rank || '-' || r.subject || '-{LABEL}' AS row_key, coalesce(x.point_stats, '') AS week_point_stats,
       {_text_columns('r.user_id', 'r.week_score', 'r.subject', 'rank', 'r.week_answered_num', 'r.week_time',
                      'r.week_sort_score')}
FROM week_rank AS r LEFT JOIN week_text AS x ON x.user_id = r.user_id AND x.subject = r.subject
WHERE rank <= 1000"""),
    "older_total_wide": _with(["older_total_rank", "total_text", "older_subject_total"], f"""
SELECT r.user_id || '-' || r.subject AS row_key, coalesce(x.point_stats, '') AS point_stats,
       {_text_columns('r.score', 'r.answered_num', 'r.answered_time', 'r.practice_days', 'r.subject', 'rank', 'rank2',
                      'rank3', 'rank4', 'coalesce(user_count, 0) AS user_count',
                      'coalesce(question_count, 0) AS question_count', 'coalesce(time_total, 0) AS time_total',
                      'coalesce(right_total, 0) AS right_total')}
FROM older_total_rank AS r
LEFT JOIN total_text AS x ON x.user_id = r.user_id AND x.subject = r.subject
LEFT JOIN older_subject_total AS t ON t.subject = r.subject"""),
    "older_week_wide": _with(["older_week_rank", "week_text", "older_week_total"], f"""
SELECT r.user_id || '-' || r.subject || '-{LABEL}' AS row_key, coalesce(x.point_stats, '') AS week_point_stats,
       {_text_columns('r.week_score', 'r.subject', 'rank', 'r.week_answered_num', 'r.week_time', 'rank2', 'rank3',
                      'rank4', 'r.week_speed', 'r.week_accuracy', 'coalesce(user_count, 0) AS user_count',
                      'coalesce(question_count, 0) AS question_count', 'coalesce(time_total, 0) AS time_total',
                      'coalesce(right_total, 0) AS right_total')}
FROM older_week_rank AS r
LEFT JOIN week_text AS x ON x.user_id = r.user_id AND x.subject = r.subject
LEFT JOIN older_week_total AS t ON t.subject = r.subject"""),
    "older_week_top_wide": _with(["older_week_rank", "week_text"], f"""
SELECT rank || '-' || r.subject || '-{LABEL}' AS row_key, coalesce(x.point_stats, '') AS week_point_stats,
       {_text_columns('r.user_id', 'r.week_score', 'r.subject', 'rank', 'r.week_answered_num', 'r.week_time')}
FROM older_week_rank AS r LEFT JOIN week_text AS x ON x.user_id = r.user_id AND x.subject = r.subject
WHERE rank <= 10"""),
    "contact_total_wide": _with(["base", "total_text", "contact"], f"""
SELECT r.user_id || '-' || r.subject AS row_key, coalesce(x.point_stats, '') AS point_stats,
       {_text_columns('r.score', 'r.answered_num', 'r.answered_time', 'r.practice_days', 'r.subject',
                      'r.sort_score')}, phone_hash, phone_masked
FROM base AS r
LEFT JOIN total_text AS x ON x.user_id = r.user_id AND x.subject = r.subject
LEFT JOIN contact AS u ON u.user_id = r.user_id"""),
    "rowkey_range": _with(["newest"], """
SELECT row_key, max(value) FILTER (WHERE "column" = 'click') AS click,
       max(value) FILTER (WHERE "column" = 'purchase') AS purchase
FROM newest WHERE family = 'info' AND row_key >= '2' AND row_key < '6' GROUP BY row_key"""),
    "typed_lookup": _with(["newest"], """
SELECT row_key, CAST(max(value) FILTER (WHERE "column" = 'click') AS DOUBLE) AS click,
       CAST(max(value) FILTER (WHERE "column" = 'view') AS BIGINT) AS view,
       CAST(max(value) FILTER (WHERE "column" = 'signup') AS BIGINT) AS signup,
       max(value) FILTER (WHERE "column" = 'error') AS error
FROM newest WHERE family = 'info' AND row_key IN (SELECT CAST(c_custkey AS VARCHAR) FROM customer WHERE c_acctbal > 0)
GROUP BY row_key"""),
    "cell_upsert": _with(["newest"], "SELECT * FROM newest"),
    "key_delete": _with(["cell"], """
SELECT * FROM cell WHERE row_key NOT IN (SELECT CAST(c_custkey AS VARCHAR) FROM customer WHERE c_acctbal < 0)"""),
    "version_retention": _with(["shared_cell_version"], "SELECT * FROM shared_cell_version WHERE version_no <= 24"),
    "version_retention_short": _with(["cell_version"], "SELECT * FROM cell_version WHERE version_no <= 10"),
    "calendar_features": _with([], _FEATURES),
    "string_count": "SELECT o_orderpriority, count(*) AS row_num FROM orders GROUP BY o_orderpriority",
}

# The same results where only an input or a name differs.


def _of_day(sql: str, day: str) -> str:
    return sql.replace("FROM lineitem) AS c", f"FROM lineitem WHERE CAST(l_shipdate AS DATE) = DATE '{day}') AS c")


def _running(sql: str) -> str:
    return (sql.replace("everyone AS (", f"running AS ({CTES['running'][1]}),\neveryone AS (", 1)
            .replace("coalesce(i.right_num, 0) AS right_num", "coalesce(g.running_right_num, 0) AS right_num")
            .replace("coalesce(w.right_num, 0) AS week_right_num", "coalesce(g.week_running_right_num, 0) AS week_right_num")
            .replace("LEFT JOIN week_score AS s USING (user_id, subject)",
                     "LEFT JOIN week_score AS s USING (user_id, subject) LEFT JOIN running AS g USING (user_id, subject)"))


ORACLE |= {
    "counted_total_ranks": ORACLE["total_ranks"],
    "counted_week_ranks": ORACLE["week_ranks"],
    "older_day_total_wide": _of_day(ORACLE["older_total_wide"], "2001-07-25"),
    "running_total_wide": _running(ORACLE["total_wide"]),
    "running_week_wide": _running(ORACLE["week_wide"]),
    "legacy_week_top_wide": f"""
SELECT row_key, user_id AS "userId", week_point_stats AS grade, week_score AS predict_score, subject, rank,
       week_answered_num AS "exerciseNum", week_time AS "exerciseTime", week_sort_score AS "sortScore"
FROM ({ORACLE["week_top_wide"]}) AS t""",
    "active_user_scores": _with(["base"], "SELECT user_id, subject, score, sort_score FROM base"),
    "top_cards": _with(["card", "item"], """
SELECT subject, card_id, card_time, rank FROM (
  SELECT subject, card_id, card_time, row_number() OVER (PARTITION BY subject ORDER BY card_time DESC, card_id) AS rank
  FROM (SELECT c.subject, c.card_id, CAST(coalesce(sum(answer_time), 0) AS BIGINT) AS card_time
        FROM (SELECT DISTINCT subject, card_id FROM card) AS c
        LEFT JOIN item AS i ON i.subject = c.subject AND i.card_id = c.card_id GROUP BY ALL) AS s) AS r
WHERE rank <= 1000"""),
}


# Stored forms give what the plain operators give; weeks are spelled out one by one.

WEEKS = [("2001-30", "2001-07-23", "2001-06-29"), ("2001-29", "2001-07-16", "2001-06-22"),
         ("2001-26", "2001-06-25", "2001-06-01"), ("2000-52", "2000-12-25", "2000-12-01")]
_WEEK_LIST = ", ".join(f"('{label}', DATE '{monday}', DATE '{since}')" for label, monday, since in WEEKS)
_cte("asked_week", [], f"SELECT * FROM (VALUES {_WEEK_LIST}) AS w(week, monday, since)")
_cte("weeks_item", ["item", "asked_week"], """
  SELECT week, user_id, subject,
         count(*) FILTER (WHERE correct IN (1, 2) AND question IS NOT NULL) AS week_answered_num,
         CAST(coalesce(sum(answer_time), 0) AS BIGINT) AS week_time,
         count(*) FILTER (WHERE correct NOT IN (1, 2)) AS week_undone_num,
         count(*) FILTER (WHERE correct = 1 AND answer_time IS NOT NULL AND point <> 0) AS week_right_num
  FROM item JOIN asked_week ON day BETWEEN monday AND monday + 6 GROUP BY ALL""")
_cte("weeks_point", ["hit", "asked_week"], """
  SELECT week, user_id, subject, point, sum(is_right) AS right_num, count(*) AS total_num
  FROM hit JOIN asked_week ON day BETWEEN monday AND monday + 6 GROUP BY ALL""")
_cte("weeks_score", ["weeks_item", "weeks_point", "rule"], """
  SELECT i.week, i.user_id, i.subject,
         round(CASE WHEN min(share) IS NULL
           THEN CAST(sum(w_right * coalesce(right_num, 0)) AS DOUBLE) / CAST(sum(w_total * coalesce(total_num, 1)) AS DOUBLE)
           ELSE sum(CAST(share AS DOUBLE) * CAST(coalesce(right_num, 0) AS DOUBLE) / CAST(coalesce(total_num, 1) AS DOUBLE))
           END * 100, 6) AS week_score
  FROM weeks_item AS i JOIN rule AS r USING (subject)
  LEFT JOIN weeks_point AS p ON p.week = i.week AND p.user_id = i.user_id AND p.subject = i.subject AND p.point = r.point
  GROUP BY ALL""")
_cte("weeks", ["weeks_item", "weeks_score", "item_stats", "asked_week", "card"], """
  SELECT week, user_id, subject, week_score, week_answered_num, week_time, week_right_num,
         round(CAST(week_time AS DOUBLE) / week_answered_num, 6) AS week_speed,
         round(CAST(week_right_num AS DOUBLE) / week_answered_num, 6) AS week_accuracy, week_undone_num,
         CASE WHEN t.answered_num < 300 OR CAST(t.answered_time AS DOUBLE) / t.answered_num < 20 THEN 0.0
              ELSE week_score END AS week_sort_score
  FROM weeks_item JOIN weeks_score USING (week, user_id, subject) JOIN item_stats AS t USING (user_id, subject)
  JOIN asked_week USING (week) JOIN (SELECT user_id, max(day) AS last_day FROM card GROUP BY ALL) AS l USING (user_id)
  WHERE week_answered_num > 0 AND last_day >= since""")


def _week_rank(key: str, name: str) -> str:
    return f"row_number() OVER (PARTITION BY week, subject ORDER BY {key} DESC NULLS LAST, user_id) AS {name}"


_WEEK_RANKS = ", ".join(_week_rank(key, f"rank{i or ''}") for i, key in zip(
    [0, 2, 3, 4, 5], ["week_sort_score", "week_answered_num", "week_speed", "week_accuracy", "week_score"]))

ORACLE |= {
    "history_point_stats": ORACLE["point_stats"],
    "history_user_stats": _with(["base", "running"], """
SELECT user_id, subject, answered_num, answered_time, practice_days, running_right_num AS right_num, undone_num,
       week_running_right_num AS week_right_num, score
FROM base JOIN running USING (user_id, subject)"""),
    "filtered_active_total": ORACLE["active_total"],
    "cards_of_user": _card_rows("WHERE year(c.day) = 2000 AND c.user_id = 0 AND c.subject = 1", ""),
    "min_answered_total": ORACLE["active_total"] + " WHERE answered_num >= 200",
    "backfill_weeks": _with(["weeks"], "SELECT * FROM weeks"),
    "backfill_ranks": _with(["weeks"], f"""
SELECT week, user_id, subject, week_score, week_sort_score, week_answered_num, week_speed, week_accuracy, {_WEEK_RANKS}
FROM weeks"""),
    "stored_weeks": _with(["weeks"], f"""
SELECT user_id || '-' || subject AS row_key, CAST(week_answered_num AS VARCHAR) AS answered, week
FROM weeks WHERE week IN ('{WEEKS[0][0]}', '{WEEKS[1][0]}')"""),
    "zone_range": ORACLE["rowkey_range"],
    "store_maintenance": _with(["newest"], """
SELECT * FROM newest WHERE row_key NOT IN (SELECT CAST(c_custkey AS VARCHAR) FROM customer WHERE c_acctbal < 0)"""),
    "sql_subject_report": _with(["base", "week", "subject_list"], """
SELECT b.user_id, b.subject, b.score, b.practice_days, w.week_answered_num, w.week_score, l.points
FROM base AS b LEFT JOIN week AS w ON w.user_id = b.user_id AND w.subject = b.subject
LEFT JOIN subject_list AS l ON l.subject = b.subject
WHERE b.score >= 30 AND b.practice_days >= 3"""),
}
