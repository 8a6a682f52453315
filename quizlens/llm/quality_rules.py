"""Operator 1: quality rules with host-level verdicts, in DataFrame functions only.

Each document is measured and tested by fixed rules. Failures are summed by host (the ``source`` column), the rate of
a host is shrunk towards that of all hosts by a beta prior fitted to the hosts themselves, and a host whose shrunk
rate is too high takes all its documents with it. Hosts are pre-aggregated in every task, so a host with a third of
all rows is one row from each; their verdicts are a small table that is joined back.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quizlens.llm.tables import set_aside
from quizlens.operators.materialize import materialize

MEASURES = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
SPACE = r"[\x20\x09-\x0D]+"
NOT_SPACE = r"[^\x20\x09-\x0D]"


@dataclass(frozen=True)
class Rules:
    """Bounds of the rules. The first two reject a document alone; the others only count against its host."""

    min_words: int = 50
    max_repeat_percent: int = 50
    max_symbols_percent: int = 30
    max_dup_lines_percent: int = 50
    word_chars: tuple[int, int] = (2, 15)
    max_host_rate: float = 0.5
    prior_documents: tuple[float, float] = (1.0, 1000.0)


def _covered(positions: Column) -> Column:
    """Words in windows of three that start at the ascending ``positions``."""
    n = F.size(positions)
    gaps = F.zip_with(F.slice(positions, F.lit(1), n - 1), F.slice(positions, F.lit(2), n - 1),
                      lambda a, b: F.least(F.lit(3), b - a))
    return F.when(n == 0, F.lit(0)).otherwise(F.aggregate(gaps, F.lit(3), lambda total, g: total + g))


def measure(docs: DataFrame) -> DataFrame:
    """Append the five measures (long) and ``n_lines`` to all columns; a null text is measured as an empty one.

    Windows are told apart by a 64-bit hash within one document. Helper columns live in one struct, and a column that
    already has a measure's name is replaced.
    """
    docs, back = set_aside(docs, "_q", "_h", "_s", "_p")
    text = F.coalesce("text", F.lit(""))
    lines = F.filter(F.split(text, "\n"), lambda line: line.rlike(NOT_SPACE))
    first = docs.withColumn("_q", F.struct(F.array_remove(F.split(text, SPACE), "").alias("w"), lines.alias("l")))
    n = F.size("_q.w")
    window = lambda i: F.xxhash64(F.get("_q.w", i), F.get("_q.w", i + 1), F.get("_q.w", i + 2))
    hashes = F.when(n >= 3, F.transform(F.sequence(F.lit(0), n - 3), window)).otherwise(F.array().cast("array<bigint>"))
    second = first.withColumn("_h", hashes)
    ordered = F.when(
        F.size(F.array_distinct("_h")) < F.size("_h"),
        F.array_sort(F.transform("_h", lambda h, i: F.struct(h.alias("h"), i.alias("i")))))
    third = second.withColumn("_s", ordered)
    twice = F.filter("_s", lambda s, i: F.coalesce(
        (F.get("_s", i - 1)["h"] == s["h"]) | (i + 1 < F.size("_s")) & (F.get("_s", i + 1)["h"] == s["h"]), F.lit(False)))
    fourth = third.withColumn("_p", F.when(F.col("_s").isNotNull(), F.sort_array(F.transform(twice, lambda s: s["i"]))))
    measured = {
        "n_words": n,
        "word_chars": F.length(F.array_join("_q.w", "")),
        "n_symbols": F.length(text) - F.length(F.regexp_replace(text, r"[#*$%&|<>]", "")),
        "n_dup_lines": F.size("_q.l") - F.size(F.array_distinct("_q.l")),
        "n_repeat_words": F.when(F.col("_p").isNull(), F.lit(0)).otherwise(_covered(F.col("_p"))),
        "n_lines": F.size("_q.l"),
    }
    return fourth.withColumns({k: v.cast("long") for k, v in measured.items()}).drop(
        "_q", "_h", "_s", "_p").withColumnsRenamed(back)


def failures(rules: Rules) -> tuple[Column, Column]:
    """(rejected alone, counts against the host)."""
    n = F.col("n_words")
    base = (n < rules.min_words) | (100 * F.col("n_repeat_words") > rules.max_repeat_percent * n)
    low, high = rules.word_chars
    host = (base | (100 * F.col("n_symbols") > rules.max_symbols_percent * n)
            | (100 * F.col("n_dup_lines") > rules.max_dup_lines_percent * F.col("n_lines"))
            | ~F.col("word_chars").between(low * n, high * n))
    return base, host


def host_rates(measured: DataFrame, rules: Rules) -> DataFrame:
    """(host, documents, failures, host_rate): failure rates shrunk by a beta prior fitted to the spread of the hosts.

    The prior has the mean rate of all documents. Its weight follows from how far the hosts' rates lie apart beyond
    what chance explains, between one and a thousand documents. A null source is the host with the empty name.
    """
    hosts = materialize(measured.groupBy(F.coalesce("source", F.lit("")).alias("host")).agg(
        F.count(F.lit(1)).alias("documents"), F.sum(F.col("_host_fails").cast("long")).alias("failures")), "hosts")
    n, x = F.col("documents"), F.col("failures")
    row = hosts.agg(F.sum(n).alias("n"), F.sum(x).alias("x"), F.count(F.lit(1)).alias("k"), F.sum(n * n).alias("nn"),
                    F.sum(x * x / n).alias("xx")).first()     # five sums over all hosts
    mean = (row["x"] or 0) / (row["n"] or 1)
    spread = row["xx"] - row["n"] * mean * mean if row["n"] else 0.0
    weight = prior_weight(row["n"] or 0, row["k"], row["nn"] or 0, spread, mean, rules.prior_documents)
    return hosts.select("host", "documents", "failures", (
        (x + F.lit(mean * weight)) / (n + F.lit(weight))).alias("host_rate"))


def prior_weight(n: int, k: int, nn: int, spread: float, mean: float, bounds: tuple[float, float]) -> float:
    """Documents the prior stands for, by moments: ``spread`` is the sum of n_i (rate_i - mean)^2 over k hosts."""
    low, high = bounds
    chance = mean * (1 - mean)
    if k < 2 or chance <= 0:
        return high
    between = (spread - (k - 1) * chance) / (n - nn / n - (k - 1)) if n - nn / n > k - 1 else 0.0
    return min(high, max(low, chance / between - 1)) if between > 0 else high


def judged(docs: DataFrame, rules: Rules = Rules()) -> DataFrame:
    """All columns of ``docs``, the measures, ``base_failed``, ``host_rate``, ``host_failed``, ``kept`` and a row number ``_row``.

    Documents are measured twice, once for their hosts and once for themselves: that costs less than writing the texts
    in between. Ties at a bound pass. Repeated rows count each. No rows give no rows.
    """
    docs, back = set_aside(docs, "_host", "_host_fails")
    base, host = failures(rules)
    # The row number keeps filters above the measures; below, each would repeat their whole expression.
    measured = measure(docs).withColumns({"base_failed": base, "_host_fails": host, "_row": F.monotonically_increasing_id()})
    rates = materialize(host_rates(measured, rules).select(F.col("host").alias("_host"), "host_rate"), "host-rates")
    out = measured.drop("host_rate").join(rates, F.coalesce("source", F.lit("")) == F.col("_host"))
    failed = F.col("host_rate") > rules.max_host_rate
    return out.withColumns({"host_failed": failed, "kept": ~F.col("base_failed") & ~failed}).drop(
        "_host", "_host_fails").withColumnsRenamed(back)


def document_verdicts(docs: DataFrame, rules: Rules = Rules()) -> DataFrame:
    """doc_id, the measures, ``base_failed``, ``kept``, host and its rate per document.

    Null texts are empty, a null source is the host with the empty name, ties at a bound pass, repeated rows are answered each,
    no rows give no rows, further columns are not looked at.
    """
    slim = measure(docs.select(F.col("doc_id").cast("long"), "text", "source")).drop("text")
    base, host = failures(rules)
    rows = materialize(slim.withColumns({"base_failed": base, "_host_fails": host}), "measured")
    rates = materialize(host_rates(rows, rules).select(F.col("host").alias("_host"), "host_rate"), "host-rates")
    failed = F.col("host_rate") > rules.max_host_rate
    return rows.join(rates, F.coalesce("source", F.lit("")) == F.col("_host")).select(
        "doc_id", *MEASURES, "base_failed", (~F.col("base_failed") & ~failed).alias("kept"),
        F.col("_host").alias("host"), F.round("host_rate", 6).alias("host_rate"))


def kept_documents(docs: DataFrame, rules: Rules = Rules()) -> DataFrame:
    """The documents that pass, with the columns they came with."""
    names = [f"_c{i}" for i in range(len(docs.columns))]   # so that no column of theirs clashes with a measure
    renamed = docs.select(*[F.col(f"`{c}`").alias(n) for c, n in zip(docs.columns, names, strict=True)],
                          F.col("text").alias("text"), F.col("source").alias("source"))
    return judged(renamed, rules).where("kept AND _row >= 0").select(
        *[F.col(n).alias(c) for c, n in zip(docs.columns, names, strict=True)])


ORACLE = r"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS t, coalesce(source, '') AS host FROM documents),
w AS (SELECT *, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS ws,
      list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS ls FROM d),
p AS (SELECT r, i, ws[i] || ' ' || ws[i + 1] || ' ' || ws[i + 2] AS g
      FROM (SELECT r, ws, unnest(range(1, len(ws) - 1)) AS i FROM w)),
rep AS (SELECT r, g FROM p GROUP BY ALL HAVING count(*) > 1),
cov AS (SELECT r, count(DISTINCT i + o) AS c FROM p JOIN rep USING (r, g), (SELECT unnest([0, 1, 2]) AS o) GROUP BY r),
m AS (SELECT w.r, doc_id, host, len(ws)::BIGINT AS n_words, length(array_to_string(ws, ''))::BIGINT AS word_chars,
      (length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')))::BIGINT AS n_symbols,
      (len(ls) - len(list_distinct(ls)))::BIGINT AS n_dup_lines, coalesce(c, 0)::BIGINT AS n_repeat_words,
      len(ls)::BIGINT AS n_lines FROM w LEFT JOIN cov USING (r)),
f AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM m),
g AS (SELECT *, base_failed OR 100 * n_symbols > 30 * n_words OR 100 * n_dup_lines > 50 * n_lines
      OR NOT word_chars BETWEEN 2 * n_words AND 15 * n_words AS hf FROM f),
h AS (SELECT host, count(*)::DOUBLE AS n, sum(hf::INT)::DOUBLE AS x FROM g GROUP BY host),
s AS (SELECT sum(n) AS n, sum(x) / sum(n) AS mean, count(*) AS k, sum(n * n) AS nn, sum(x * x / n) AS xx FROM h),
b AS (SELECT *, mean * (1 - mean) AS chance,
      CASE WHEN n - nn / n > k - 1 THEN (xx - n * mean * mean - (k - 1) * mean * (1 - mean)) / (n - nn / n - (k - 1))
           ELSE 0 END AS between_hosts FROM s),
v AS (SELECT mean, CASE WHEN k < 2 OR chance <= 0 OR between_hosts <= 0 THEN 1000
           ELSE least(1000, greatest(1, chance / between_hosts - 1)) END AS weight FROM b),
q AS (SELECT host, (x + mean * weight) / (n + weight) AS rate FROM h, v)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND NOT rate > 0.5 AS kept, host, round(rate, 6) AS host_rate
FROM g JOIN q USING (host)
"""
