"""Operator 9: chat formatting by tool-call linking, in DataFrame and SQL functions only.

Calls and results meet in a join on the call's identifier. The calls of a conversation are ordered topologically: a
call comes after every call whose result it needs, by rounds that place all calls whose needs are placed. Arguments are
parsed as JSON, taken apart into (key, type) rows and joined with the schema of the tool. Every call is written as one
line of canonical JSON: keys in order at every level, no white space.

Nothing is gathered by conversation: rows are sorted by range, and a row's position is its place in its range plus what
earlier ranges hold of its conversation, so a conversation with a third of all calls is spread like any other.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quizlens.operators.materialize import materialize

CALLS = "call_id string, conv_id long, turn long, name string, arguments string, needs array<string>"
RESULTS = "call_id string, turn long, content string"
TOOLS = "name string, key string, type string, required boolean"

#: The tools that :func:`from_conversations` derives calls of: the keys they take, and which of them they require.
DERIVED_TOOLS = [
    ("calculate", "limit", "number", True), ("calculate", "query", "string", False),
    ("lookup", "exact", "boolean", False), ("lookup", "query", "string", True),
    ("search", "exact", "boolean", False), ("search", "limit", "number", True), ("search", "query", "string", True),
]


def tools(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(DERIVED_TOOLS, TOOLS)


def from_conversations(conversations: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Calls and results of conversations that are plain text.

    An assistant's turn is a call whose query is its text: of search, calculate or lookup by its length, malformed,
    without limit or with a limit of the wrong type for some lengths. It needs the assistant's turn two before it. A
    user's turn is the result of the turn before it, whether or not that was a call. Rows without conv_id, turn or role
    are left out; a null text is an empty one.
    """
    rows = conversations.select(
        F.col("conv_id").cast("long"), F.col("turn").cast("long"), "role", F.coalesce("text", F.lit("")).alias("text"))
    rows = rows.where("conv_id IS NOT NULL AND turn IS NOT NULL")
    calls = _said_as_calls(rows).select("call_id", "conv_id", "turn", "name", "arguments", "needs")
    results = rows.where("role = 'user'").select(
        _call_id(F.col("turn") - 1).alias("call_id"), "turn", F.col("text").alias("content"))
    return calls, results


def _call_id(turn: Column) -> Column:
    return F.concat(F.lit("call-"), F.col("conv_id"), F.lit("-"), turn)


def _said_as_calls(rows: DataFrame) -> DataFrame:
    """The assistant's ``rows`` (conv_id, turn, role, text and others) with call_id, name, arguments and needs."""
    said = rows.where("role = 'assistant'")
    before = said.select("conv_id", (F.col("turn") + 2).alias("turn")).distinct().withColumn("follows", F.lit(True))
    n = F.length("text")
    json = F.to_json(F.struct(F.col("text").alias("q")))
    query = F.expr("substring(json, 6, length(json) - 6)")
    limit = F.when(n % 8 == 1, F.lit("")).when(n % 8 == 2, F.concat(F.lit(', "limit" : "'), n, F.lit('"'))).otherwise(
        F.concat(F.lit(', "limit" : '), n))
    arguments = F.concat(F.lit('{ "query" : '), query, limit, F.when(n % 8 == 0, F.lit("")).otherwise(F.lit(', "exact" : true }')))
    return said.join(before, ["conv_id", "turn"], "left").withColumn("json", json).select(
        *rows.columns, _call_id(F.col("turn")).alias("call_id"),
        F.element_at(F.array(*map(F.lit, ("search", "calculate", "lookup"))), (n % 3 + 1).cast("int")).alias("name"),
        arguments.alias("arguments"),
        F.when(F.col("follows"), F.array(_call_id(F.col("turn") - 2))).otherwise(F.array().cast("array<string>")).alias("needs"))


def first_of_each(calls: DataFrame) -> DataFrame:
    """One row per identifier, the earliest; what repeats it later is counted in ``n_calls``."""
    best = calls.groupBy("call_id").agg(
        F.min(F.struct("turn", "conv_id", "name", "arguments", "needs")).alias("c"), F.count(F.lit(1)).alias("n_calls"))
    return best.select("call_id", "c.*", "n_calls")


def argument_errors(calls: DataFrame, schemas: DataFrame) -> DataFrame:
    """(call_id, errors): sorted findings of each call with an identifier.

    malformed: not a JSON object; unknown tool; missing:KEY, type:KEY and unexpected:KEY by the tool's schema. An
    integer or decimal is a number. An error row per key at most, so a call's list is bounded by its own arguments.
    """
    spark = calls.sparkSession
    parsed = calls.select("call_id", "name", F.try_parse_json("arguments").alias("v"))
    parsed = parsed.withColumn("whole", F.coalesce(F.schema_of_variant("v").startswith("OBJECT"), F.lit(False)))
    keys = spark.sql("SELECT call_id, name, key, schema_of_variant(value) AS kind FROM {p}, LATERAL variant_explode(v) "
                     "WHERE whole", p=parsed)
    kind = (F.when(F.col("kind") == "STRING", "string").when(F.col("kind") == "BOOLEAN", "boolean")
            .when(F.col("kind").startswith("ARRAY"), "array").when(F.col("kind").startswith("OBJECT"), "object")
            .when(F.col("kind") == "VOID", "null").otherwise("number"))
    known = schemas.select("name").distinct().withColumn("known", F.lit(True))
    given = keys.join(known, "name", "left_semi").join(schemas, ["name", "key"], "left").select(
        "call_id", F.when(F.col("type").isNull(), F.concat(F.lit("unexpected:"), "key")).when(
            F.col("type") != kind, F.concat(F.lit("type:"), "key")).alias("error"))
    required = parsed.where("whole").select("call_id", "name").join(schemas.where("required"), "name")
    missing = required.join(keys.select("call_id", "key"), ["call_id", "key"], "left_anti").select(
        "call_id", F.concat(F.lit("missing:"), "key").alias("error"))
    broken = parsed.where("NOT whole").select("call_id", F.lit("malformed").alias("error"))
    unknown = parsed.join(known, "name", "left_anti").select("call_id", F.lit("unknown tool").alias("error"))
    return given.where("error IS NOT NULL").union(missing).union(broken).union(unknown).groupBy("call_id").agg(
        F.sort_array(F.collect_set("error")).alias("errors"))


def levels(calls: DataFrame) -> DataFrame:
    """(call_id, level): 0 for calls that need no other call of their conversation, else one more than the highest
    needed. Calls on a cycle, or behind one, have no row.

    Chains of calls that need a single other one are walked by doubling steps: a thousand calls in a row take ten
    rounds. What is left is a graph of the calls with several needs, which are placed once all their needs are, in as
    many rounds as such calls stand behind one another. Every round is written.
    """
    nodes = calls.select("call_id", "conv_id")
    edges = calls.select("call_id", "conv_id", F.explode("needs").alias("need")).distinct().join(
        nodes.withColumnsRenamed({"call_id": "need"}), ["need", "conv_id"], "left_semi").select("call_id", "need")
    edges = materialize(edges.withColumn("of", F.count(F.lit(1)).over(Window.partitionBy("call_id"))), "needs")
    heads = _chain_heads(nodes.select("call_id"), edges.where("of = 1"))
    several = edges.where("of > 1").join(
        heads.withColumnsRenamed({"call_id": "need", "steps": "before"}), "need").select("call_id", "of", "head", (F.col("before") + 1).alias("more"))
    several = materialize(several, "needs")
    placed = materialize(nodes.join(edges, "call_id", "left_anti").select(
        F.col("call_id").alias("head"), F.lit(0).cast("long").alias("level")), "levels")
    newest = several
    while not newest.isEmpty():
        ready = several.join(placed, "head").groupBy("call_id", "of").agg(
            F.count(F.lit(1)).alias("n"), F.max(F.col("level") + F.col("more")).alias("level")).where("n = of")
        newest = materialize(ready.select(F.col("call_id").alias("head"), "level").join(placed, "head", "left_anti"), "levels")
        placed = placed.union(newest)
    return heads.join(placed, "head").select("call_id", (F.col("steps") + F.col("level")).cast("int").alias("level"))


def _chain_heads(nodes: DataFrame, single: DataFrame) -> DataFrame:
    """(call_id, head, steps): the first call without a single need on the way back, which is a call's own head if it
    has none or several. Calls that only lead to a cycle have no row."""
    end = F.col("need").isNull()
    state = nodes.join(single.select("call_id", "need"), "call_id", "left").select(
        "call_id", F.coalesce("need", "call_id").alias("head"), F.when(end, 0).otherwise(1).cast("long").alias("steps"),
        end.alias("done"))
    left = None
    while True:
        state = materialize(state, "chains")
        open_calls = state.where("NOT done").count()
        if not open_calls or open_calls == left:      # what no round shortens runs in circles
            return state.where("done").select("call_id", "head", "steps")
        left = open_calls
        further = state.select(F.col("call_id").alias("head"), F.col("head").alias("next"), F.col("steps").alias("more"),
                               F.col("done").alias("reached"))
        state = state.join(further, "head").select(
            "call_id", F.col("next").alias("head"), (F.col("steps") + F.col("more")).alias("steps"),
            (F.col("done") | F.col("reached")).alias("done"))


def _positions(rows: DataFrame, *order: Column | str) -> DataFrame:
    """Add ``position`` (from 0) within conv_id by ``order``; rows without conv_id are numbered together."""
    order = [F.col("conv_id"), *order]
    placed = materialize(rows.repartitionByRange(*order).sortWithinPartitions(*order).withColumn(
        "_id", F.monotonically_increasing_id()).withColumns({
            "_part": F.shiftright("_id", 33), "_place": F.col("_id").bitwiseAND(F.lit((1 << 33) - 1))}), "sorted-calls")
    spans = placed.groupBy("conv_id", "_part").agg(F.min("_place").alias("_first"), F.count(F.lit(1)).alias("_span"))
    earlier = Window.partitionBy("conv_id").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    shift = spans.select(F.col("conv_id").alias("_of"), F.col("_part").alias("_in"), (
        F.coalesce(F.sum("_span").over(earlier), F.lit(0)) - F.col("_first")).alias("_shift"))
    return placed.join(shift, F.col("conv_id").eqNullSafe(F.col("_of")) & (F.col("_part") == F.col("_in"))).withColumn(
        "position", F.col("_place") + F.col("_shift")).drop("_id", "_part", "_place", "_shift", "_of", "_in")


def link(calls: DataFrame, results: DataFrame, schemas: DataFrame) -> DataFrame:
    """One row per call: conv_id, position, call_id, level, n_results, valid, errors and its canonical ``message``.

    The first result of a call by turn and content is its answer; others are counted. Results without a call are the
    concern of :func:`orphans`. Calls without an identifier or conversation are left out. No calls give no rows.
    """
    calls = materialize(first_of_each(calls.where("call_id IS NOT NULL AND conv_id IS NOT NULL")), "calls")
    answers = results.groupBy("call_id").agg(
        F.min(F.struct("turn", "content")).alias("first"), F.count(F.lit(1)).alias("n_results"))
    rows = calls.join(answers, "call_id", "left").join(argument_errors(calls, schemas), "call_id", "left").join(
        levels(calls), "call_id", "left")
    empty = F.array().cast("array<string>")
    rows = rows.withColumns({"errors": F.coalesce("errors", empty), "n_results": F.coalesce("n_results", F.lit(0))})
    whole = ~F.array_contains("errors", "malformed")
    message = F.to_json(F.struct(
        F.when(whole, F.try_parse_json("arguments")).alias("arguments"), F.col("call_id"), F.col("errors"), F.col("name"),
        F.coalesce("needs", empty).alias("needs"), F.col("first.content").alias("result")))
    rows = rows.select("conv_id", "turn", "call_id", "level", "n_results", (F.size("errors") == 0).alias("valid"),
                       "errors", message.alias("message"))
    # Calls without a level come last.
    return _positions(rows, F.col("level").asc_nulls_last(), "turn", "call_id")


def orphans(calls: DataFrame, results: DataFrame) -> DataFrame:
    """Results whose call is not there."""
    return results.join(calls, "call_id", "left_anti")


def conversation_calls(conversations: DataFrame) -> DataFrame:
    calls, results = from_conversations(conversations)
    return link(calls, results, tools(conversations.sparkSession)).select(
        "conv_id", "position", "call_id", "turn", "level", "n_results", "valid",
        F.array_join("errors", ",").alias("errors"), "message")


def conversation_messages(conversations: DataFrame) -> DataFrame:
    """Every row of ``conversations`` as a message: calls, results of calls, and whatever is neither.

    Equal rows are one row with their number in ``n_rows``; a null text is an empty one. ``kind`` is call for the first
    row of a call by :func:`first_of_each`, repeat for others of the same conversation and turn, result for a user's
    turn after a call, and message for the rest, which includes rows without conv_id, turn or role. ``position`` follows
    turn, role and text; calls need earlier turns only, so they stand behind what they need. All results of a call are
    rows, the first is in the call's message as well.
    """
    rows = materialize(conversations.select(
        F.col("conv_id").cast("long"), F.col("turn").cast("long"), "role", F.coalesce("text", F.lit("")).alias("text")
    ).groupBy("conv_id", "turn", "role", "text").agg(F.count(F.lit(1)).alias("n_rows")), "turns")
    called = F.coalesce(F.expr("conv_id IS NOT NULL AND turn IS NOT NULL AND role = 'assistant'"), F.lit(False))
    calls = materialize(_said_as_calls(rows.where(called)).withColumn(
        "row_id", F.concat("call_id", F.lit("-"), F.sha2("text", 256))), "calls")
    firsts = first_of_each(calls)
    errors = argument_errors(
        calls.select(F.col("row_id").alias("call_id"), "name", "arguments"), tools(conversations.sparkSession))
    asked = F.coalesce(F.expr("conv_id IS NOT NULL AND turn IS NOT NULL AND role = 'user'"), F.lit(False))
    replies = rows.where(asked).withColumn("asked", _call_id(F.col("turn") - 1))
    rest = materialize(replies.join(firsts.select("call_id"), F.col("asked") == F.col("call_id"), "left").drop("asked").union(
        rows.where(~called & ~asked).withColumn("call_id", F.lit(None).cast("string"))), "turns")
    answers = rest.where("call_id IS NOT NULL").groupBy("call_id").agg(
        F.min("text").alias("result"), F.sum("n_rows").alias("n_results"))
    empty = F.array().cast("array<string>")
    said = calls.join(errors.select(F.col("call_id").alias("row_id"), "errors"), "row_id", "left").join(
        answers, "call_id", "left").join(levels(firsts), "call_id", "left").join(
        firsts.select("call_id", F.col("name").alias("_name"), F.col("arguments").alias("_arguments")), "call_id")
    said = said.withColumns({"errors": F.coalesce("errors", empty), "n_results": F.coalesce("n_results", F.lit(0))})
    whole = ~F.array_contains("errors", "malformed")
    first = (F.col("name") == F.col("_name")) & (F.col("arguments") == F.col("_arguments"))
    columns = ["conv_id", "turn", "role", "text", "n_rows", "kind", "call_id", "level", "n_results", "valid", "errors", "message"]
    said = said.select(
        "*", F.when(first, "call").otherwise("repeat").alias("kind"), (F.size("errors") == 0).alias("valid"),
        F.to_json(F.struct(
            F.when(whole, F.try_parse_json("arguments")).alias("arguments"), "call_id", F.col("text").alias("content"),
            "errors", "name", "needs", "result", "role")).alias("message"))
    said = said.withColumn("errors", F.array_join("errors", ",")).select(columns)
    none = {"level": "int", "n_results": "long", "valid": "boolean", "errors": "string"}
    rest = rest.withColumns({name: F.lit(None).cast(kind) for name, kind in none.items()}).withColumns({
        "kind": F.when(F.col("call_id").isNull(), "message").otherwise("result"),
        "message": F.to_json(F.struct("call_id", F.col("text").alias("content"), "role"))}).select(columns)
    return _positions(said.union(rest), F.col("turn").asc_nulls_last(), F.col("role").asc_nulls_last(), "text").select(
        "conv_id", "position", "turn", "role", "kind", "n_rows", "call_id", "level", "n_results", "valid", "errors", "message")


ORACLE = """
WITH c AS (SELECT conv_id, turn, role, coalesce(text, '') AS t, length(coalesce(text, '')) AS n FROM conversations
           WHERE conv_id IS NOT NULL AND turn IS NOT NULL),
a AS (SELECT conv_id, turn, 'call-' || conv_id || '-' || turn AS call_id, t, n, count(*) OVER (PARTITION BY conv_id, turn) AS copies,
      (['search', 'calculate', 'lookup'])[n % 3 + 1] AS name,
      EXISTS (SELECT 1 FROM c b WHERE b.conv_id = c.conv_id AND b.turn = c.turn - 2 AND b.role = 'assistant') AS follows
      FROM c WHERE role = 'assistant'),
r AS (SELECT conv_id, turn, count(*) AS n_results, min(t) AS result FROM c WHERE role = 'user' GROUP BY ALL),
l AS (SELECT *, turn // 2 AS step, turn % 2 AS side FROM a),
g AS (SELECT *, step - row_number() OVER (PARTITION BY conv_id, side ORDER BY step) AS run FROM l),
v AS (SELECT *, row_number() OVER (PARTITION BY conv_id, side, run ORDER BY step) - 1 AS level FROM g),
e AS (SELECT v.*, coalesce(n_results, 0) AS n_results, result,
      CASE WHEN n % 8 = 0 THEN ['malformed']
           WHEN name = 'search' THEN CASE n % 8 WHEN 1 THEN ['missing:limit'] WHEN 2 THEN ['type:limit'] ELSE [] END
           WHEN name = 'lookup' THEN CASE n % 8 WHEN 1 THEN [] ELSE ['unexpected:limit'] END
           ELSE list_concat(CASE n % 8 WHEN 1 THEN ['missing:limit'] ELSE [] END,
                list_concat(CASE n % 8 WHEN 2 THEN ['type:limit'] ELSE [] END, ['unexpected:exact'])) END AS errors
      FROM v LEFT JOIN r ON r.conv_id = v.conv_id AND r.turn = v.turn + 1)
SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY level, turn, call_id) - 1 AS position, call_id, turn,
       level::INTEGER AS level, n_results, len(errors) = 0 AS valid, array_to_string(errors, ',') AS errors,
       '{' || CASE WHEN n % 8 = 0 THEN '' ELSE '"arguments":{"exact":true,' || CASE n % 8 WHEN 1 THEN ''
           WHEN 2 THEN '"limit":"' || n || '",' ELSE '"limit":' || n || ',' END || '"query":' || to_json(t) || '},' END
       || '"call_id":"' || call_id || '","errors":' || to_json(errors) || ',"name":"' || name || '","needs":'
       || CASE WHEN follows THEN '["call-' || conv_id || '-' || (turn - 2) || '"]' ELSE '[]' END
       || CASE WHEN result IS NULL THEN '' ELSE ',"result":' || to_json(result) END || '}' AS message
FROM e
"""

MESSAGES_ORACLE = """
WITH c AS (SELECT conv_id, turn, role, coalesce(text, '') AS t, length(coalesce(text, '')) AS n, count(*) AS n_rows
           FROM conversations GROUP BY ALL),
k AS (SELECT DISTINCT conv_id, turn FROM c WHERE role = 'assistant' AND conv_id IS NOT NULL AND turn IS NOT NULL),
l AS (SELECT *, turn // 2 - row_number() OVER (PARTITION BY conv_id, turn % 2 ORDER BY turn) AS run FROM k),
v AS (SELECT conv_id, turn, row_number() OVER (PARTITION BY conv_id, turn % 2, run ORDER BY turn) - 1 AS level FROM l),
r AS (SELECT conv_id, turn, sum(n_rows) AS n_results, min(t) AS result FROM c WHERE role = 'user' GROUP BY ALL),
m AS (SELECT c.*, v.level, coalesce(r.n_results, 0) AS n_results, r.result, w.turn IS NOT NULL AS answers,
      (['search', 'calculate', 'lookup'])[n % 3 + 1] AS name,
      '{ "query" : ' || to_json(t) || CASE n % 8 WHEN 1 THEN '' WHEN 2 THEN ', "limit" : "' || n || '"'
          ELSE ', "limit" : ' || n END || CASE n % 8 WHEN 0 THEN '' ELSE ', "exact" : true }' END AS arguments
      FROM c LEFT JOIN v ON v.conv_id = c.conv_id AND v.turn = c.turn AND c.role = 'assistant'
      LEFT JOIN r ON r.conv_id = c.conv_id AND r.turn = c.turn + 1
      LEFT JOIN k w ON w.conv_id = c.conv_id AND w.turn = c.turn - 1 AND c.role = 'user'),
e AS (SELECT *, row_number() OVER (PARTITION BY conv_id, turn, role ORDER BY name, arguments) AS nth,
      CASE WHEN n % 8 = 0 THEN ['malformed']
           WHEN name = 'search' THEN CASE n % 8 WHEN 1 THEN ['missing:limit'] WHEN 2 THEN ['type:limit'] ELSE [] END
           WHEN name = 'lookup' THEN CASE n % 8 WHEN 1 THEN [] ELSE ['unexpected:limit'] END
           ELSE list_concat(CASE n % 8 WHEN 1 THEN ['missing:limit'] ELSE [] END,
                list_concat(CASE n % 8 WHEN 2 THEN ['type:limit'] ELSE [] END, ['unexpected:exact'])) END AS found,
      CASE WHEN level IS NOT NULL THEN 'call-' || conv_id || '-' || turn
           WHEN answers THEN 'call-' || conv_id || '-' || (turn - 1) END AS call_id FROM m)
SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS LAST, role NULLS LAST, t) - 1 AS position,
       turn, role, n_rows, call_id, level::INTEGER AS level,
       CASE WHEN level IS NULL THEN CASE WHEN answers THEN 'result' ELSE 'message' END
            WHEN nth = 1 THEN 'call' ELSE 'repeat' END AS kind,
       CASE WHEN level IS NOT NULL THEN n_results END AS n_results,
       CASE WHEN level IS NOT NULL THEN len(found) = 0 END AS valid,
       CASE WHEN level IS NOT NULL THEN array_to_string(found, ',') END AS errors,
       CASE WHEN level IS NULL THEN '{' || coalesce('"call_id":"' || call_id || '",', '') || '"content":' || to_json(t)
                || coalesce(',"role":' || to_json(role), '') || '}'
       ELSE '{' || CASE WHEN n % 8 = 0 THEN '' ELSE '"arguments":{"exact":true,' || CASE n % 8 WHEN 1 THEN ''
                WHEN 2 THEN '"limit":"' || n || '",' ELSE '"limit":' || n || ',' END || '"query":' || to_json(t) || '},' END
            || '"call_id":"' || call_id || '","content":' || to_json(t) || ',"errors":' || to_json(found)
            || ',"name":"' || name || '","needs":'
            || CASE WHEN level > 0 THEN '["call-' || conv_id || '-' || (turn - 2) || '"]' ELSE '[]' END
            || CASE WHEN result IS NULL THEN '' ELSE ',"result":' || to_json(result) END || ',"role":"assistant"}' END AS message
FROM e
"""
