import json

from checks.compare import compare
from quizlens.llm import tool_calls as tc
from tests.conftest import SF_DIR

SCHEMAS = [("add", "a", "number", True), ("add", "b", "number", True), ("add", "note", "string", False),
           ("find", "where", "object", False), ("find", "tags", "array", True)]


def linked(spark, calls, results=()):
    rows = tc.link(spark.createDataFrame(calls, tc.CALLS), spark.createDataFrame(list(results), tc.RESULTS),
                   spark.createDataFrame(SCHEMAS, tc.TOOLS)).collect()
    return {r.call_id: r for r in rows}


def test_order_follows_needs(spark, many_partitions):
    needs = {"a": ["d"], "b": ["a", "c"], "c": [], "d": [], "e": ["b", "missing"], "x": ["y"], "y": ["x"], "z": ["x"], "s": ["s"]}
    calls = [(k, 1, n, "add", '{"a":1,"b":2}', v) for n, (k, v) in enumerate(needs.items())]
    calls += [(f"o{i}", 2, 5, "add", None, None) for i in range(4)]
    got = linked(spark, calls)
    assert {k: got[k].level for k in needs} == {"c": 0, "d": 0, "a": 1, "b": 2, "e": 3, "x": None, "y": None, "z": None, "s": None}
    assert [k for k in sorted(needs, key=lambda k: got[k].position)] == ["c", "d", "a", "b", "e", "x", "y", "z", "s"]
    assert sorted(got[f"o{i}"].position for i in range(4)) == [0, 1, 2, 3]
    assert got["o0"].position == 0 and got["o3"].position == 3


def test_arguments_are_held_against_schemas(spark):
    arguments = {
        "ok": ("add", ' { "b" : 1.5e0, "a" : -2 } ', []), "short": ("add", '{"a":1}', ["missing:b"]),
        "kind": ("add", '{"a":"1","b":true,"note":"n"}', ["type:a", "type:b"]), "more": ("add", '{"a":1,"b":2,"c":3}', ["unexpected:c"]),
        "text": ("add", '"a"', ["malformed"]), "cut": ("add", '{"a":1', ["malformed"]), "none": ("add", None, ["malformed"]),
        "deep": ("find", '{"tags":["x",{"b":1,"a":2}],"where":{"z":1,"y":null}}', []), "null": ("find", '{"tags":null}', ["type:tags"]),
        "tool": ("fly", "{}", ["unknown tool"]), "empty": ("add", "{}", ["missing:a", "missing:b"]),
    }
    got = linked(spark, [(k, 1, 0, n, a, []) for k, (n, a, _) in arguments.items()])
    assert {k: got[k].errors for k in arguments} == {k: e for k, (_, _, e) in arguments.items()}
    assert got["deep"].message == (
        '{"arguments":{"tags":["x",{"a":2,"b":1}],"where":{"y":null,"z":1}},"call_id":"deep","errors":[],"name":"find","needs":[]}')


def test_results_are_linked_once(spark):
    calls = [("a", 1, 0, "add", '{"a":1,"b":2}', []), ("a", 1, 0, "add", '{"a":1,"b":2}', []), ("a", 1, 9, "add", "{}", []),
             ("b", 1, 1, "add", '{"a":1,"b":2}', ["a"]), (None, 1, 1, "add", "{}", []), ("c", None, 1, "add", "{}", [])]
    results = [("a", 2, "later"), ("a", 1, "first \"quoted\"\n"), ("none", 1, "lost"), ("b", None, None)]
    got = linked(spark, calls, results)
    assert got.keys() == {"a", "b"} and got["a"].n_results == 2 and got["b"].level == 1
    assert json.loads(got["a"].message)["result"] == "first \"quoted\"\n"
    assert "result" not in json.loads(got["b"].message)
    lost = tc.orphans(spark.createDataFrame(calls, tc.CALLS), spark.createDataFrame(results, tc.RESULTS))
    assert [r.call_id for r in lost.collect()] == ["none"]


def test_conversations_with_gaps(spark):
    rows = [(1, 0, "user", "hi", 1), (1, 1, "assistant", None, 1), (1, 2, "user", None, 1), (1, 3, "assistant", 'say "x"\n', 1),
            (1, 3, "assistant", 'say "x"\n', 1), (None, 1, "assistant", "x", 1), (2, None, "assistant", "x", 1), (2, 1, None, "x", 1)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, level int")
    got = {r.call_id: r for r in tc.conversation_calls(df).collect()}
    assert got.keys() == {"call-1-1", "call-1-3"}
    assert (got["call-1-1"].level, got["call-1-3"].level) == (0, 1)
    assert got["call-1-1"].n_results == 1 and json.loads(got["call-1-1"].message)["result"] == ""
    assert tc.conversation_calls(df.limit(0)).count() == 0


def test_long_chains_and_joins_of_chains(spark):
    calls = [(f"k{i}", 1, i, "add", "{}", [f"k{i - 1}"] if i else []) for i in range(200)]
    calls += [("m", 1, 300, "add", "{}", ["k10", "k150"]), ("n", 1, 301, "add", "{}", ["m"]), ("o", 1, 302, "add", "{}", ["n", "k199"]),
              ("p", 1, 303, "add", "{}", ["o", "q"]), ("q", 1, 304, "add", "{}", ["p"])]
    got = {r.call_id: r.level for r in tc.levels(spark.createDataFrame(calls, tc.CALLS)).collect()}
    assert got == {f"k{i}": i for i in range(200)} | {"m": 151, "n": 152, "o": 200}


def test_every_row_of_a_conversation_is_a_message(spark, many_partitions):
    rows = [(1, 0, "system", "be kind"), (1, 1, "user", "hi"), (1, 2, "user", "hi again"), (1, 3, "assistant", "first"),
            (1, 3, "assistant", "second one"), (1, 3, "assistant", "first"), (1, 4, "user", "b"), (1, 4, "user", "a"),
            (1, 4, "user", "b"), (1, 5, "assistant", None), (2, 0, "system", "alone"), (2, 1, "user", "no answer"),
            (None, 1, "assistant", "x"), (3, None, "user", "y"), (3, 1, None, "z"), (3, 2, "user", "after z")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    got = tc.conversation_messages(df).collect()
    assert sum(r.n_rows for r in got) == len(rows) and len(got) == len(rows) - 2
    contents = {(r.conv_id, r.turn, r.role, json.loads(r.message)["content"]) for r in got}
    assert contents == {(c, t, role, text or "") for c, t, role, text in rows}
    kinds = {(r.conv_id, r.turn, json.loads(r.message)["content"]): r.kind for r in got}
    assert [kinds[1, 3, x] for x in ("first", "second one")].count("call") == 1 and kinds[1, 4, "b"] == kinds[1, 4, "a"] == "result"
    assert kinds[1, 2, "hi again"] == kinds[2, 1, "no answer"] == kinds[3, 2, "after z"] == kinds[None, 1, "x"] == "message"
    assert [r.turn for r in sorted((r for r in got if r.conv_id == 1), key=lambda r: r.position)] == [0, 1, 2, 3, 3, 4, 4, 5]
    assert {r.n_results for r in got if r.turn == 3 and r.conv_id == 1} == {3}
    assert tc.conversation_messages(df.limit(0)).count() == 0


def test_messages_equal_sql(spark, duck):
    assert compare(spark, duck, SF_DIR, "op9_conversation_messages") is None
