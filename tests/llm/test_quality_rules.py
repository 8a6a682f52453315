import re
from collections import Counter

import pytest

import __spark_entry__ as contract
from checks.compare import compare
from quizlens.llm import quality_rules as qr
from tests.conftest import SF_DIR
from tests.llm.frames import documents, frame


def brute(text):
    text = text or ""
    found = re.findall(r"[^\x20\x09-\x0D]+", text)
    windows = Counter(zip(found, found[1:], found[2:]))
    covered = {i + o for i in range(len(found) - 2) for o in range(3) if windows[tuple(found[i : i + 3])] > 1}
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return (len(found), sum(map(len, found)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(covered))


EXTRA = ["a b c a b c", "a b a b a b a", "x x x x", "x\nx\n \nx\ny", "#*$ %& |<>", "a b c d a b c", "日本 語 🙂 日本 語 🙂", "\x0b a\x0c\r\nb"]


def test_measures_equal_brute_force(spark, many_partitions):
    rows = documents(1) + [(500 + i, t, None, None, None, None, None) for i, t in enumerate(EXTRA)]
    got = qr.document_verdicts(frame(spark, rows)).collect()
    assert sorted((str(r.doc_id), tuple(r[m] for m in qr.MEASURES)) for r in got) == sorted((str(r[0]), brute(r[1])) for r in rows)
    for r in got:
        assert r.base_failed == (r.n_words < 50 or 100 * r.n_repeat_words > 50 * r.n_words)
        assert not (r.base_failed and r.kept)


def test_bad_host_takes_its_documents_and_small_ones_are_shrunk(spark, many_partitions):
    good = " ".join(f"word{i}" for i in range(60))
    rows = [(i, good, None, f"host{i % 9}", None, None, None) for i in range(450)]
    rows += [(1000 + i, good if i % 10 == 0 else "too short", None, "bad", None, None, None) for i in range(300)]
    rows += [(2000, "too short", None, "tiny", None, None, None), (2001, good, None, "tiny", None, None, None)]
    got = {r.doc_id: r for r in qr.document_verdicts(frame(spark, rows)).collect()}
    assert all(got[i].kept for i in range(450))
    assert not any(got[1000 + i].kept for i in range(300)) and got[1000].host_rate > 0.8
    assert got[2001].kept and got[2001].host_rate < 0.5


def test_prior_weight():
    assert qr.prior_weight(0, 0, 0, 0.0, 0.0, (1.0, 1000.0)) == 1000.0
    assert qr.prior_weight(100, 2, 5000, 0.0, 0.3, (1.0, 1000.0)) == 1000.0        # hosts alike
    assert qr.prior_weight(200, 2, 20000, 50.0, 0.5, (1.0, 1000.0)) == 1.0         # hosts all or nothing


def test_kept_documents_keep_columns(spark):
    rows = documents(1)
    df = frame(spark, rows).withColumnRenamed("kept", "n_words")
    out = qr.kept_documents(df)
    assert out.schema == df.schema
    assert {r.text for r in out.collect()} <= {r[1] for r in rows} - {None, "", "one"}


def test_empty_table(spark):
    assert qr.document_verdicts(frame(spark, [])).count() == 0


@pytest.mark.parametrize("name", ["op1_quality_rules", "op9_tool_calls"])
def test_equals_sql(spark, duck, name):
    assert compare(spark, duck, SF_DIR, name) is None


@pytest.mark.parametrize("name", ["op1_quality_rules", "op9_tool_calls"])
def test_no_python_in_the_plan(spark, name):
    plan = contract.queries()[name](spark, SF_DIR)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow|CartesianProduct", plan)


def test_columns_named_like_helpers_stay(spark):
    from quizlens.llm.tables import set_aside

    rows = [(1, "a b c a b c", "s", 5, 6, 7, 8, 9, 10), (2, None, None, None, None, None, None, None, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string, _q int, _H int, _s int, _p int, _host int, _host_fails int")
    measured = qr.measure(df)
    assert measured.columns[:9] == df.columns
    judged = qr.judged(df).collect()
    assert sorted((r.doc_id, r["_q"], r["_H"], r["_host"], r["_host_fails"]) for r in judged) == [(1, 5, 6, 9, 10), (2, None, None, None, None)]
    assert sorted(map(tuple, measured.select(df.columns).collect()), key=str) == sorted(rows, key=str)
    renamed, back = set_aside(spark.createDataFrame([(1, 2)], "_q int, _q_own int"), "_q")
    assert renamed.columns == ["_q_own_", "_q_own"] and renamed.withColumnsRenamed(back).columns == ["_q", "_q_own"]
