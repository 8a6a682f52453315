import hashlib
import random
import re

import numpy as np
import pytest

from quizlens.llm import substring_dedup as sd
from tests.llm.frames import documents, frame, prose


def brute(rows):
    """Every window of every document, in order of place."""
    seen, out = set(), []
    for doc_id, text in sorted(((r[0], r[1]) for r in rows),
                               key=lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, r[1] or "")):
        found = re.findall(r"[^\x20\x09-\x0D]+", text or "")
        gone = [False] * len(found)
        for i in range(len(found) - 19):
            window = tuple(found[i : i + 20])
            if window in seen:
                gone[i : i + 20] = [True] * 20
            seen.add(window)
        kept = " ".join(w for w, g in zip(found, gone) if not g)
        out.append((doc_id, len(found), sum(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return sorted(out, key=str)


@pytest.mark.parametrize("seed", [1, 2])
def test_equals_brute_force(spark, many_partitions, seed):
    rows = documents(seed)
    found = sd.removal_digests(frame(spark, rows)).collect()
    assert sorted(map(tuple, found), key=str) == brute(rows)


def test_many_shared_passages(spark, many_partitions):
    r = random.Random(5)
    passages = [prose(r, k) for k in (18, 19, 20, 21, 22, 29, 30, 31, 60)]
    rows = [(i, "".join(prose(r, r.randint(0, 25)) + r.choice(passages) for _ in range(4)), None, None, None, None, None)
            for i in range(150)]
    found = sd.removal_digests(frame(spark, rows)).collect()
    assert sorted(map(tuple, found), key=str) == brute(rows)


def test_texts_keep_columns_and_other_words(spark, many_partitions):
    rows = documents(3)
    df = frame(spark, rows)
    out = sd.without_repeats(df)
    assert out.schema == df.schema
    got = out.collect()
    assert len(got) == len(rows)
    digests = sorted((r.doc_id, hashlib.sha256(" ".join(re.findall(r"[^\x20\x09-\x0D]+", r.text or "")).encode()).hexdigest())
                     for r in got if r.doc_id is not None)
    assert digests == sorted((a, d) for a, _, _, d in brute(rows) if a is not None)
    untouched = {(a, d) for a, _, n, d in brute(rows) if not n}
    originals = {r[1] for r in rows}
    assert all(r.text in originals for r in got if (r.doc_id, hashlib.sha256(
        " ".join(re.findall(r"[^\x20\x09-\x0D]+", r.text or "")).encode()).hexdigest()) in untouched)


def test_empty_table(spark):
    assert sd.removal_digests(frame(spark, [])).count() == 0


def test_packed_arrays_come_back():
    for dtype in (np.uint32, np.uint64):
        values = np.sort(np.random.default_rng(1).integers(0, np.iinfo(dtype).max, 1000, dtype=dtype))
        for part in (values, values[:0], values[:1]):
            assert (sd.unpack(sd.pack(part), dtype) == part).all()


def test_cut_words():
    assert sd.cut_words("a  b\nc d", np.array([False, True, True, False])) == "a  d"


def test_columns_named_like_helpers_stay(spark, many_partitions):
    rows = [(*r[:2], i, f"x{i}") for i, r in enumerate(documents(3))]
    df = spark.createDataFrame(rows, "doc_id long, text string, _substring_id int, _SUBSTRING_BATCH string").repartition(3)
    out = sd.without_repeats(df)
    assert out.schema == df.schema
    assert sorted((r["_substring_id"], r["_SUBSTRING_BATCH"]) for r in out.collect()) == sorted(r[2:] for r in rows)


def test_all_ids_null(spark, many_partitions):
    rows = [(None, r[1], *r[2:]) for r in documents(4)]
    got = sd.removal_digests(frame(spark, rows, 7)).collect()
    assert sorted(map(tuple, got), key=str) == brute(rows)
