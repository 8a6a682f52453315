import math
import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from quizlens.llm import hard_negatives as hn

SCHEMA = "vec_id long, embedding array<float>, label int, length double, cluster string"


def brute_force(rows):
    held = {}
    for vec_id, vector, label, *_ in rows:
        if vec_id is None or label is None or vector is None or any(x is None or not math.isfinite(x) for x in vector):
            continue
        q = [math.floor(256 * float(np.float32(x))) for x in vector]
        row = (int(math.fmod(label + 1, 10)) if vec_id % 7 == 0 else label, q)
        held[vec_id] = min(held.get(vec_id, row), row)
    score = lambda a, b: sum(x * y for x, y in zip(held[a][1], held[b][1]))
    out = []
    for a in held:
        if a % 100:
            continue
        others = [(-score(a, b), b) for b in held if b != a]
        positives = sorted(x for x in others if held[x[1]][0] == held[a][0])[:5]
        for p, pid in positives:
            hard = sorted(x for x in others if held[x[1]][0] != held[a][0] and 30 * -p <= 100 * -x[0] <= 90 * -p)[:10]
            out += [(a, pid, i + 1, n, -p, -s) for i, (s, n) in enumerate(hard)]
    return sorted(out)


def embedding_rows(seed=1, n=700, width=8, labels=4):
    """Clusters of directions, very different lengths, copies of one vector, ties, and every kind of row left out."""
    r = random.Random(seed)
    centres = [[r.gauss(0, 1) for _ in range(width)] for _ in range(6)]
    rows = []
    for i in range(n):
        c = r.choice(centres)
        size = r.choice([0.02, 0.1, 0.1, 3.0])
        v = [size * (x + r.gauss(0, 0.4)) for x in c]
        if i % 3 == 0:
            v = [0.1 * x for x in centres[0]]
        rows.append((i * 5 - 300, v, r.randrange(labels), 1.0, "clash"))
    nan, inf = float("nan"), float("inf")
    rows += [(None, [1.0] * width, 1, None, None), (100_000, None, 1, None, None), (100_100, [1.0] * width, None, None, None),
             (100_200, [nan] * width, 1, None, None), (100_300, [inf] + [0.0] * 3, 1, None, None),
             (100_400, [None, 1.0], 1, None, None), (100_500, [], 1, None, None), (100_600, [2.0, 1.0], 2, None, None),
             (100_700, [0.0] * width, 0, None, None), (100_800, [-5.0] * width, 3, None, None), rows[0], rows[0],
             (rows[1][0], [9.0] * width, 9, None, None)]
    r.shuffle(rows)
    return rows


def got(df):
    return sorted(tuple(r) for r in df.collect())


@pytest.mark.parametrize("sizes", [None, dict(FIRST=40, SLICE=16, GROUP=2, STRIDE=8, STEPS=64, PER_CENTRE=2)])
def test_equals_brute_force(spark, many_partitions, monkeypatch, sizes):
    """Also in many rounds, slices and groups."""
    for name, value in (sizes or {}).items():
        monkeypatch.setattr(hn, name, value)
    rows = embedding_rows()
    want = brute_force(rows)
    assert len(want) > 300
    df = hn.mined_embeddings(spark.createDataFrame(rows, SCHEMA).repartition(3))
    assert df.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    assert got(df) == want


def test_without_anchors_or_rows(spark):
    few = [(7, [1.0], 1, None, None), (8, [2.0], 1, None, None)]
    assert hn.mined_embeddings(spark.createDataFrame(few, SCHEMA)).count() == 0
    assert hn.mined_embeddings(spark.createDataFrame([], SCHEMA)).count() == 0
    alone = [(100, [1.0], 1, None, None), (8, [0.5], 2, None, None)]
    assert hn.mined_embeddings(spark.createDataFrame(alone, SCHEMA)).count() == 0


def test_bounds_hold_and_lists_are_left_early(spark):
    """No score exceeds the bound of its step; of rows in clear clusters most of a list is never walked."""
    r = np.random.Generator(np.random.PCG64(4))
    centres = r.normal(size=(20, 16))
    vectors = np.round(400 * (centres[np.arange(6000) % 20] + 0.05 * r.normal(size=(6000, 16)))).astype(int)
    rows = [(i, i % 2, v.tolist()) for i, v in enumerate(vectors)]
    df = spark.createDataFrame(rows, "vec_id long, label int, vector array<long>")
    lists = hn.build_lists(df, F.col("vec_id") % 50 == 0)
    k = len(lists.counts)
    listed = lists.rows.collect()
    ids = np.array([x.vec_id for x in listed])
    steps = np.array([np.frombuffer(x.steps, "<u2") for x in listed]).astype(int)
    assert lists.counts.sum() == k * len(rows)
    members = lists.members.collect()
    for m in members:
        score = vectors[ids] @ np.frombuffer(m.vector, lists.kind)
        assert (score <= m.length * lists.edge()(steps[:, m.cluster]) + 1e-6).all()
    walkers = pa.table({
        "anchor": [members[0].vec_id], "slot": [0], "low": [hn.NOTHING], "high": [-hn.NOTHING], "worst": [hn.NOTHING],
        "vector": [bytes(members[0].vector)], "label": [members[0].label], "length": [members[0].length]})
    walked = []
    entries = pa.table({"vec_id": ids, "label": ids % 2, "vector": [vectors[i].astype(lists.kind).tobytes() for i in ids],
                        "step": steps[:, members[0].cluster]})

    def bound(step):
        walked.append(step)
        return lists.edge()(step)

    hn.walk_slice(walkers, entries, 16, lists.kind, bound, 5, True)
    assert len(walked) * hn.STRIDE < len(rows) / 2


def test_great_numbers_are_exact():
    a = np.array([[2**31 + 1, 3]])
    assert hn.scores(a, a).tolist() == [[(2**31 + 1) ** 2 + 9]]
    assert hn.scores(np.array([[5, -3]]), np.array([[2, 4], [0, 0]])).tolist() == [[-2, 0]]
