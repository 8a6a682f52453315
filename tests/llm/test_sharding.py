import collections
import random
import zlib

import pandas as pd

from quizlens.llm import sharding as sh
from tests.llm.frames import documents, frame, prose


def test_shards_hold_whole_groups_and_even_bytes(spark, many_partitions):
    r = random.Random(2)
    rows = documents(1) + [(1000 + i, prose(r, r.randint(1, 300)), None, None, None, None, None) for i in range(600)]
    got = sh.shard_documents(frame(spark, rows), 5).collect()
    assert sorted((str(g.doc_id), g.size, g.text_crc32) for g in got) == sorted(
        (str(x[0]), len((x[1] or "").encode()) + 8, zlib.crc32((x[1] or "").encode())) for x in rows)
    load, slots, groups = collections.Counter(), collections.defaultdict(list), collections.defaultdict(set)
    for g in got:
        assert g.law == "bytes" and g.grown_shard is None and 0 <= g.shard < 5
        load[g.shard] += g.size
        slots[g.shard].append(g.slot)
        groups[g.size, g.text_crc32].add(g.shard)
    assert all(len(s) == 1 for s in groups.values())
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert max(load.values()) - min(load.values()) < 0.01 * sum(load.values()) / 5


def test_schedule_is_longest_first():
    r = random.Random(4)
    for _ in range(20):
        sizes = collections.Counter(r.choice([9, 10, 11, 500, 7000]) for _ in range(r.randint(1, 400)))
        classes = pd.DataFrame([(s, n, s * n) for s, n in sizes.items()], columns=["class", "groups", "bytes"])
        runs = sh.schedule(classes, 4)
        load = [0] * 4
        for size, some in runs.groupby("class"):
            assert some["first"].iloc[0] == 0
            for run, end in zip(some.itertuples(), [*some["first"][1:], sizes[size]]):
                load[run.shard] += size * (end - run.first)
        plain = [0] * 4
        for size in sorted(sizes.elements(), reverse=True):
            plain[plain.index(min(plain))] += size
        assert sum(load) == sum(plain) and max(load) <= max(plain) + 11


def test_classes_keep_order(spark):
    sizes = [*range(1, 5000), 2**20, 2**20 + 1, 2**31, 2**40, 2**60]
    df = spark.createDataFrame([(s,) for s in sizes], "s long")
    got = [r[0] for r in df.selectExpr(f"{sh.size_class('s')} AS c").collect()]
    assert got == sorted(got) and got[:2047] == sizes[:2047] and len(set(got[-3:])) == 3


def test_empty_table(spark):
    assert sh.shard_documents(frame(spark, [])).count() == 0


def test_rows_are_written_before_they_are_numbered(spark, many_partitions, monkeypatch):
    """A row's number must not depend on the order in which shuffled blocks arrive."""
    plans, number = [], sh.number_within

    def noted(df, *args):
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        return number(df, *args)

    monkeypatch.setattr(sh, "number_within", noted)
    assert sh.shard_documents(frame(spark, documents(1)), 5).count() == len(documents(1))
    assert len(plans) == 2 and all("FileScan" in p and "Exchange" not in p for p in plans)
