import collections
import random
import re
import zlib

import numpy as np
import pytest

from quizlens.llm import queries, spelling
from tests.conftest import SF_DIR
from tests.llm.frames import SCHEMA, documents, frame


def brute_words(rows):
    counts = collections.Counter()
    for doc_id, text, *_ in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(c.lower() if c.isascii() else c for c in run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % 31 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            counts[run] += 1
    return {w: n for w, n in counts.items() if n >= 2 and len(w) >= 7}


def one_edit(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    if len(a) > len(b):
        a, b = b, a
    if len(b) - len(a) != 1:
        return False
    i = 0
    while i < len(a) and a[i] == b[i]:
        i += 1
    return a[i:] == b[i + 1 :]


def brute_force(rows):
    words = brute_words(rows)
    by_length = collections.defaultdict(list)
    for w in words:
        by_length[len(w)].append(w)
    near, form = {}, {}
    for w, n in words.items():
        near[w] = [o for k in (-1, 0, 1) for o in by_length[len(w) + k] if one_edit(w, o)]
        best = min(near[w], key=lambda o: (-words[o], o), default=None)
        form[w] = best if best is not None and words[best] >= 10 * n else None
    out = []
    for w, n in words.items():
        root = w
        while form[root] is not None:
            root = form[root]
        out.append((w, form[w], root, n, len(near[w]), words[form[w]] if form[w] else None))
    return sorted(out)


def misspelt(seed=3):
    """Texts of few stems with many edits, so that forms chain; accents, capitals, repeated letters, long runs."""
    r = random.Random(seed)
    stems = ["letterbox", "Bookkeeper", "ÀÉÎõüÿêë", "aaaaaaaa", "committee", "x" * 70, "ab" * 400, "straßenbahn", "naïveté÷×"]
    rows = []
    for i in range(120):
        text = []
        for _ in range(60):
            w = r.choice(stems[: 1 + i % len(stems)])
            for _ in range(r.choice([0, 0, 0, 1, 1, 2])):
                at = r.randrange(len(w))
                w = w[:at] + r.choice(["", r.choice("aekstxéß"), w[at] + r.choice("aoé")]) + w[at + 1 :]
            text.append(w)
        rows.append((i, r.choice([" ", "-", "\n", "1"]).join(text), None, None, None, "clash", 7))
    rows += [(500 + i, "letterbox " * 3000, None, None, None, None, None) for i in range(3)]
    rows += [(None, None, None, None, None, None, None), (None, "letterbox committee", None, None, None, None, None), (7, "", None, None, None, None, None), rows[3], rows[3]]
    return rows


def got(df):
    return sorted((r.word, r.form, r.root, r.n, r.n_near, r.form_n) for r in df.collect())


@pytest.mark.parametrize("most", [spelling.FILTER_BYTES, 64])
def test_equals_brute_force(spark, many_partitions, monkeypatch, most):
    """A filter that is far too small only lets more through."""
    monkeypatch.setattr(spelling, "block_counts", lambda lengths, f=spelling.block_counts: f(lengths, most))
    rows = misspelt()
    want = brute_force(rows)
    assert len(want) > 300 and len({x[2] for x in want}) < len(want)
    assert any(x[1] != x[2] for x in want if x[1])           # a form that has a form
    assert got(spelling.spelling_variants(frame(spark, rows, 5))) == want


def test_query_equals_brute_force_over_whole_texts(spark):
    rows = spark.read.parquet(f"{SF_DIR}/documents.parquet").select("doc_id", "text").collect()
    assert got(queries.op13_spelling_variants(spark, SF_DIR)) == brute_force([tuple(r) for r in rows])


def test_awkward_and_empty_tables(spark):
    assert got(spelling.spelling_variants(frame(spark, documents(2)))) == brute_force(documents(2))
    assert spelling.spelling_variants(spark.createDataFrame([], SCHEMA)).count() == 0
    none = [(1, None, None, None, None, None, None), (2, "short words only", None, None, None, None, None)]
    assert spelling.spelling_variants(frame(spark, none)).count() == 0


def test_edits_hash_like_the_words_they_spell():
    r = random.Random(5)
    words = ["".join(r.choice("abcé") for _ in range(9)) for _ in range(40)]
    codes = np.frombuffer("".join(words).encode("latin-1"), np.uint8).reshape(len(words), 9)
    everything = {shard: np.full(8, ~np.uint64(0)) for shard in (8, 9)}
    seen = collections.defaultdict(set)
    for row, h, at, letter in spelling.edits(codes, everything):
        for i, x, p, c in zip(row.tolist(), h.tolist(), at.tolist(), letter.tolist()):
            w = words[i][:p] + (chr(c) if c else "") + words[i][p + 1 :]
            assert int(spelling.hashes(np.frombuffer(w.encode("latin-1"), np.uint8)[None])[0]) == x
            assert w not in seen[i]
            seen[i].add(w)
    for i, w in enumerate(words):
        shorter = {w[:p] + w[p + 1 :] for p in range(9)}
        other = {w[:p] + chr(c) + w[p + 1 :] for p in range(9) for c in spelling.LETTERS if c < ord(w[p])}
        assert seen[i] == shorter | other


def test_filters_stay_within_their_bound():
    blocks = spelling.block_counts({length: 10**9 for length in range(7, 500)})
    assert sum(blocks.values()) * 8 <= spelling.FILTER_BYTES and max(blocks) == spelling.LAST_SHARD
    few = spelling.block_counts({7: 10})
    assert few == {7: spelling.LEAST_BLOCKS}


def test_few_chance_hits():
    """Of edits of random words that the vocabulary does not hold, less than one in two hundred passes."""
    r = np.random.Generator(np.random.PCG64(1))
    codes = spelling.LETTERS[r.integers(0, 26, (50_000, 10))]
    blocks = spelling.block_counts({10: len(codes)})[10]
    held = np.zeros(blocks, np.uint64)
    at, bits = spelling.places(spelling.hashes(codes), blocks)
    np.bitwise_or.at(held, at, bits)
    probes = codes[:2000]
    passed = sum(len(x[0]) for x in spelling.edits(probes, {10: held}))
    assert passed < 2000 * 130 / 200
