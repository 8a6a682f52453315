import collections
import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from quizlens.llm import best_fit_packing as bp
from tests.llm.frames import documents, frame

PATH = public_tokenizers.path("word_bpe_49k.json")


def check_places(rows, capacity):
    """Sequences without gaps or overlaps; returns their number."""
    held = collections.defaultdict(list)
    for r in rows:
        held[r.sequence_id].append((r.offset, r.length))
    for places in held.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= capacity
    return len(held)


@pytest.mark.parametrize("capacity", [1, 7, 64])
def test_pieces_and_places(spark, many_partitions, capacity):
    rows = documents(1)
    got = bp.pack_documents(frame(spark, rows), PATH, capacity).collect()
    tokenizer = Tokenizer.from_file(PATH)
    expected = []
    for doc_id, text in ((r[0], r[1]) for r in rows):
        ids = [*tokenizer.encode(text or "", add_special_tokens=False).ids, 0]
        for n, at in enumerate(range(0, len(ids), capacity)):
            part = np.array(ids[at : at + capacity], "<u4")
            expected.append((doc_id, n, at, len(part), zlib.crc32(part.tobytes())))
    assert sorted(map(str, (tuple(r)[:5] for r in got))) == sorted(map(str, expected))
    assert check_places(got, capacity) <= sum(r.length for r in got) // capacity * 1.1 + 2


def test_plan_is_tight_and_pairs_large_pieces():
    r = random.Random(3)
    for capacity in (7, 20, 2048):
        lengths = [min(capacity, max(1, int(r.expovariate(4 / capacity)))) for _ in range(3000)]
        counts = collections.Counter(lengths)
        runs = bp.plan_runs(dict(counts), capacity)
        held, placed = collections.defaultdict(list), collections.Counter()
        for length, some in runs.groupby("length"):
            ends = [*some["first"][1:], counts[length]]
            for run, end in zip(some.itertuples(), ends):
                for n in range(end - run.first):
                    held[run.sequence + n // run.each].append((run.offset + n % run.each * length, length))
                    placed[length] += 1
        assert placed == counts
        for places in held.values():
            assert sum(3 * length > capacity for _, length in places) <= 2
            assert [o for o, _ in sorted(places)] == [0, *np.cumsum([n for _, n in sorted(places)])[:-1]]
        assert len(held) <= -(-sum(lengths) // capacity) * 1.01 + 1


def test_empty_table(spark):
    assert bp.pack_documents(frame(spark, []), PATH).count() == 0


def test_odd_texts_encode_as_a_whole():
    tokenizer, ids = Tokenizer.from_file(PATH), bp.WordIds(PATH)
    r = random.Random(1)
    texts = ["".join(r.choice("aAeéßΣσ's<|>endoftext  12½日´̈ǅ\t\n /w") for _ in range(200)) for _ in range(200)]
    texts += ["<|endoftext|>x<|startoftext|> a<|endoftext|>", "It's I'll don''t", "</w> a</w>b", "İ K ﬁ ½", ""]
    for text in texts:
        own = np.frombuffer(b"".join(ids.ids_of(text.encode().split())), "<u4").tolist()
        assert own == tokenizer.encode(text, add_special_tokens=False).ids


def test_tables_that_start_anew_give_the_same_ids(monkeypatch):
    monkeypatch.setattr(bp, "TABLE_ENTRIES", 5)
    tokenizer, ids = Tokenizer.from_file(PATH), bp.WordIds(PATH)
    r = random.Random(2)
    for _ in range(60):
        found = ["".join(r.choice("abcé.,'1") for _ in range(3)) for _ in range(r.randint(1, 9))]
        own = np.frombuffer(b"".join(ids.ids_of([w.encode() for w in found])), "<u4").tolist()
        assert own == tokenizer.encode(" ".join(found), add_special_tokens=False).ids
