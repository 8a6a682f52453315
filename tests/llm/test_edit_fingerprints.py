import hashlib
import random

import numpy as np
import pytest

from quizlens.llm import edit_fingerprints as ef
from tests.llm.frames import documents, frame, prose


def walk(text):
    """The embedding one step at a time."""
    moves, digits, _ = ef._random()
    symbols = [int(c) for c in ef.characters(text)]
    octaves = 1
    while symbols and ef.OCTAVE * 2 ** (octaves - 1) < 3 * len(symbols):
        octaves += 1
    wanted = {int(s): k for k, s in enumerate(ef.sampled_steps(octaves))}
    out, at = ["-"] * len(wanted), 0
    for step in range(max(wanted) + 1):
        if at >= len(symbols):
            break
        if step in wanted:
            out[wanted[step]] = "0123456789abcdef"[digits[wanted[step], symbols[at]]]
        at += int(moves[step % ef.PERIOD, symbols[at]])
    filled = max([i for i, c in enumerate(out) if c != "-"], default=0)
    return "".join(out)[: (filled // ef.OCTAVE + 1) * ef.OCTAVE]


def test_side_by_side_equals_one_by_one():
    r = random.Random(1)
    texts = ["", "a", "ab" * 40, *[prose(r, r.randint(0, 300)) for _ in range(30)], "x\0y", "🙂" * 50]
    together = ef.fingerprints([ef.characters(t) for t in texts])
    assert together == [walk(t) for t in texts]
    assert together[::-1] == ef.fingerprints([ef.characters(t) for t in texts[::-1]])


def test_documents_equal_brute_force(spark, many_partitions):
    rows = documents(1)
    order = sorted(((r[0], r[1] or "") for r in rows), key=lambda x: (x[0] is not None, x[0] or 0, x[1]), reverse=True)
    expected = []
    for i, (doc_id, text) in enumerate(order):
        following = order[(i + 1) % len(order)][1]
        changed = text[: len(text) - len(text) // 3] + following[: len(text) // 3]
        a, b, c = ef.fingerprints([ef.characters(t) for t in (text, changed, following)])
        expected.append((doc_id, len(text), hashlib.sha256(changed.encode()).hexdigest(), a, b, ef.likeness(a, b), ef.likeness(a, c)))
    got = [tuple(r) for r in ef.fingerprint_documents(frame(spark, rows)).collect()]
    assert sorted(got, key=str) == sorted(expected, key=str)


def test_few_rows(spark):
    assert ef.fingerprint_documents(frame(spark, [])).count() == 0
    one, = ef.fingerprint_documents(frame(spark, documents(1)[:1])).collect()
    assert one.near_next == 1.0


def test_likeness_follows_edits():
    r = random.Random(5)
    near, far, light = [], [], []
    for _ in range(40):
        a, b = prose(r, 300), prose(r, 300)
        place = r.randrange(len(a))
        prints = ef.fingerprints([ef.characters(t) for t in (a, a[: len(a) * 2 // 3] + b[len(a) * 2 // 3 :], b, a[:place] + "zz" + a[place + 1 :])])
        near.append(ef.likeness(prints[0], prints[1]))
        far.append(ef.likeness(prints[0], prints[2]))
        light.append(ef.likeness(prints[0], prints[3]))
    assert min(near) > 0.5 and max(far) < 0.4 and np.median(light) > 0.85
    assert ef.likeness(prints[0], prints[0]) == 1.0 and ef.likeness("-" * 32, "-" * 32) == 1.0
    assert ef.likeness("-" * 32, prints[0]) == 0.0


def test_near_documents_finds_light_edits(spark, many_partitions):
    r = random.Random(6)
    rows, pairs = [], 0
    for i in range(60):
        text = prose(r, 200)
        rows.append((2 * i, text, None, None, None, None, None))
        if i % 3 == 0:
            rows.append((2 * i + 1, text[: len(text) - 20] + " changed end", None, None, None, None, None))
            pairs += 1
    prints = ef.fingerprint_documents(frame(spark, rows)).select("doc_id", "fingerprint")
    by_print = {r.fingerprint: r.doc_id for r in prints.collect()}
    found = {tuple(sorted((by_print[r.fingerprint], by_print[r.near]))) for r in ef.near_documents(prints).collect()}
    assert len(found) >= 0.9 * pairs and all(b == a + 1 for a, b in found)


def edits_of(r, text, kind, share):
    n, k = len(text), int(len(text) * share)
    at = {"head": 0, "tail": n - k}.get(kind, r.randrange(n - k + 1))
    if kind == "scattered":
        return "".join(c if (x := r.random()) > share / 15 else "" if x > share / 30 else r.choice("aeiou") + c for c in text)
    return text[:at] + ("" if kind == "cut" else prose(r, k)[:k]) + text[at + k :]


@pytest.mark.parametrize("kind", ["head", "middle", "tail", "cut", "scattered"])
def test_bands_find_what_all_pairs_find(kind):
    """Of pairs with a likeness of 0.8 or more at least 0.9 share a key, wherever the edit is and however long the text."""
    r = random.Random(kind)
    alike = found = 0
    for n in (700, 1000, 2000, 4000, 6000):
        for share in (0.02, 0.05, 0.1, 0.15, 0.2):
            for _ in range(8):
                text = prose(r, n)[: n + r.randrange(n // 3)]
                a, b = ef.fingerprints([ef.characters(t) for t in (text, edits_of(r, text, kind, share))])
                if a != b and ef.likeness(a, b) >= 0.8:
                    alike += 1
                    found += not set(ef.band_keys(a)).isdisjoint(ef.band_keys(b))
    assert alike >= 20 and found >= 0.9 * alike


def test_keys_of_short_and_empty_texts():
    r = random.Random(9)
    texts = [prose(r, 200)[:n] for n in (1, 2, 5, 15, 16, 17, 31, 40, 63, 64, 65, 127, 500)]
    for p in ef.fingerprints([ef.characters(t) for t in texts]):
        keys = ef.band_keys(p)
        assert len(keys) == 2 * ef.BANDS == len(set(keys)) and not any("-" in k.split(".")[2] for k in keys)
    assert ef.band_keys("-" * 32) == []


def changed_digits(r, text, share):
    """The fingerprint with some of its digits drawn anew."""
    return "".join(r.choice("0123456789abcdef") if r.random() < share else c for c in text)


def classes_of(values, linked):
    root = {v: v for v in values}

    def find(v):
        while root[v] != v:
            v = root[v]
        return v

    for a, b in linked:
        root[max(find(a), find(b))] = min(find(a), find(b))
    return {v: find(v) for v in values}


def test_near_documents_link_what_all_pairs_of_a_key_link(spark, many_partitions):
    r, values = random.Random(11), set()
    for size, share in ((3, 0.1), (4, 0.15), (4, 0.18), (40, 0.15), (90, 0.1), (30, 0.25)):
        base = changed_digits(r, "0" * 32 * r.choice([5, 7]), 1.0)
        values |= {changed_digits(r, base, share) for _ in range(size)}
    values = sorted(values)
    keys = {v: set(ef.band_keys(v)) for v in values}
    pairs = {(a, b): x for i, a in enumerate(values) for b in values[:i]
             if keys[a] & keys[b] and (x := ef.likeness(a, b)) >= 0.8}
    df = spark.createDataFrame([(v,) for v in values] + [(values[0],), (None,)], "fingerprint string")
    expected = classes_of(values, pairs)
    for block in (ef.BLOCK, 20):
        got = {(g.fingerprint, g.near): g.likeness for g in ef.near_documents(df, block=block).collect()}
        assert all(pairs[k] == x for k, x in got.items())
        assert classes_of(values, got) == expected


def test_thousands_of_near_copies_are_one_class():
    r = random.Random(12)
    base = changed_digits(r, "0" * 256, 1.0)
    members = sorted({changed_digits(r, base, 0.06) for _ in range(3000)} | {changed_digits(r, base, 1.0) for _ in range(200)})
    links = ef._forest(members, 0.8)
    got = classes_of(range(len(members)), [(i, j) for i, j, _ in links])
    rows = np.array([list(m.encode()) for m in members], np.uint8)
    weight = 2.0 ** np.maximum(0, np.arange(256) // ef.OCTAVE - 1)
    pairs = [(i, int(j)) for i in range(len(members)) for j in np.flatnonzero((rows[:i] == rows[i]) @ weight / weight.sum() >= 0.8)]
    assert got == classes_of(range(len(members)), pairs) and len(links) < len(members)


def test_query_names_the_class_of_every_document(spark, many_partitions):
    r = random.Random(13)
    base = prose(r, 400)
    texts = [base + f" {'x' * i} end" for i in range(12)] + [prose(r, 300) for _ in range(10)] + [base + " x end", None]
    rows = [(i, t, None, None, None, None, None) for i, t in enumerate(texts)] + [(None, base + " xx end", None, None, None, None, None)]
    got = ef.document_classes(frame(spark, rows)).collect()
    assert len(got) == len(rows)
    prints = {g.fingerprint for g in got}
    pairs = [(a, b) for a in prints for b in prints if b < a and set(ef.band_keys(a)) & set(ef.band_keys(b)) and ef.likeness(a, b) >= 0.8]
    root, least = classes_of(prints, pairs), {}
    for g in got:
        if g.doc_id is not None:
            least[root[g.fingerprint]] = min(g.doc_id, least.get(root[g.fingerprint], g.doc_id))
    assert all(g.near_class == least[root[g.fingerprint]] for g in got)
    assert len(set(least.values())) < len(prints)
    assert ef.document_classes(frame(spark, [])).count() == 0


def test_key_numbers_are_the_keys_of_the_search():
    r = random.Random(10)
    texts = ["", *[prose(r, 300)[:n] for n in (1, 2, 17, 64, 127, 500, 900, 1500)]]
    prints = ef.fingerprints([ef.characters(t) for t in texts])
    known = {}
    for p in prints:
        keys, numbers = ef.band_keys(p), ef.key_numbers(p).tolist()
        assert len(keys) == len(numbers) == len(set(numbers)) == (2 * ef.BANDS if p.strip("-") else 0)
        for key, number in zip(keys, numbers, strict=True):
            assert known.setdefault(key, number) == number
    assert len(set(known.values())) == len(known)


def test_keys_grow_with_the_corpus():
    """A digit more for every factor of eight, and as many keys as keep the chance of a pair of likeness 0.8."""
    assert ef.key_shape(0) == ef.key_shape(8**8) == (ef.BANDS, ef.KEY_DIGITS)
    assert ef.key_shape(8**8 + 1)[1] == 9 and ef.key_shape(10**18)[1] == 12
    for bands, digits in map(ef.key_shape, (1, 10**8, 10**9, 10**12)):
        assert 0.98 <= 1 - (1 - 0.8**digits) ** bands < 0.985
        widest = ef.key_numbers("f" * 32 * 40, bands, digits)
        assert len(set(widest.tolist())) == 2 * bands and widest.min() > 0


@pytest.mark.parametrize("repeated", [False, True])
def test_texts_travel_whole(spark, many_partitions, repeated):
    """Compressed where ids are unique, as they are where some occur twice."""
    rows = [(i, t, None, None, None, None, None) for i, t in enumerate(["", "é🙂" * 9, "x" * 100_000, "a\0b", None, "end"])]
    rows += [(3, "again", None, None, None, None, None)] * repeated
    ordered, squeezed = ef.with_next(frame(spark, rows))
    assert squeezed is not repeated
    got = {(r.doc_id, r.n_chars) for r in ef.fingerprint_documents(frame(spark, rows)).collect()}
    assert got == {(r[0], len(r[1] or "")) for r in rows}
