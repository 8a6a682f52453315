"""Small tables with the awkward cases every operator has to answer."""

from __future__ import annotations

import random

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, fingerprint string, kept int"
WORDS = "ab cd ef gh ij kl mn op qr st uv wx yz Aé ßü 日本 don't x. a-b 🙂".split()


def prose(r: random.Random, n: int) -> str:
    return "".join(r.choice(WORDS) + r.choice([" ", " ", "  ", "\n", "\t", "  "]) for _ in range(n))


def documents(seed: int = 1, n: int = 60) -> list[tuple]:
    """Nulls, empty texts, copies, near copies, shared passages, repeated rows, ids out of order, one long text."""
    r = random.Random(seed)
    passage, base = prose(r, 30), prose(r, 120)
    texts = [None, "", " \n\t ", "one", "two words", base, base, base + " end", "x " + base, "the " * 90,
             prose(r, 4000), prose(r, 50) + passage + prose(r, 40), passage + prose(r, 10), prose(r, 5) + passage]
    texts += [prose(r, r.randint(0, 200)) for _ in range(n - len(texts))]
    rows = [(i * 3, t, r.choice(["en", None]), r.choice(["a", "b", None]), None, "clash", 7) for i, t in enumerate(texts)]
    rows += [rows[5], rows[20], (None, base, None, None, None, None, None), (None, None, None, None, None, None, None)]
    r.shuffle(rows)
    return rows


def frame(spark, rows: list[tuple], partitions: int = 3):
    return spark.createDataFrame(rows, SCHEMA).repartition(partitions)
