"""Operator 13: spelling variants, words one edit apart, by Bloom-guided neighbourhoods.

Words are counted over all texts. The vocabulary goes into blocked Bloom filters, one per word length, that are broadcast;
their size has a fixed bound, beyond which they only let more through. Every word then generates its edits and probes the
filter of their length. An edit is known by a 64-bit hash put together from the word's, so no text is built for it. Only
edits the filters know are shuffled, to meet the vocabulary by that hash; there the edit is spelled out and compared, which
removes what the filters let through and what shares a hash by chance.

Of two words that differ by a deletion the longer one generates the shorter, of two that differ by a replacement the one
with the greater character generates the other. So every pair is found once, and then counted for both.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quizlens.operators.materialize import materialize

LEAST_LENGTH, LEAST_COUNT = 7, 2
#: A form is at least this many times as frequent as its variant.
FORM_TIMES = 10
#: One run in so many, by its checksum, loses a character.
DAMAGED = 31

#: Bits of a filter per word, bits set per word, and the size all filters together never exceed.
BITS_PER_WORD, BITS_SET = 24, 5
FILTER_BYTES = 32 << 20
LEAST_BLOCKS = 1024
#: Words of this length and longer share a filter.
LAST_SHARD = 64
#: Words a task counts before it passes its counts on, and edits probed at once.
COUNTED_WORDS, PROBED = 300_000, 1 << 21

RUN = re.compile("[a-zÀ-ÿ]{%d,}" % LEAST_LENGTH)     # A to Z have become small letters
LETTERS = np.array([*range(0x61, 0x7B), *range(0xC0, 0x100)], np.uint8)

_TERMS = np.random.Generator(np.random.PCG64(13)).integers(0, 1 << 63, 256, np.uint64) * np.uint64(2) + np.uint64(1)
_BASE = 0x9E3779B97F4A7C15
_INVERSE = np.uint64(pow(_BASE, -1, 1 << 64))


# Words


def add_words(doc_id: int | None, text: str | None, counts: Counter) -> None:
    """Count the words of a text; a document without an id counts as one with an empty id."""
    if not text:
        return
    start = zlib.crc32(f"{'' if doc_id is None else doc_id}:".encode())
    lowered = text.encode("utf-8", "surrogatepass").lower().decode("utf-8", "surrogatepass")    # A to Z only
    for run, n in Counter(RUN.findall(lowered)).items():
        checksum = zlib.crc32(run.encode(), start)
        if checksum % DAMAGED == 0:
            at = checksum % len(run)
            run = run[:at] + run[at + 1 :]
            if len(run) < LEAST_LENGTH:
                continue
        counts[run] += n


def vocabulary(docs: DataFrame) -> DataFrame:
    """Every word that occurs twice or more with its count, written."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter = Counter()

        def sums() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays(
                [pa.array(list(counts), pa.string()), pa.array(list(counts.values()), pa.int64())], names=["word", "n"])

        for batch in batches:
            for doc_id, text in zip(batch["doc_id"].to_pylist(), batch["text"], strict=True):
                add_words(doc_id, text.as_py(), counts)
                if len(counts) >= COUNTED_WORDS:
                    yield sums()
                    counts.clear()
        yield sums()

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return materialize(
        rows.mapInArrow(count, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))
        .where(F.col("n") >= LEAST_COUNT), "vocabulary")


# Hashes and filters


def by_length(words: list[str]) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(length, places in the list, characters as one row per word) of the words of each length."""
    places: dict[int, list[int]] = {}
    for i, word in enumerate(words):
        places.setdefault(len(word), []).append(i)
    for length, found in places.items():
        held = "".join(words[i] for i in found).encode("latin-1")
        yield length, np.array(found), np.frombuffer(held, np.uint8).reshape(len(found), length)


def _powers(length: int) -> np.ndarray:
    out = np.full(length, np.uint64(_BASE))
    out[:1] = 1
    return np.multiply.accumulate(out)


def hashes(codes: np.ndarray) -> np.ndarray:
    return (_TERMS[codes] * _powers(codes.shape[1])).sum(axis=1, dtype=np.uint64)


def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def places(h: np.ndarray, blocks: int) -> tuple[np.ndarray, np.ndarray]:
    """Block and bits within it of each hash."""
    mixed = _mixed(h)
    bits = np.zeros(len(h), np.uint64)
    for i in range(BITS_SET):
        bits |= np.uint64(1) << ((mixed >> np.uint64(6 * i)) & np.uint64(63))
    return ((mixed >> np.uint64(32)) * np.uint64(blocks) >> np.uint64(32)).astype(np.int64), bits


def block_counts(lengths: dict[int, int], most_bytes: int = FILTER_BYTES) -> dict[int, int]:
    """64-bit blocks of each filter, in proportion to its words, all together within ``most_bytes``."""
    words: dict[int, int] = {}
    for length, n in lengths.items():
        words[min(length, LAST_SHARD)] = words.get(min(length, LAST_SHARD), 0) + n
    wanted = {shard: max(LEAST_BLOCKS, -(-n * BITS_PER_WORD // 64)) for shard, n in words.items()}
    share = min(1.0, most_bytes / 8 / max(1, sum(wanted.values())))
    return {shard: max(1, int(n * share)) for shard, n in wanted.items()}


def filters(words: DataFrame) -> dict[int, np.ndarray]:
    """The filters of a written vocabulary. Tasks set bits, blocks are put together before and behind a shuffle, and the
    driver gets no more than the blocks, whose number is bounded."""
    sizes = words.groupBy(F.least(F.length("word"), F.lit(LAST_SHARD)).alias("shard")).count().collect()
    blocks = block_counts({r.shard: r["count"] for r in sizes})

    def bits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for length, _, codes in by_length(batch["word"].to_pylist()):
                shard = min(length, LAST_SHARD)
                block, mask = places(hashes(codes), blocks[shard])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(block), shard)), pa.array(block), pa.array(mask.view(np.int64))],
                    names=["shard", "block", "bits"])

    found = words.select("word").mapInArrow(bits, "shard long, block long, bits long").groupBy("shard", "block").agg(
        F.bit_or("bits").alias("bits")).toArrow()
    out = {shard: np.zeros(n, np.uint64) for shard, n in blocks.items()}
    shards, at, mask = (found[c].to_numpy() for c in ("shard", "block", "bits"))
    for shard, held in out.items():
        mine = shards == shard
        held[at[mine]] = mask[mine].view(np.uint64)
    return out


# Edits


def edits(codes: np.ndarray, shards: dict[int, np.ndarray]) -> Iterator[tuple[np.ndarray, ...]]:
    """(row, hash, place, letter) of the edits of words of one length that the filters know; letter 0 is a deletion.

    Deletions of one of equal neighbours are the same, so the first of them stands for all.
    """
    n, length = codes.shape
    powers = _powers(length)
    terms = _TERMS[codes] * powers
    upto = np.cumsum(terms, axis=1, dtype=np.uint64)
    whole = upto[:, -1]

    def known(h: np.ndarray, shard: int) -> np.ndarray:
        block, mask = places(h, len(shards[shard]))
        return np.flatnonzero(shards[shard][block] & mask == mask)

    shorter = min(length - 1, LAST_SHARD)
    if length > LEAST_LENGTH and shorter in shards:
        h = (upto - terms) + (whole[:, None] - upto) * _INVERSE
        first = np.ones(codes.shape, bool)
        first[:, 1:] = codes[:, 1:] != codes[:, :-1]
        row, at = np.nonzero(first)
        h = h[row, at]
        hit = known(h, shorter)
        yield row[hit], h[hit], at[hit], np.zeros(len(hit), np.uint8)
    shard = min(length, LAST_SHARD)
    if shard in shards:
        step = max(1, PROBED // (n * len(LETTERS)))
        for start in range(0, length, step):
            here = slice(start, start + step)
            row, at, letter = np.nonzero(codes[:, here, None] > LETTERS)
            at += start
            h = whole[row] - terms[row, at] + _TERMS[LETTERS[letter]] * powers[at]
            hit = known(h, shard)
            yield row[hit], h[hit], at[hit], LETTERS[letter[hit]]


def candidates(words: DataFrame, shards: dict[int, np.ndarray]) -> DataFrame:
    """word, n, and key (hash), place (from 0) and letter (empty: none) of every edit the filters know."""
    shared = words.sparkSession.sparkContext.broadcast(shards)

    def probe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["word", "n", "key", "place", "letter"]
        for batch in batches:
            for _, found, codes in by_length(batch["word"].to_pylist()):
                step = max(1, PROBED // codes.shape[1])
                for start in range(0, len(codes), step):
                    for row, h, at, letter in edits(codes[start : start + step], shared.value):
                        taken = pa.array(found[start + row])
                        letters = [chr(c) if c else "" for c in letter.tolist()]
                        yield pa.RecordBatch.from_arrays([
                            batch["word"].take(taken), batch["n"].take(taken), pa.array(h.view(np.int64)),
                            pa.array(at.astype(np.int32)), pa.array(letters, pa.string())], names=names)

    return words.select("word", "n").mapInArrow(probe, "word string, n long, key long, place int, letter string")


def with_keys(words: DataFrame) -> DataFrame:
    def compute(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = np.zeros(batch.num_rows, np.uint64)
            for _, found, codes in by_length(batch["other"].to_pylist()):
                keys[found] = hashes(codes)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(keys.view(np.int64))], names=["other", "other_n", "key"])

    return words.selectExpr("word AS other", "n AS other_n").mapInArrow(compute, "other string, other_n long, key long")


def near_pairs(words: DataFrame) -> DataFrame:
    """Pairs (word, n, other, other_n) one edit apart, each once, of a written vocabulary."""
    spelled = F.concat(F.expr("substring(word, 1, place)"), F.col("letter"), F.expr("substring(word, place + 2)"))
    return candidates(words, filters(words)).join(with_keys(words), "key").where(spelled == F.col("other")).select(
        "word", "n", "other", "other_n")


# Forms


def roots(forms: DataFrame) -> DataFrame:
    """The last of the forms that follow from each word of ``forms`` (word, form). Steps double, and a form is ten times as
    frequent as its word, so a few rounds are enough; each is written."""
    at = materialize(forms.selectExpr("word", "form AS root"), "roots")
    while True:
        next_ = at.selectExpr("word AS via", "root AS further")
        moved = materialize(at.join(next_, at["root"] == next_["via"], "left").select(
            "word", F.coalesce("further", "root").alias("root"), F.col("further").isNotNull().alias("moved")), "roots")
        if moved.where("moved").isEmpty():
            return at
        at = moved.drop("moved")


def spelling_variants(docs: DataFrame) -> DataFrame:
    """word, form, root, n, n_near, form_n of every word of ``docs`` (doc_id, text).

    Ties between forms go to the word smallest in code-point order. Null and empty texts have no words, repeated rows count
    each, no rows give no rows, and further columns are not looked at.
    """
    words = vocabulary(docs)
    pairs = near_pairs(words).select(F.explode(F.array(
        F.struct("word", F.col("other").alias("near"), F.col("other_n").alias("near_n")),
        F.struct(F.col("other").alias("word"), F.col("word").alias("near"), F.col("n").alias("near_n")))).alias("p")).select("p.*")
    best = pairs.groupBy("word").agg(
        F.count(F.lit(1)).alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("less"), "near")).alias("best"))
    known = words.join(best, "word", "left").selectExpr(
        "word", "n", "coalesce(n_near, 0L) AS n_near", f"-best.less >= {FORM_TIMES} * n AS has_form", "best")
    known = materialize(known.selectExpr(
        "word", "n", "n_near", "IF(has_form, best.near, NULL) AS form", "IF(has_form, -best.less, NULL) AS form_n"), "forms")
    last = roots(known.where("form IS NOT NULL"))
    return known.join(last, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
