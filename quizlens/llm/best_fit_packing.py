"""Operator 4: best-fit packing by large-item matching.

Documents become token ids (and a closing id 0), longer ones are cut into pieces of the capacity. Only the number of
pieces of each length decides the plan, at most ``capacity`` numbers whatever the input. Pieces over half a sequence
take the longest partner over a third that still fits; what is left over a third pairs up, so no sequence holds more
than two of them; shorter pieces, longest first, go to the tightest gap. The plan is made of runs ("the next m pieces
of this length go to m sequences in a row"), and every piece finds its place from its number among equal lengths.
"""

from __future__ import annotations

import os
import zlib
from bisect import bisect_left, insort
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain, compress

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quizlens.llm.bpe_codec import parts_of
from quizlens.llm.tables import number_within, with_run
from quizlens.llm.text_words import words
from quizlens.operators.materialize import materialize

CAPACITY = 2048
#: Documents whose words are looked up together.
DOCUMENTS = 500
#: Entries after which a task's table starts anew.
TABLE_ENTRIES = 300_000
#: ASCII signs that make one part with their neighbours; the apostrophe starts some parts of its own.
SIGNS = b".,;:!?|*#$%&-"
PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"


@lru_cache(maxsize=1)
def _tokenizer(path: str) -> tuple:
    """The tokenizer and which of its ids close a word; one per worker."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    tokenizer.no_truncation()
    tokenizer.no_padding()
    vocabulary = tokenizer.get_vocab(with_added_tokens=True)
    closes = np.zeros(max(vocabulary.values()) + 1, bool)
    closes[[i for s, i in vocabulary.items() if s.endswith("</w>")]] = True
    return tokenizer, closes


class WordIds:
    """Little-endian ids of words by the tokenizers library, which drops white space and never joins across it.

    New words are cut into the parts that the vocabulary encodes one by one, and new parts are encoded many at a time:
    the last id of each part carries the end-of-word suffix. Every task has tables of its own.
    """

    def __init__(self, path: str):
        self.tokenizer, self.closes = _tokenizer(path)
        self.words: dict[bytes, bytes] = {}
        self.parts: dict[str, bytes] = {}
        self.old_words: dict[bytes, bytes] = {}
        self.old_parts: dict[str, bytes] = {}

    def encode(self, text: str) -> bytes:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()

    def _learn_parts(self, parts: list[str]) -> None:
        for at in range(0, len(parts), 1000):
            some = parts[at : at + 1000]
            ids = np.array(self.tokenizer.encode(" ".join(some), add_special_tokens=False).ids, "<u4")
            ends = np.flatnonzero(self.closes[ids]) + 1
            if len(ends) == len(some) and ends[-1] == len(ids):
                data, ends = ids.tobytes(), (4 * ends).tolist()
                self.parts.update(zip(some, map(data.__getitem__, map(slice, [0, *ends], ends)), strict=False))
            else:
                self.parts.update((p, self.encode(p)) for p in some)

    def _learn(self, found: set[bytes]) -> None:
        """Make the ids of these words known; what the last table held is taken over once it is met again."""
        if len(self.parts) > TABLE_ENTRIES:
            self.parts, self.old_parts = {}, self.parts
        met = found.intersection(self.old_words)
        self.words.update(zip(met, map(self.old_words.__getitem__, met), strict=True))
        # Words of ASCII letters with signs at most behind them are one part or two, and most new words are.
        new_words = list(found.difference(met))
        cores = [w.rstrip(SIGNS) for w in new_words]
        plain = list(map(bytes.isalpha, cores))
        letters = b" ".join(compress(cores, plain)).lower().decode().split()
        signs = [w[len(c):].decode() for w, c, p in zip(new_words, cores, plain, strict=True) if p]
        cut = {w: self._cut(w) for w, p in zip(new_words, plain, strict=True) if not p}
        new = {p for parts in cut.values() if parts for p in parts}.union(letters, signs).difference(self.parts, [""])
        met = new.intersection(self.old_parts)
        self.parts.update(zip(met, map(self.old_parts.__getitem__, met), strict=True))
        self._learn_parts(list(new.difference(met)))
        known = self.parts.__getitem__
        self.words.update(zip(compress(new_words, plain), [
            known(a) + known(b) if b else known(a) for a, b in zip(letters, signs, strict=True)], strict=True))
        for word, parts in cut.items():
            self.words[word] = (self.encode(word.decode("utf-8", "surrogatepass")) if parts is None
                                else b"".join(map(known, parts)))

    def ids_of(self, found: list[bytes]) -> list[bytes]:
        """Ids of each of these words. A table that has grown large starts anew."""
        if len(self.words) > TABLE_ENTRIES:
            self.words, self.old_words = {}, self.words
        new = set(found).difference(self.words)
        if new:
            self._learn(new)
        return list(map(self.words.__getitem__, found))

    def _cut(self, word: bytes) -> list[str] | None:
        """Parts of a word; none where it may hold a special token."""
        return None if b"<|" in word else parts_of(word.decode("utf-8", "surrogatepass"))


def token_pieces(docs: DataFrame, path: str, capacity: int = CAPACITY) -> DataFrame:
    """One row per piece of at most ``capacity`` ids; a null or empty text is the closing id alone."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = WordIds(path)
        for batch in (whole.slice(at, DOCUMENTS) for whole in batches for at in range(0, whole.num_rows, DOCUMENTS)):
            rows, at_word = [], 0
            found = [words(t) for t in batch["text"].to_pylist()]
            known = table.ids_of(list(chain.from_iterable(found)))
            for doc_id, own in zip(batch["doc_id"].to_pylist(), found, strict=True):
                ids = b"".join(known[at_word : at_word + len(own)]) + bytes(4)
                at_word += len(own)
                for piece, at in enumerate(range(0, len(ids), 4 * capacity)):
                    part = ids[at : at + 4 * capacity]
                    rows.append((doc_id, piece, at // 4, len(part) // 4, zlib.crc32(part)))
            columns = zip(*rows, strict=True) if rows else [()] * 5
            types = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(columns, types, strict=True)],
                names=["doc_id", "piece", "start", "length", "ids_crc32"])

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(cut, PIECES)


def plan_runs(counts: dict[int, int], capacity: int = CAPACITY) -> pd.DataFrame:
    """Runs (length, first, each, sequence, offset): pieces of ``length`` from number ``first`` on fill sequences from
    ``sequence`` on, ``each`` of them in one sequence, the first of these at ``offset``."""
    left = {length: n for length, n in counts.items() if n}
    used = dict.fromkeys(left, 0)
    runs: list[tuple[int, int, int, int, int]] = []
    gaps: dict[int, list[tuple[int, int]]] = {}   # gap -> (first sequence, how many)
    gap_sizes: list[int] = []
    sequences = 0

    def take(length: int, n: int, each: int, sequence: int, offset: int) -> None:
        runs.append((length, used[length], each, sequence, offset))
        used[length] += n
        left[length] -= n

    def open_gap(gap: int, sequence: int, n: int) -> None:
        if gap and n:
            if gap not in gaps:
                gaps[gap] = []
                insort(gap_sizes, gap)
            gaps[gap].append((sequence, n))

    large = sorted(x for x in left if 3 * x > capacity)
    for length in reversed(large):
        while left[length]:
            fits = [x for x in large[: bisect_left(large, min(length, capacity - length) + 1)]
                    if left[x] >= 1 + (x == length)]
            partner = fits[-1] if fits else None
            if partner is None:
                n = left[length] if not fits else 1
                take(length, n, 1, sequences, 0)
                open_gap(capacity - length, sequences, n)
            else:
                n = left[length] // 2 if partner == length else min(left[length], left[partner])
                take(length, n, 1, sequences, 0)
                take(partner, n, 1, sequences, length)
                open_gap(capacity - length - partner, sequences, n)
            sequences += n

    for length in sorted((x for x in left if 3 * x <= capacity), reverse=True):
        while left[length]:
            at = bisect_left(gap_sizes, length)
            if at == len(gap_sizes):
                n = -(-left[length] // (capacity // length))
                open_gap(capacity, sequences, n)
                sequences += n
                continue
            gap = gap_sizes[at]
            sequence, n = gaps[gap].pop()
            if not gaps[gap]:
                del gaps[gap], gap_sizes[at]
            each = min(gap // length, left[length])
            m = min(n, left[length] // each)
            take(length, m * each, each, sequence, capacity - gap)
            open_gap(gap - each * length, sequence, m)
            open_gap(gap, sequence + m, n - m)
    return pd.DataFrame(runs, columns=["length", "first", "each", "sequence", "offset"]).sort_values(
        ["length", "first"], ignore_index=True)


def pack(pieces: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """Add sequence_id and offset to pieces with a ``length`` from 1 to ``capacity``; every row gets a place.

    Only the count of each length comes to the driver. Equal pieces are interchangeable, so repeated rows and ties need
    no rule. No rows give no sequences.
    """
    numbered = number_within(pieces, "length", "_number")
    counts = dict(numbered.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect())  # at most ``capacity`` rows
    runs = plan_runs(counts, capacity).rename(columns={"offset": "at"})
    nth = F.col("_number") - F.col("first")
    return with_run(numbered, "length", "_number", runs).select(
        *pieces.columns, (F.col("sequence") + F.floor(nth.cast("double") / F.col("each"))).alias("sequence_id"),
        (F.col("at") + nth % F.col("each") * F.col("length")).alias("offset"))


def pack_documents(docs: DataFrame, path: str, capacity: int = CAPACITY) -> DataFrame:
    return pack(materialize(token_pieces(docs, path, capacity), "pieces"), capacity)
