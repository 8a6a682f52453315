"""Operator 5: exact substring deduplication with fixed-block anchors.

Every document is cut into non-overlapping blocks of ten words, the index. Any twenty equal words contain a whole block
of each document, so every rolling window of ten words probes that index, and what is hit is extended: the windows of
twenty words around a hit are compared, runs of equal ones being the maximal exact repeats. Words of a window that also
starts earlier are removed.

Documents are dealt by ranges of doc_id ("batches"), so an earlier batch is an earlier place. Hashes travel as sorted
packed arrays, one per batch and bucket of the hash, each distinct hash of a batch once. A passage that a third of all
documents share costs one entry per batch, and no pair of documents is ever formed. The answer to a batch is the list
of its hashes that matter.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quizlens.llm.tables import parallelism, set_aside
from quizlens.llm.text_words import WordTable, words

WINDOW = 20
BLOCK = (WINDOW + 1) // 2
ORDER, PART = "_substring_id", "_substring_batch"
CELL = "bucket int, batch int, cell binary, flags binary"
NEXT, OTHER = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)


def pack(values: np.ndarray) -> bytes:
    """Sorted unsigned integers: differences, laid out by byte, compressed."""
    steps = np.diff(values, prepend=values.dtype.type(0))
    planes = steps.view(np.uint8).reshape(-1, values.dtype.itemsize).T
    return zstandard.ZstdCompressor(level=1).compress(planes.tobytes())


def unpack(data: bytes, dtype: type) -> np.ndarray:
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(data), np.uint8).reshape(np.dtype(dtype).itemsize, -1)
    return np.cumsum(np.ascontiguousarray(planes.T).view(dtype).ravel(), dtype=dtype)


def _rolled(values: np.ndarray, width: int, factor: np.uint64) -> np.ndarray:
    """A hash of every ``width`` neighbours, also across documents; callers mask those."""
    n = max(0, len(values) - width + 1)
    out = values[:n].copy()
    for i in range(1, width):
        out *= factor
        out += values[i : i + n]
    out ^= out >> np.uint64(31)
    out *= OTHER
    out ^= out >> np.uint64(29)
    return out


@dataclass
class Batch:
    """The documents of one range of ids, in order, and the hashes of their words end to end."""

    rows: pa.Table
    hashes: np.ndarray
    lengths: np.ndarray

    @staticmethod
    def of(rows: pa.Table) -> Batch:
        order = pc.sort_indices(rows, [(ORDER, "ascending"), ("text", "ascending")], null_placement="at_start")
        rows, table = rows.take(order), WordTable(xxhash.xxh64_intdigest)
        each = []
        for text in rows["text"]:
            found = words(text.as_py())
            each.append(np.fromiter(map(table.__getitem__, found), np.uint64, len(found)))
        lengths = np.array([len(x) for x in each], np.int64)
        return Batch(rows, np.concatenate([*each, np.empty(0, np.uint64)]), lengths)

    def inside(self, width: int) -> np.ndarray:
        """Whether the window that starts at each word ends in the same document."""
        ends = np.repeat(np.cumsum(self.lengths), self.lengths)
        n = max(0, len(self.hashes) - width + 1)
        return np.arange(n) + width <= ends[:n]

    def place(self) -> np.ndarray:
        """Number of each word in its document."""
        return np.arange(len(self.hashes)) - np.repeat(np.cumsum(self.lengths) - self.lengths, self.lengths)

    def blocks(self) -> np.ndarray:
        return _rolled(self.hashes, BLOCK, NEXT)

    def windows(self, buckets: int) -> tuple[np.ndarray, np.ndarray]:
        """Hash of every window and its bucket, taken from a second hash."""
        return _rolled(self.hashes, WINDOW, NEXT), (_rolled(self.hashes, WINDOW, OTHER) % np.uint64(buckets)).astype(np.int32)


def _runs(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where runs of equal values begin and end."""
    edges = np.flatnonzero(values[1:] != values[:-1]) + 1
    return np.concatenate([np.zeros(min(1, len(values)), np.int64), edges]), np.append(edges, len(values))[: len(values)]


def _cells(batch: int, bucket: np.ndarray, values: np.ndarray, flags: np.ndarray | None = None) -> pa.Table:
    """Cells of values sorted by (bucket, value)."""
    first, ends = _runs(bucket)
    squeeze = zstandard.ZstdCompressor(level=1).compress
    spans = list(zip(first, ends, strict=True))
    return pa.table({
        "bucket": pa.array(bucket[first], pa.int32()),
        "batch": pa.array(np.full(len(first), batch), pa.int32()),
        "cell": pa.array([pack(values[a:b]) for a, b in spans], pa.binary()),
        "flags": pa.array([None if flags is None else squeeze(flags[a:b].tobytes()) for a, b in spans], pa.binary()),
    })


def _anchor_cells(buckets: int) -> Callable[[tuple, pa.Table], pa.Table]:
    def emit(key: tuple, rows: pa.Table) -> pa.Table:
        own = Batch.of(rows)
        inside = own.inside(BLOCK)
        full = _keyed(own.blocks()[inside], buckets)
        indexed = own.place()[: len(inside)][inside] % BLOCK == 0
        order = np.argsort(full, kind="stable")
        full, indexed = full[order], indexed[order]
        first, ends = _runs(full)
        if not len(first):
            return _cells(0, np.empty(0, np.int32), np.empty(0, np.uint32))
        flags = np.maximum.reduceat(indexed.astype(np.uint8), first) | (
            (ends - first > 1).astype(np.uint8) << 1)
        full = full[first]
        return _cells(key[0].as_py(), (full >> np.uint64(32)).astype(np.int32), full.astype(np.uint32), flags)

    return emit


def _keyed(hashes: np.ndarray, buckets: int) -> np.ndarray:
    """Bucket and 32 more bits of a hash as one number."""
    return (((hashes >> np.uint64(32)) % np.uint64(buckets)) << np.uint64(32)) | (hashes & np.uint64(0xFFFFFFFF))


def _in_order(cells: pa.Table) -> tuple[np.ndarray, list[bytes], list[bytes | None]]:
    cells = cells.sort_by("batch")
    return cells["batch"].to_numpy(), cells["cell"].to_pylist(), cells["flags"].to_pylist()


def _match_anchors(key: tuple, cells: pa.Table) -> pa.Table:
    """Hashes that are a block of the index and occur twice or more, for each batch that has them."""
    batches, data, flags = _in_order(cells)
    expand = zstandard.ZstdDecompressor().decompress
    merged = np.concatenate([
        unpack(d, np.uint32).astype(np.uint64) << np.uint64(32) | np.uint64(int(b) << 2)
        | np.frombuffer(expand(f), np.uint8) for b, d, f in zip(batches, data, flags, strict=True)])
    merged.sort()
    value = merged >> np.uint64(32)
    first, ends = _runs(value)
    size = ends - first
    flag = np.bitwise_or.reduceat((merged & np.uint64(3)).astype(np.uint8), first)
    matters = np.repeat((flag & 1 == 1) & ((size > 1) | (flag & 2 == 2)), size)
    return _answers(key[0].as_py(), ((merged & np.uint64(0xFFFFFFFF)) >> np.uint64(2))[matters].astype(np.int32),
                    value[matters].astype(np.uint32))


def _first_windows(key: tuple, cells: pa.Table) -> pa.Table:
    """Window hashes that an earlier batch has too, for each later batch."""
    batches, data, _ = _in_order(cells)
    parts = [unpack(d, np.uint64) for d in data]
    batch, value = np.repeat(batches, [len(p) for p in parts]).astype(np.int32), np.concatenate(parts)
    order = np.argsort(value, kind="stable")
    batch, value = batch[order], value[order]
    later = np.concatenate([[False], value[1:] == value[:-1]])
    return _answers(key[0].as_py(), batch[later], value[later])


def _answers(bucket: int, batch: np.ndarray, value: np.ndarray) -> pa.Table:
    order = np.argsort(batch, kind="stable")
    batch, value = batch[order], value[order]
    first, ends = _runs(batch)
    return pa.table({
        "bucket": pa.array(np.full(len(first), bucket), pa.int32()), "batch": pa.array(batch[first], pa.int32()),
        "cell": pa.array([pack(value[a:b]) for a, b in zip(first, ends, strict=True)], pa.binary()),
        "flags": pa.nulls(len(first), pa.binary())})


def _around(hit: np.ndarray, n: int) -> np.ndarray:
    """Which of ``n`` windows contain a hit block."""
    total = np.concatenate([[0], np.cumsum(hit)])
    start = np.arange(n)
    return total[start + WINDOW - BLOCK + 1] > total[start]


def _window_cells(buckets: int) -> Callable[[tuple, pa.Table, pa.Table], pa.Table]:
    def emit(key: tuple, rows: pa.Table, hits: pa.Table) -> pa.Table:
        if not hits.num_rows or not rows.num_rows:
            return _cells(0, np.empty(0, np.int32), np.empty(0, np.uint64))
        own = Batch.of(rows)
        known = np.sort(np.concatenate([
            unpack(c, np.uint32).astype(np.uint64) | np.uint64(b << 32)
            for b, c in zip(hits["bucket"].to_pylist(), hits["cell"].to_pylist(), strict=True)]))
        blocks = _keyed(own.blocks(), buckets)
        at = np.minimum(np.searchsorted(known, blocks), len(known) - 1)
        hit = (known[at] == blocks) & own.inside(BLOCK)
        inside = own.inside(WINDOW)
        wanted = _around(hit, len(inside)) & inside
        value, bucket = own.windows(buckets)
        value, bucket = value[wanted], bucket[wanted]
        order = np.lexsort((value, bucket))
        value, bucket = value[order], bucket[order]
        if len(value):
            new = np.concatenate([[True], (value[1:] != value[:-1]) | (bucket[1:] != bucket[:-1])])
            value, bucket = value[new], bucket[new]
        return _cells(key[0].as_py(), bucket, value)

    return emit


def _covered(own: Batch, later: pa.Table, buckets: int) -> np.ndarray:
    """Which words lie in a window that also starts earlier, in this batch or an earlier one."""
    inside = own.inside(WINDOW)
    value, bucket = own.windows(buckets)
    start = np.flatnonzero(inside)
    value, bucket = value[inside], bucket[inside]
    repeated = np.ones(len(value), bool)
    repeated[np.unique(value, return_index=True)[1]] = False
    if later.num_rows and len(value):
        parts = [unpack(c, np.uint64) for c in later["cell"].to_pylist()]
        known, where = np.concatenate(parts), np.repeat(later["bucket"].to_numpy(), [len(p) for p in parts])
        order = np.argsort(known)
        known, where = known[order], where[order]
        at = np.minimum(np.searchsorted(known, value), len(known) - 1)
        repeated |= (known[at] == value) & (where[at] == bucket)
    change = np.zeros(len(own.hashes) + 1, np.int32)
    np.add.at(change, start[repeated], 1)
    np.add.at(change, start[repeated] + WINDOW, -1)
    return np.cumsum(change[:-1]) > 0


def _digests(buckets: int) -> Callable[[tuple, pa.Table, pa.Table], pa.Table]:
    def answer(key: tuple, rows: pa.Table, later: pa.Table) -> pa.Table:
        own = Batch.of(rows)
        gone, at, removed, shas = _covered(own, later, buckets), 0, [], []
        for text, n in zip(own.rows["text"], own.lengths.tolist(), strict=True):
            mask = gone[at : at + n]
            found = words(text.as_py())
            kept = found if not mask.any() else [w for w, g in zip(found, mask.tolist(), strict=True) if not g]
            removed.append(n - len(kept))
            shas.append(hashlib.sha256(b" ".join(kept)).hexdigest())
            at += n
        return pa.table({"doc_id": own.rows[ORDER], "n_words": pa.array(own.lengths, pa.int64()),
                         "n_removed": pa.array(removed, pa.int64()), "kept_sha256": pa.array(shas, pa.string())})

    return answer


def cut_words(text: str, gone: np.ndarray) -> str:
    """The text without the marked words and the white space after each; an unmarked text is unchanged."""
    data, out, at = text.encode("utf-8", "surrogatepass"), [], 0
    for word, g in zip(data.split(), gone.tolist(), strict=True):
        start = data.index(word, at)
        if not g:
            out.append(data[at : start + len(word)])
            at = start + len(word)
            continue
        out.append(data[at:start])
        at = start + len(word)
        while at < len(data) and data[at] in b" \t\n\v\f\r":
            at += 1
    out.append(data[at:])
    return b"".join(out).decode("utf-8", "surrogatepass")


def _texts(buckets: int, columns: list[str]) -> Callable[[tuple, pa.Table, pa.Table], pa.Table]:
    def answer(key: tuple, rows: pa.Table, later: pa.Table) -> pa.Table:
        own = Batch.of(rows)
        gone, at, texts = _covered(own, later, buckets), 0, []
        for text, n in zip(own.rows["text"].to_pylist(), own.lengths.tolist(), strict=True):
            mask = gone[at : at + n]
            texts.append(cut_words(text, mask) if mask.any() else text)
            at += n
        place = own.rows.schema.get_field_index("text")
        return own.rows.set_column(place, "text", pa.array(texts, pa.string())).select(columns)

    return answer


def _in_batches(docs: DataFrame, batches: int) -> DataFrame:
    """Append ``ORDER`` and ``PART``, the range of ids a row falls in. Equal ids share a batch, null ids come first."""
    ids = docs.withColumn(ORDER, F.col("doc_id").cast("long"))
    parts = [i / batches for i in range(1, batches)]
    cuts = ids.agg(F.percentile_approx(ORDER, parts, 20 * batches)).first()[0] if parts else None
    borders = np.unique(np.array(cuts or [], np.int64))     # one number per batch

    def batch_of(values: pd.Series) -> pd.Series:
        found = np.searchsorted(borders, values.fillna(np.iinfo(np.int64).min).astype("int64").to_numpy(), "right")
        return pd.Series(found.astype(np.int32))

    return ids.withColumn(PART, F.pandas_udf(batch_of, "int")(ORDER))


def _deduplicated(docs: DataFrame, answer: Callable, schema) -> DataFrame:
    spark = docs.sparkSession
    buckets = parallelism(spark)
    dealt = _in_batches(docs, 2 * buckets)
    by_batch = dealt.groupBy(PART)
    hits = by_batch.applyInArrow(_anchor_cells(buckets), CELL).groupBy("bucket").applyInArrow(_match_anchors, CELL)
    later = by_batch.cogroup(hits.groupBy("batch")).applyInArrow(_window_cells(buckets), CELL).groupBy(
        "bucket").applyInArrow(_first_windows, CELL)
    return by_batch.cogroup(later.groupBy("batch")).applyInArrow(answer(buckets), schema)


def removal_digests(docs: DataFrame) -> DataFrame:
    """doc_id, n_words, n_removed, kept_sha256 per document.

    A null text has no words. Rows that share a doc_id come in the order of their texts, so of two equal rows with
    twenty words or more the second loses all it has.
    """
    return _deduplicated(docs.select("doc_id", "text"), _digests,
                         "doc_id long, n_words long, n_removed long, kept_sha256 string")


def without_repeats(docs: DataFrame) -> DataFrame:
    """All columns of ``docs``, with the repeated words cut from ``text``; null texts stay null."""
    own, back = set_aside(docs, ORDER, PART)
    return _deduplicated(own, lambda buckets: _texts(buckets, own.columns), own.schema).withColumnsRenamed(back)
