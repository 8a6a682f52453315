"""Operator 7: near-duplicates by SimHash, with pigeonring filtering.

A fingerprint is a ring of eight segments of eight bits. Where two fingerprints differ in at most two bits, some
segment starts a chain in which the differences of the first l segments never exceed l * 2 / 8: none in the first
three, one at most in the first seven. So the two agree in three consecutive segments, and in the first or the second
pair of the four that follow. These 40 bits are the key under which candidates meet, sixteen keys per *distinct*
fingerprint; a chance meeting needs 2^40 fingerprints, and a key holds at most 2^24 by construction. Candidates of a
key then pass the whole chain test and the full Hamming check. Only links to one root per group leave a key, never its
pairs, and connected components join them.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quizlens.llm.tables import components
from quizlens.llm.text_words import words
from quizlens.operators.materialize import materialize

SEED = 42
SHINGLE = 3
SEGMENTS, MAX_BITS = 8, 2
#: A key with more fingerprints is searched through shared one-bit neighbours, which is exact as well and linear.
PAIRED = 64

_BITS = (np.arange(256)[:, None] >> np.arange(8)) & 1
_PLANES = (np.arange(8) * 256).astype(np.int64)
_WEIGHTS = np.uint64(1) << np.arange(64, dtype=np.uint64)
_NEIGHBOURS = np.concatenate([[np.uint64(0)], _WEIGHTS])


def fingerprint(text: str | None) -> int:
    """Signed 64-bit fingerprint: majority of each bit over the hashes of all shingles; zero for no words."""
    found = [w for w in words(text)]
    if not found:
        return 0
    lengths = np.fromiter(map(len, found), np.int64, len(found))
    joined = b" ".join(found).lower()     # bytes.lower: A to Z only
    starts = np.concatenate([[0], np.cumsum(lengths + 1)]).tolist()
    n = max(1, len(found) - SHINGLE + 1)
    last = starts[min(SHINGLE, len(found)):]
    hashed = np.fromiter((xxhash.xxh64_intdigest(joined[a : b - 1], SEED) for a, b in zip(starts, last, strict=False)),
                         np.uint64, n)
    counts = np.bincount((hashed.view(np.uint8).reshape(n, 8) + _PLANES).ravel(), minlength=2048).reshape(8, 256) @ _BITS
    return int(_WEIGHTS[(2 * counts > n).ravel()].sum().astype(np.int64))


def with_fingerprints(docs: DataFrame, name: str = "fingerprint") -> DataFrame:
    """Append the fingerprint (long) of ``text`` to all columns."""

    def compute(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = pa.array([fingerprint(t.as_py()) for t in batch["text"]], pa.int64())
            yield pa.RecordBatch.from_arrays([*batch.columns, values], names=[*batch.schema.names, name])

    return docs.mapInArrow(compute, docs.withColumn(name, F.lit(0).cast("long")).schema)


def _rotated(start: int) -> Column:
    value = F.col("fingerprint")
    if not start:
        return value
    return F.shiftleft(value, 8 * start).bitwiseOR(F.shiftrightunsigned(value, 64 - 8 * start))


def chain_keys() -> Column:
    """Sixteen keys: (start of the chain, pair of segments, 24 bits of the chain's head, 16 bits of the pair)."""
    keys = []
    for start in range(SEGMENTS):
        ring = _rotated(start)
        head = F.shiftleft(F.shiftrightunsigned(ring, 40), 16)
        for half in (0, 1):
            pair = F.shiftrightunsigned(ring, 24 - 16 * half).bitwiseAND(F.lit(0xFFFF))
            keys.append(F.lit((2 * start + half) << 40).bitwiseOR(head).bitwiseOR(pair))
    return F.array(*keys)


def within_budget(difference: np.ndarray, start: np.ndarray) -> np.ndarray:
    """Whether every chain from segment ``start`` stays within its share of the allowed bits."""
    shift = (8 * start).astype(np.uint64)
    ring = (difference << shift) | np.where(shift > 0, difference >> ((np.uint64(64) - shift) % np.uint64(64)), np.uint64(0))
    segments = ring.astype(">u8").view(np.uint8).reshape(-1, SEGMENTS)
    spent = np.cumsum(np.bitwise_count(segments), axis=1)
    return (spent * SEGMENTS <= MAX_BITS * np.arange(1, SEGMENTS + 1)).all(axis=1)


def _roots(members: np.ndarray, start: int) -> np.ndarray:
    """The smallest member linked to each member of one key, directly or through others of the key."""
    k = len(members)
    label = np.arange(k)
    if k <= PAIRED:
        a, b = np.triu_indices(k, 1)
        difference = members[a] ^ members[b]
        linked = within_budget(difference, np.full(len(a), start))
        linked[linked] = np.bitwise_count(difference[linked]) <= MAX_BITS
        a, b = a[linked], b[linked]

        def spread() -> np.ndarray:
            new = label.copy()
            np.minimum.at(new, a, label[b])
            np.minimum.at(new, b, label[a])
            return new
    else:  # two members within two bits share a neighbour within one bit, and only those do
        _, near = np.unique(members[:, None] ^ _NEIGHBOURS[None, :], return_inverse=True)
        near = near.reshape(k, 65)

        def spread() -> np.ndarray:
            least = np.full(near.max() + 1, k)
            np.minimum.at(least, near.ravel(), np.repeat(label, 65))
            return least[near].min(axis=1)

    while True:
        new = spread()
        new = new[new]
        if (new == label).all():
            return members[label]
        label = new


def _group_links(keys: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
    size = np.diff(np.append(first, len(keys)))
    start = (keys[first] >> 41).astype(np.int64)
    two = size == 2
    a, b = values[first[two]], values[first[two] + 1]
    linked = within_budget(a ^ b, start[two])
    linked[linked] = np.bitwise_count((a ^ b)[linked]) <= MAX_BITS
    nodes, roots = [b[linked]], [a[linked]]
    for at, n, s in zip(first[size > 2], size[size > 2], start[size > 2], strict=True):
        members = values[at : at + n]
        root = _roots(members, int(s))
        nodes.append(members[root != members])
        roots.append(root[root != members])
    return np.concatenate(nodes), np.concatenate(roots)


def links(distinct: DataFrame) -> DataFrame:
    """Edges (u, v) between distinct fingerprints that connect the same ones as all pairs within two bits do."""

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, values = np.empty(0, np.int64), np.empty(0, np.uint64)

        def found(k: np.ndarray, v: np.ndarray) -> Iterator[pa.RecordBatch]:
            if len(k) > 1:
                u, w = _group_links(k, v)
                if len(u):
                    yield pa.RecordBatch.from_arrays([pa.array(u.view(np.int64)), pa.array(w.view(np.int64))], names=["u", "v"])

        for batch in batches:
            keys = np.concatenate([keys, batch["key"].to_numpy()])
            values = np.concatenate([values, batch["fingerprint"].to_numpy().view(np.uint64)])
            whole = int(np.searchsorted(keys, keys[-1])) if len(keys) else 0     # the last key may go on
            yield from found(keys[:whole], values[:whole])
            keys, values = keys[whole:], values[whole:]
        yield from found(keys, values)

    keyed = distinct.select("fingerprint", F.explode(chain_keys()).alias("key"))
    return keyed.repartition("key").sortWithinPartitions("key").mapInArrow(meet, "u long, v long").distinct()


def labels(rows: DataFrame) -> DataFrame:
    """(fingerprint, component_id) for every distinct fingerprint of ``rows`` (doc_id, fingerprint).

    Copies are folded into one row per fingerprint before anything is shuffled by it. Null ids count only where a
    component has no other; its component_id is null then. No rows give no labels.
    """
    distinct = materialize(rows.groupBy("fingerprint").agg(F.min("doc_id").alias("first")), "fingerprints")
    member = components(links(distinct))
    ids = member.join(distinct, member["node"] == distinct["fingerprint"])
    ids = ids.groupBy("root").agg(F.min("first").alias("least"))
    found = member.join(ids, "root").select(F.col("node").alias("fingerprint"), "least")
    return materialize(distinct.join(found, "fingerprint", "left").select(
        "fingerprint", F.coalesce("least", "first").alias("component_id")), "labels")


def near_duplicates(docs: DataFrame) -> DataFrame:
    """doc_id, fingerprint (16 lower-case hex digits), component_id per document.

    Null and empty texts have fingerprint zero and are linked like any other; repeated rows are answered each.
    """
    rows = materialize(with_fingerprints(docs.select(F.col("doc_id").cast("long"), "text")).drop("text"), "simhash")
    return rows.join(labels(rows), "fingerprint").select(
        "doc_id", F.lower(F.lpad(F.hex("fingerprint"), 16, "0")).alias("fingerprint"), "component_id")


def one_of_each(docs: DataFrame) -> DataFrame:
    """The documents without near-duplicates: of each component the row with the smallest id stays, one row of it.

    All columns are kept. A row is known by its id and a hash of all it holds; of rows equal in everything one stays.
    Texts are shuffled once, by that key.
    """
    mark, key, whole = (_free(docs, name) for name in ("_fingerprint", "_key", "_whole"))
    known = docs.withColumns({
        key: F.coalesce(F.col("doc_id").cast("long"), F.lit(-1 << 63)), whole: F.xxhash64(*docs.columns)})
    rows = materialize(with_fingerprints(known.select("doc_id", "text", key, whole), mark).drop("text"), "simhash-rows")
    slim = rows.select("doc_id", F.col(mark).alias("fingerprint"), F.col(key).alias("key"), F.col(whole).alias("whole"))
    chosen = slim.join(labels(slim), "fingerprint").groupBy("component_id", F.when(
        F.col("component_id").isNull(), F.col("fingerprint")).alias("only")).agg(
        F.min(F.struct(F.col("doc_id").isNull().alias("none"), "key", "whole")).alias("best"))
    chosen = materialize(chosen.select(F.col("best.key").alias(key), F.col("best.whole").alias(whole)), "chosen")
    number = F.row_number().over(Window.partitionBy(key, whole).orderBy(key))
    return known.join(chosen, [key, whole], "left_semi").withColumn(mark, number).where(F.col(mark) == 1).select(docs.columns)


def _free(df: DataFrame, name: str) -> str:
    while name in df.columns:
        name += "_"
    return name
