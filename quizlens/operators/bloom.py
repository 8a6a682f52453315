"""A Bloom filter of keys as one array value, built by an aggregate and applied inside a scan of another table."""

from __future__ import annotations

import random

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: 64-bit blocks of a filter: 2 MB, room for 1.7 million keys at ten bits a key. More keys make it let more through.
BLOCKS = 1 << 18
BITS_SET = 4
PATTERNS = 1 << 10


def _patterns() -> str:
    """Bits of a block, as SQL. A key takes one of these patterns, so its hash is worked out once for all its bits: an
    optimizer puts the key's own expression wherever the hash stands, and a scan whose code grows too long is not compiled."""
    chosen = random.Random(BITS_SET)
    masks = (sum(1 << bit for bit in chosen.sample(range(64), BITS_SET)) for _ in range(PATTERNS))
    return f"array({', '.join(f'{mask - (mask >> 63 << 64)}L' for mask in masks)})"


def _place(key: str) -> tuple[str, str]:
    """Block and bits of a key, as SQL; a null key has a place like any other."""
    bits = f"get({_patterns()}, CAST(xxhash64(`{key}`) & {PATTERNS - 1}L AS INT))"
    return f"CAST(shiftrightunsigned(xxhash64(`{key}`), 32) % {{blocks}} AS INT)", bits


def key_filter(keys: DataFrame, key: str, blocks: int = BLOCKS) -> DataFrame:
    """One row with one array of ``blocks`` blocks. Blocks are put together in the map stage, so no more than that many rows
    leave a task, however many keys there are."""
    block, bits = _place(key)
    filled = keys.selectExpr(f"{block.format(blocks=blocks)} AS block", f"{bits} AS bits")
    every = keys.sparkSession.range(0, blocks, 1, 1).selectExpr("CAST(id AS INT) AS block", "0L AS bits")
    return (
        filled.union(every).groupBy("block").agg(F.bit_or("bits").alias("bits"))
        .agg(F.expr("transform(sort_array(collect_list(struct(block, bits))), x -> x.bits)").alias("filter")))


def might_hold(made: DataFrame, key: str, blocks: int = BLOCKS) -> Column:
    """Whether a key may be among those of the filter; true for all that are. The filter is a scalar subquery: made once, and
    a constant to the scan that applies it."""
    block, bits = _place(key)
    held = F.get(made.scalar(), F.expr(block.format(blocks=blocks)))
    return held.bitwiseOR(F.expr(f"~{bits}")) == -1
