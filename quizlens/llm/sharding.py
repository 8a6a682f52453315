"""Operator 6: balanced shards by longest-processing-time scheduling.

Equal texts are a group that stays together. Groups are summed up before they are shuffled, ordered by size, and go to
the least-loaded shard through a heap. The heap sees sizes, not groups: sizes below 2048 bytes one by one, larger ones
to eleven significant bits, a few ten thousand classes whatever the input. Equal sizes are dealt in runs ("the next m
groups of this size go to this shard"), and each group finds its shard from its number within its class.
"""

from __future__ import annotations

import heapq

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quizlens.llm.tables import number_within, with_run
from quizlens.operators.materialize import materialize

SHARDS = 24
EXTRA_BYTES = 8
EXACT_BITS = 11


def size_class(size: str) -> str:
    """SQL for the class of a size: the size itself, or its number of bits and its eleven leading ones."""
    bits = f"length(bin({size}))"
    return f"CAST(IF({bits} <= {EXACT_BITS}, {size}, shiftleft(CAST({bits} AS BIGINT), {EXACT_BITS}) " \
           f"+ shiftright({size}, {bits} - {EXACT_BITS})) AS BIGINT)"


def schedule(classes: pd.DataFrame, shards: int) -> pd.DataFrame:
    """Runs (class, first, shard): groups of a class from number ``first`` on go to ``shard``.

    ``classes`` has class, groups and bytes. Sizes come longest first, always to the shard with least bytes. Once all
    loads lie within one size, whole rounds are dealt at once.
    """
    heap = [(0.0, shard) for shard in range(shards)]
    runs: list[tuple[int, int, int]] = []
    for name, groups, total in classes.sort_values("class", ascending=False)[["class", "groups", "bytes"]].itertuples(index=False):
        size, left = total / groups, int(groups)
        given = 0
        while left:
            load, shard = heapq.heappop(heap)
            if left >= shards and max(heap, default=(load,))[0] - load <= size:
                each = left // shards
                heapq.heappush(heap, (load, shard))
                for _, s in sorted(heap):
                    runs.append((name, given, s))
                    given += each
                heap = [(x + each * size, s) for x, s in heap]
                heapq.heapify(heap)
                left -= each * shards
                continue
            room = int((heap[0][0] - load) // size) if heap else left
            m = min(left, max(1, room))
            runs.append((name, given, shard))
            given += m
            left -= m
            heapq.heappush(heap, (load + m * size, shard))
    return pd.DataFrame(runs, columns=["class", "first", "shard"]).sort_values(["class", "first"], ignore_index=True)


def assign_groups(groups: DataFrame, shards: int) -> DataFrame:
    """(key, shard) for rows (key, bytes) with one row per group."""
    numbered = number_within(materialize(
        groups.select("key", "bytes", F.expr(size_class("bytes")).alias("class")), "groups"), "class", "number")
    classes = numbered.groupBy("class").agg(F.count(F.lit(1)).alias("groups"), F.sum("bytes").alias("bytes"))
    runs = schedule(classes.toPandas(), shards)    # a row per class, see the module's text
    return with_run(numbered, "class", "number", runs).select("key", F.col("shard").cast("int").alias("shard"))


def shard_documents(docs: DataFrame, shards: int = SHARDS) -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot, grown_shard per document, under the law ``bytes``.

    A null text counts as an empty one and shares its group. Repeated rows are placed each. A group larger than a
    shard's share is one shard's, as groups stay together; the other shards even out.
    """
    text = F.coalesce("text", F.lit(""))
    rows = materialize(docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), (F.octet_length(text) + EXTRA_BYTES).cast("long").alias("size"),
        F.crc32(text).alias("text_crc32"), F.unhex(F.sha2(text, 256)).alias("key")), "sizes")
    groups = rows.groupBy("key").agg(F.sum("size").alias("bytes"))
    placed = rows.join(assign_groups(groups, shards), "key").select("doc_id", "size", "text_crc32", "shard")
    return number_within(materialize(placed, "placed"), "shard", "slot").select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"))
