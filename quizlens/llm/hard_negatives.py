"""Operator 12: hard negatives by lists that clusters of anchors share.

Anchors are clustered by direction. No anchor of a cluster is more than t away from its centre, so a row at angle s to the
centre and of length r scores at most |anchor| * r * cos(max(0, s - t)) with any of them. Each cluster orders all rows once
by that bound, r * cos(...), and all its anchors walk this one list from its head. An anchor is done when the bound of
what is left is below what it still needs: the k-th score it has found, or the floor of its window. So results are exact,
and the tail of a list is never looked at.

The list is walked in rounds, each four times as long as all before. A round sends only the rows of that part of the list,
and only for clusters that still have anchors walking; it is dealt in slices and the anchors of a cluster in groups, so no
task holds more than a slice and a group, however many rows share a vector or anchors share a cluster. Slices are walked in
order of the bound as well. The bound is kept as one of 1024 steps per cluster; a step's upper edge is what certifies.

Centres are fitted on a bounded sample of anchors; they decide how much is pruned, never what is found.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quizlens.operators.materialize import materialize

#: Anchors the centres are fitted on, at most; anchors per centre in that sample; centres; rounds of fitting.
SAMPLE, PER_CENTRE, CENTRES, FITTING = 4096, 64, 64, 8
STEPS = 1024
#: Length of the first part of a list, growth of the parts, rows in a slice, anchors in a group, rows walked at once.
FIRST, GROWTH, SLICE, GROUP, STRIDE = 8192, 4, 8192, 512, 512
NOTHING = -(1 << 62)


def quantised(embeddings: DataFrame) -> DataFrame:
    """vec_id, label and vector (whole numbers) of the rows that take part: those with an id, a label and a vector without
    null or non-finite components. Every seventh id has a wrong label. Rows with one id count as one, that with the smallest
    label and vector."""
    odd = "exists(embedding, x -> x IS NULL OR isnan(x) OR abs(x) = double('infinity'))"
    return (
        embeddings.where(f"vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL AND NOT {odd}")
        .selectExpr("CAST(vec_id AS BIGINT) AS vec_id",
                    "CAST(IF(vec_id % 7 = 0, (label + 1) % 10, label) AS INT) AS label",
                    "transform(embedding, x -> CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS vector")
        .groupBy("vec_id").agg(F.min(F.struct("label", "vector")).alias("row")).select("vec_id", "row.label", "row.vector"))


def matrix(column: pa.Array, width: int) -> np.ndarray:
    """Vectors as rows of whole numbers; shorter ones end in zeros."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    sizes = np.diff(column.offsets.to_numpy())
    out = np.zeros((len(column), width), np.int64)
    out[np.arange(width) < sizes[:, None]] = column.flatten().to_numpy()
    return out


def packed(vectors: np.ndarray, kind: str) -> pa.Array:
    return pa.array([row.tobytes() for row in vectors.astype(kind)], pa.binary())


def unpacked(column: pa.Array | pa.ChunkedArray, width: int, kind: str) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), kind).reshape(-1, width).astype(np.int64)


def lengths(vectors: np.ndarray) -> np.ndarray:
    return np.sqrt((vectors.astype(np.float64) ** 2).sum(axis=1))


def directions(vectors: np.ndarray) -> np.ndarray:
    return vectors / np.maximum(lengths(vectors), 1e-300)[:, None]


def scores(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact inner products, by floating point where every sum fits its 53 bits."""
    if lengths(a).max(initial=0) * lengths(b).max(initial=0) < 2**52:
        return (a.astype(np.float64) @ b.astype(np.float64).T).astype(np.int64)
    return a @ b.T


def fit_centres(sample: np.ndarray) -> np.ndarray:
    """Unit centres of directions; the first ones are sample points far from each other."""
    points = directions(sample)
    k = int(np.clip(len(points) // PER_CENTRE, 1, CENTRES))
    chosen, best = [0], points @ points[0]
    while len(chosen) < k:
        chosen.append(int(best.argmin()))
        best = np.maximum(best, points @ points[chosen[-1]])
    centres = points[chosen]
    for _ in range(FITTING):
        nearest = (points @ centres.T).argmax(axis=1)
        sums = np.zeros_like(centres)
        np.add.at(sums, nearest, points)
        filled = lengths(sums) > 1e-9
        centres[filled] = directions(sums[filled])
    return centres


def angles(vectors: np.ndarray, centres: np.ndarray) -> np.ndarray:
    return np.arccos(np.clip(directions(vectors) @ centres.T, -1, 1))


@dataclass
class Lists:
    """All rows with their place, by steps, in the list of each cluster; a written table and a bounded plan."""

    rows: DataFrame             # vec_id, label, vector (binary), steps (binary: one 16-bit step per cluster)
    members: DataFrame          # vec_id, label, vector (binary), length, cluster, team
    width: int
    kind: str                   # how vectors are packed: the narrowest whole numbers that hold every component
    most: float                 # the greatest length
    counts: np.ndarray          # rows by (cluster, step)
    teams: np.ndarray           # groups of anchors by cluster

    def edge(self):
        """The greatest bound from a step on, as a function that tasks can hold."""
        most, width = self.most, 2 * self.most / self.counts.shape[1]
        return lambda step: most - step * width + 1e-6 * most


def build_lists(rows: DataFrame, anchors: Column) -> Lists | None:
    """Fit, assign and order; None where there are no anchors."""
    rows = materialize(rows, "vectors")
    chosen = rows.where(anchors)
    sample = chosen.select("vector", F.xxhash64("vec_id").alias("h"), "vec_id").orderBy("h", "vec_id").limit(SAMPLE).toArrow()
    if not sample.num_rows:
        return None
    greatest = F.aggregate("vector", F.lit(0).cast("long"), lambda s, x: F.greatest(s, F.abs(x)))
    longest = F.sqrt(F.max(F.aggregate("vector", F.lit(0.0), lambda s, x: s + x.cast("double") * x.cast("double"))))
    width, component, most = rows.agg(F.max(F.size("vector")), F.max(greatest), longest).first()
    width, most = max(1, width), max(1.0, most * (1 + 1e-9))
    kind = next(k for k in ("<i2", "<i4", "<i8") if component <= np.iinfo(k).max)
    centres = fit_centres(matrix(sample["vector"], width))
    k, count = len(centres), STEPS

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            vectors = matrix(batch["vector"], width)
            away = angles(vectors, centres)
            cluster = away.argmin(axis=1)
            yield pa.RecordBatch.from_arrays(
                [batch["vec_id"], batch["label"], packed(vectors, kind), pa.array(lengths(vectors)),
                 pa.array(cluster.astype(np.int32)), pa.array(away[np.arange(len(away)), cluster])],
                names=[*batch.schema.names, "length", "cluster", "away"])

    members = materialize(chosen.select("vec_id", "label", "vector").mapInArrow(
        assign, "vec_id long, label int, vector binary, length double, cluster int, away double"), "anchors")
    spread, teams = np.zeros(k), np.ones(k, np.int64)
    for r in members.groupBy("cluster").agg(F.max("away").alias("away"), F.count(F.lit(1)).alias("n")).collect():
        spread[r.cluster], teams[r.cluster] = r.away + 1e-7, -(-r.n // GROUP)
    team = F.pmod(F.xxhash64("vec_id"), F.get(F.array(*map(F.lit, teams.tolist())), F.col("cluster"))).cast("int")

    def order(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            vectors = matrix(batch["vector"], width)
            bound = lengths(vectors)[:, None] * np.cos(np.maximum(0, angles(vectors, centres) - spread))
            steps = np.clip((most - bound) * (count / (2 * most)), 0, count - 1)
            yield pa.RecordBatch.from_arrays(
                [batch["vec_id"], batch["label"], packed(vectors, kind), packed(steps, "<u2")],
                names=[*batch.schema.names, "steps"])

    listed = materialize(rows.select("vec_id", "label", "vector").mapInArrow(
        order, "vec_id long, label int, vector binary, steps binary"), "listed")

    def tally(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(k * count, np.int64)
        for batch in batches:
            steps = unpacked(batch["steps"], k, "<u2")
            counts += np.bincount((steps + np.arange(k) * count).ravel(), minlength=k * count)
        filled = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(filled), pa.array(counts[filled])], names=["place", "n"])

    counts = np.zeros(k * count, np.int64)
    for r in listed.select("steps").mapInArrow(tally, "place long, n long").groupBy("place").agg(F.sum("n").alias("n")).collect():
        counts[r.place] = r.n
    return Lists(listed, members.withColumn("team", team).drop("away"), width, kind, most, counts.reshape(k, count), teams)


def best_of(found: DataFrame, k: int, rank: str | None = None) -> DataFrame:
    """The k best of each (anchor, slot), written; greater scores first, ties by smaller id."""
    order = Window.partitionBy("anchor", "slot").orderBy(F.col("score").desc(), "other")
    kept = found.withColumn("_rank", F.row_number().over(order)).where(F.col("_rank") <= k)
    return materialize(kept.drop("_rank") if rank is None else kept.withColumnRenamed("_rank", rank), "best")


def walk(lists: Lists, wanted: DataFrame, k: int, same_label: bool) -> DataFrame:
    """For each row of ``wanted`` (anchor, slot, low, high) the k best rows of the anchor's label, or of other labels, that
    score from low to high: (anchor, slot, score, other).

    Rounds go on until no anchor can gain; a round's links to the driver are one number per cluster.
    """
    clusters, edge = len(lists.counts), lists.edge()
    walking = materialize(wanted.join(lists.members.withColumnRenamed("vec_id", "anchor"), "anchor").withColumn(
        "worst", F.lit(NOTHING)), "walking")
    found = None
    upto = np.cumsum(lists.counts, axis=1)
    done = np.zeros(clusters, np.int64)         # steps walked by cluster
    length = FIRST
    while True:
        alive = np.zeros(clusters, bool)
        alive[[r.cluster for r in walking.select("cluster").distinct().collect()]] = True
        alive &= done < STEPS
        if not alive.any():
            break
        until = np.where(alive, np.maximum(done + 1, [np.searchsorted(u, length) + 1 for u in upto]), done)
        until = np.minimum(until, STEPS)
        rows = upto[np.arange(clusters), until - 1] - np.where(done > 0, upto[np.arange(clusters), done - 1], 0)
        slices = np.maximum(1, -(-rows // SLICE))
        hits = materialize(_round(lists, walking, done.copy(), until.copy(), alive, slices, k, same_label), "hits")
        found = best_of(hits if found is None else found.union(hits), k)
        done, length = until, length * GROWTH
        left = F.get(F.array(*[F.lit(float(edge(step)) if step < STEPS else -np.inf) for step in done.tolist()]),
                     F.col("cluster"))
        kth = found.groupBy("anchor", "slot").agg(F.min("score").alias("kth"), F.count(F.lit(1)).alias("n")).where(
            F.col("n") >= k).drop("n")
        walking = materialize(
            walking.join(kth, ["anchor", "slot"], "left").withColumn("worst", F.greatest("worst", "kth")).drop("kth")
            .where((left > -np.inf) & (F.col("length") * left * (1 + 1e-9) + 1e-3 >= F.greatest("worst", "low"))), "walking")
    empty = walking.select("anchor", "slot", F.lit(0).cast("long").alias("score"), F.lit(0).cast("long").alias("other")).limit(0)
    return empty if found is None else found


def _round(lists: Lists, walking: DataFrame, done: np.ndarray, until: np.ndarray, alive: np.ndarray, slices: np.ndarray,
           k: int, same_label: bool) -> DataFrame:
    clusters, width, kind, teams = len(done), lists.width, lists.kind, lists.teams

    def part_of_list(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["cluster", "team", "part", "vec_id", "label", "vector", "step"]
        for batch in batches:
            steps = unpacked(batch["steps"], clusters, "<u2")
            slim = batch.select(["vec_id", "label", "vector"])
            spread = batch["vec_id"].to_numpy().astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(33)
            for c in np.flatnonzero(alive).tolist():
                at = np.flatnonzero((steps[:, c] >= done[c]) & (steps[:, c] < until[c]))
                if not len(at):
                    continue
                taken = slim.take(pa.array(at))
                part = pa.array((spread[at] % np.uint64(slices[c])).astype(np.int32))
                for team in range(int(teams[c])):
                    own = [pa.array(np.full(len(at), x, np.int32)) for x in (c, team)]
                    yield pa.RecordBatch.from_arrays(
                        [*own, part, *taken.columns, pa.array(steps[at, c].astype(np.int32))], names=names)

    bound = lists.edge()

    def meet(walkers: pa.Table, entries: pa.Table) -> pa.Table:
        a, slot, score, other = walk_slice(walkers, entries, width, kind, bound, k, same_label)
        return pa.table({"anchor": a, "slot": slot, "score": score, "other": other})

    entries = lists.rows.mapInArrow(
        part_of_list, "cluster int, team int, part int, vec_id long, label int, vector binary, step int")
    parts = F.get(F.array(*map(F.lit, slices.tolist())), F.col("cluster"))
    dealt = walking.withColumn("part", F.explode(F.sequence(F.lit(0), (parts - 1).cast("int"))))
    key = ["cluster", "team", "part"]
    return dealt.groupBy(*key).cogroup(entries.groupBy(*key)).applyInArrow(
        meet, "anchor long, slot long, score long, other long")


def walk_slice(
    walkers: pa.Table, entries: pa.Table, width: int, kind: str, bound, k: int, same_label: bool
) -> tuple[np.ndarray, ...]:
    """The walkers of one group down one slice of their list: (anchor, slot, score, other), k at most of each slot."""
    none = np.zeros(0, np.int64)
    if not walkers.num_rows or not entries.num_rows:
        return none, none, none, none
    anchor, slot, low, high, worst = (walkers[c].to_numpy() for c in ("anchor", "slot", "low", "high", "worst"))
    ids, first, member = np.unique(anchor, return_index=True, return_inverse=True)
    vectors = unpacked(walkers["vector"], width, kind)[first]
    label, length = (walkers[c].to_numpy()[first] for c in ("label", "length"))
    other, other_label, step = (entries[c].to_numpy() for c in ("vec_id", "label", "step"))
    order = np.lexsort((other, step))
    other, other_label, step = other[order], other_label[order], step[order]
    listed = unpacked(entries["vector"], width, kind)[order]
    need = np.maximum(worst, low)
    top = np.full((len(anchor), k), NOTHING)
    rows, gained, scored = none, none, none
    live = np.flatnonzero(low <= high)
    for start in range(0, len(other), STRIDE):
        limit = float(bound(step[start]))
        live = live[length[member[live]] * limit * (1 + 1e-9) + 1e-3 >= need[live]]
        if not len(live):
            break
        here = slice(start, start + STRIDE)
        who, back = np.unique(member[live], return_inverse=True)
        found = scores(vectors[who], listed[here])
        fits = (label[who][:, None] == other_label[here]) == same_label
        fits &= ids[who][:, None] != other[here]
        found = np.where(fits, found, NOTHING)[back]
        found[(found < need[live][:, None]) | (found > high[live][:, None])] = NOTHING
        both = np.concatenate([top[live], found], axis=1)
        top[live] = np.partition(both, -k, axis=1)[:, -k:]
        need[live] = np.maximum(need[live], top[live].min(axis=1))
        at, place = np.nonzero((found > NOTHING) & (found >= need[live][:, None]))
        rows = np.concatenate([rows, live[at]])
        scored = np.concatenate([scored, found[at, place]])
        gained = np.concatenate([gained, other[start + place]])
        rows, scored, gained = _first_of_each(rows, scored, gained, k)
    return anchor[rows], slot[rows], scored, gained


def _first_of_each(rows: np.ndarray, score: np.ndarray, other: np.ndarray, k: int) -> tuple[np.ndarray, ...]:
    order = np.lexsort((other, -score, rows))
    rows, score, other = rows[order], score[order], other[order]
    start = np.flatnonzero(np.concatenate([[True], rows[1:] != rows[:-1]])) if len(rows) else np.zeros(0, np.int64)
    place = np.arange(len(rows)) - np.repeat(start, np.diff(np.append(start, len(rows))))
    kept = place < k
    return rows[kept], score[kept], other[kept]


def mine(rows: DataFrame, anchors: Column, positives: int = 5, negatives: int = 10, low: int = 30, high: int = 90) -> DataFrame:
    """Hard negatives of every anchor and positive, from ``rows`` (vec_id, label, vector of whole numbers; ids unique).

    Positives are the best rows of the anchor's label, negatives the best of other labels that score from ``low`` to
    ``high`` percent of the positive. Scores are inner products, a shorter vector ends in zeros; sums must fit 64 bits.
    Columns: anchor_id, positive_id, rank, negative_id, positive_score, negative_score.
    """
    lists = build_lists(rows, anchors)
    schema = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"
    if lists is None:
        return rows.sparkSession.createDataFrame([], schema)
    every = lists.members.select(F.col("vec_id").alias("anchor"), F.lit(0).cast("long").alias("slot"),
                                 F.lit(NOTHING).alias("low"), F.lit(-NOTHING).alias("high"))
    near = walk(lists, every, positives, same_label=True)
    windows = near.where("score >= 0").selectExpr(      # 100 n from low * p to high * p; nothing lies there below zero
        "anchor", "other AS slot", f"(score * {low} + 99) div 100 AS low", f"(score * {high}) div 100 AS high")
    hard = best_of(walk(lists, windows, negatives, same_label=False), negatives, rank="rank")
    pairs = near.selectExpr("anchor", "other AS slot", "score AS positive_score")
    return hard.join(pairs, ["anchor", "slot"]).selectExpr(
        "anchor AS anchor_id", "slot AS positive_id", "CAST(rank AS INT) AS rank", "other AS negative_id", "positive_score",
        "score AS negative_score")


def mined_embeddings(embeddings: DataFrame) -> DataFrame:
    """Hard negatives of the rows of ``embeddings`` (vec_id, embedding, label) with an id divisible by a hundred.

    An anchor without others of its label, and a positive without negatives in its window, give no rows; no rows give none.
    Further columns are not looked at.
    """
    return mine(quantised(embeddings), F.col("vec_id") % 100 == 0)


#: All anchors against all rows, by DuckDB.
ORACLE = """
WITH v AS (
  SELECT vec_id, CAST(CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS INT) AS label,
         [floor(256 * CAST(x AS DOUBLE)) FOR x IN embedding] AS q
  FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL
    AND len([x FOR x IN embedding IF x IS NULL OR isnan(x) OR isinf(x)]) = 0),
s AS (
  SELECT a.vec_id AS anchor, b.vec_id AS other, a.label = b.label AS same,
         CAST(list_dot_product(a.q, b.q) AS BIGINT) AS score
  FROM v AS a JOIN v AS b ON a.vec_id <> b.vec_id
  WHERE a.vec_id % 100 = 0),
p AS (
  SELECT anchor, other AS positive, score FROM s WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor ORDER BY score DESC, other) <= 5)
SELECT p.anchor AS anchor_id, p.positive AS positive_id,
       CAST(row_number() OVER (PARTITION BY p.anchor, p.positive ORDER BY s.score DESC, s.other) AS INT) AS rank,
       s.other AS negative_id, p.score AS positive_score, s.score AS negative_score
FROM p JOIN s ON p.anchor = s.anchor AND NOT s.same AND 30 * p.score <= 100 * s.score AND 100 * s.score <= 90 * p.score
QUALIFY rank <= 10"""
