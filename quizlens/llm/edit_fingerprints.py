"""Operator 8: document fingerprints by a randomised edit embedding.

All documents share one random walk. At step j the walk stands on a character and writes it down, and a random bit of
(j, character) tells whether it moves on; so an insertion or deletion only shifts two walks against each other until
they meet again, and edit distance becomes Hamming distance of what is written. A fingerprint keeps sampled steps: all
of the first 32 and 32 of every later octave [2^k, 2^(k+1)), one hex digit each, with '-' past the end of the text.
Its length follows the logarithm of the text's. Likeness weighs the octaves by their lengths.

The walks of many documents advance together, one array operation per step.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quizlens.llm.tables import components, parallelism
from quizlens.operators.materialize import materialize

SEED = 8
OCTAVE = 32
PERIOD = 4096       # steps after which the random bits come round
GROUP_CHARS = 4_000_000
#: Fingerprints of a key that are searched in one task; more are searched by pairs of blocks.
BLOCK = 2048
#: Keys of a grade and digits of a key, for up to sixteen million fingerprints; see :func:`key_shape`.
BANDS, KEY_DIGITS = 22, 8
DIGITS = np.frombuffer(b"0123456789abcdef", np.uint8)
END = ord("-")


@lru_cache(maxsize=1)
def _random() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Moves by (step, character), digits by (sample, character), and the sampled places within an octave."""
    r = np.random.Generator(np.random.PCG64(SEED))
    moves = r.integers(0, 2, (PERIOD, 256), np.int64)
    moves[:, 0] = 0                                       # nothing moves past the end
    digits = r.integers(0, 16, (64 * OCTAVE, 256)).astype(np.uint8)
    return moves, digits, (np.arange(OCTAVE) + r.random((64, OCTAVE))) / OCTAVE


def sampled_steps(octaves: int) -> np.ndarray:
    places = _random()[2]
    later = [((1 + places[k]) * OCTAVE * 2**k).astype(np.int64) for k in range(octaves - 1)]
    return np.concatenate([np.arange(OCTAVE), *later])


def characters(text: str) -> np.ndarray:
    """Code points folded into 1 to 255, those of ASCII apart; 0 stands for the end."""
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4")
    return np.where(points < 128, points, 128 + points % 127).astype(np.uint8) | (points == 0)


def fingerprints(texts: list[np.ndarray]) -> list[str]:
    """Fingerprints of folded texts, walked side by side."""
    out = [""] * len(texts)
    moves, digits, _ = _random()
    order = sorted(range(len(texts)), key=lambda i: -len(texts[i]))
    lengths = np.array([len(texts[i]) for i in order], np.int64)
    flat = np.concatenate([x for i in order for x in (texts[i], np.zeros(1, np.uint8))] or [np.zeros(1, np.uint8)])
    at = np.cumsum(lengths + 1) - lengths - 1
    most = int(lengths[0]) if len(lengths) else 0
    octaves = 1
    while most and OCTAVE * 2 ** (octaves - 1) < 3 * most:
        octaves += 1
    steps = sampled_steps(octaves)
    written = np.full((len(steps), len(order)), END, np.uint8)
    alive, here = np.flatnonzero(lengths), at[lengths > 0]
    step = 0
    for sample, until in enumerate(steps.tolist()):
        if not len(alive):
            break
        while step < until:
            stop = min(until, (step // 64 + 1) * 64)
            for j in range(step, stop):
                here += moves[j % PERIOD].take(flat.take(here))
            step = stop
            if step % 64 == 0:
                more = flat.take(here) > 0
                if not more.all():
                    alive, here = alive[more], here[more]
        symbol = flat.take(here)
        written[sample, alive] = np.where(symbol > 0, DIGITS[digits[sample].take(symbol)], END)
    for column, i in enumerate(order):
        row = written[:, column]
        filled = np.flatnonzero(row != END)
        n = -(-(int(filled[-1]) + 1) // OCTAVE) * OCTAVE if len(filled) else OCTAVE
        out[i] = row[:n].tobytes().decode()
    return out


def likeness(a: str, b: str) -> float:
    """Share of equal samples, octaves weighed by their lengths; steps past the end of both texts do not count."""
    if a == b:
        return 1.0
    x, y = (np.frombuffer(s.ljust(max(len(a), len(b)), "-").encode(), np.uint8) for s in (a, b))
    k = np.arange(len(x)) // OCTAVE
    weight = np.where((x == END) & (y == END), 0.0, 2.0 ** np.maximum(0, k - 1))
    return float(weight[x == y].sum() / weight.sum())


def edited(text: str, following: str) -> str:
    """The last third replaced by as many characters from the start of ``following``, or by all of it."""
    third = len(text) // 3
    return text[: len(text) - third] + following[:third]


def with_next(docs: DataFrame) -> tuple[DataFrame, bool]:
    """doc_id and the text of each document in order, the next by descending id after each, after the last the first.

    Documents are dealt by ranges of ids and sorted in their ranges; the first document of each range also goes to the
    range before it, one row per range, marked ``extra``. Null ids come last, equal ids by descending text, and a single
    document follows itself. ``body`` holds the text in UTF-8; where no id occurs twice, so that no texts are sorted, it is
    compressed, as the second result says.
    """
    rows = docs.select(F.col("doc_id").cast("long"), F.coalesce("text", F.lit("")).alias("text"))
    ranges = 4 * parallelism(docs.sparkSession)
    cuts = rows.agg(F.percentile_approx("doc_id", [i / ranges for i in range(1, ranges)], 20 * ranges)).first()[0]
    borders = np.unique(np.array(cuts or [], np.int64))[::-1]      # one number per range
    squeezed = rows.groupBy("doc_id").agg(F.count(F.lit(1)).alias("n")).where("n > 1").isEmpty()

    def range_of(ids: pd.Series) -> pd.Series:
        known = ids.fillna(np.iinfo(np.int64).min).astype("int64").to_numpy()
        return pd.Series((len(borders) - np.searchsorted(borders[::-1], known, "right")).astype(np.int32))

    def squeeze(texts: pd.Series) -> pd.Series:
        compress = zstandard.ZstdCompressor(level=1).compress
        return texts.map(lambda text: compress(text.encode("utf-8", "surrogatepass")))

    part = F.pandas_udf(range_of, "int")("doc_id")
    body = F.pandas_udf(squeeze, "binary")("text") if squeezed else F.col("text").cast("binary")
    firsts = rows.groupBy(part.alias("part")).agg(F.max("doc_id").alias("doc_id"))
    around = Window.orderBy("part")      # one row per range
    firsts = firsts.select("part", "doc_id", F.coalesce(
        F.lag("part").over(around), F.max("part").over(Window.partitionBy())).alias("to"))
    head = F.broadcast(firsts.select(F.col("doc_id").alias("head"), "to"))      # as many rows as ranges
    extra = rows.join(head, F.col("doc_id").eqNullSafe(F.col("head")))
    extra = extra.groupBy("to").agg(F.max("text").alias("text")).select(
        F.lit(None).cast("long").alias("doc_id"), F.col("to").alias("part"), F.lit(True).alias("extra"), body.alias("body"))
    # Both functions side by side take one Python worker a task, one after the other would take two.
    own = rows.select("doc_id", part.alias("part"), F.lit(False).alias("extra"), body.alias("body"))
    every = own.unionByName(extra)
    return every.repartition("part").sortWithinPartitions(
        "part", "extra", F.col("doc_id").desc_nulls_last(), F.col("body").desc()), squeezed


def _pairs(batches: Iterator[pa.RecordBatch], squeezed: bool) -> Iterator[tuple[int | None, str, str]]:
    previous, expand = None, zstandard.ZstdDecompressor().decompress
    for batch in batches:
        for doc_id, body, extra in zip(batch["doc_id"].to_pylist(), batch["body"], batch["extra"].to_pylist(), strict=True):
            body = body.as_py()
            text = (expand(body) if squeezed else body).decode("utf-8", "surrogatepass")
            if previous:
                yield *previous, text
            previous = None if extra else (doc_id, text)


def _grouped(pairs: Iterator[tuple[int | None, str, str]]) -> Iterator[list[tuple[int | None, str, str]]]:
    """Lists of neighbouring documents, of bounded size unless one text is larger."""
    group, size = [], 0
    for pair in pairs:
        group.append(pair)
        size += len(pair[1])
        if size >= GROUP_CHARS:
            yield group
            group, size = [], 0
    if group:
        yield group


def fingerprint_documents(docs: DataFrame) -> DataFrame:
    """doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next per document.

    Null texts are empty ones, whose fingerprint is 32 times '-'. Repeated rows are answered each.
    """
    schema = "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, " \
             "near_edited double, near_next double"

    ordered, squeezed = with_next(docs)

    def compute(batches: Iterator[pa.RecordBatch]) -> Iterator[pd.DataFrame]:
        for group in _grouped(_pairs(batches, squeezed)):
            ids, texts, following = zip(*group, strict=True)
            changed = [edited(a, b) for a, b in zip(texts, following, strict=True)]
            # A group's next documents are its own but for the ends of its ranges.
            distinct = list(dict.fromkeys([*texts, *following, *changed]))
            prints = dict(zip(distinct, fingerprints([characters(t) for t in distinct]), strict=True))
            own, next_, new = ([prints[t] for t in some] for some in (texts, following, changed))
            yield pa.RecordBatch.from_arrays([
                pa.array(ids, pa.int64()), pa.array(map(len, texts), pa.int64()),
                pa.array(hashlib.sha256(t.encode("utf-8", "surrogatepass")).hexdigest() for t in changed),
                pa.array(own, pa.string()), pa.array(new, pa.string()),
                pa.array(map(likeness, own, new), pa.float64()), pa.array(map(likeness, own, next_), pa.float64()),
            ], names=["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"])

    return ordered.mapInArrow(compute, schema)


@lru_cache(maxsize=256)
def _band_places(scale: int, bands: int, digits: int) -> np.ndarray:
    """Samples of each band for walks of 32 * 2^(scale / 2) steps or more, drawn evenly over those steps."""
    until = OCTAVE * 2 ** (scale / 2)
    steps = sampled_steps(max(1, scale // 2 + 2))
    r = np.random.Generator(np.random.PCG64([SEED, scale + 64]))
    return np.searchsorted(steps, r.random((bands, digits)) * until, "right") - 1


def key_shape(fingerprints: int) -> tuple[int, int]:
    """Keys of a grade and digits of a key for so many fingerprints.

    A digit of unlike fingerprints agrees one time in eight or so: with a digit more for every factor of eight, a key
    meets about as many chance partners in a large corpus as in a small one. The number of keys follows the digits, so
    that a pair of likeness 0.8 shares a key with a chance of 0.98 at every size. Twelve digits are what a whole number holds.
    """
    digits = KEY_DIGITS
    while digits < 12 and 8**digits < fingerprints:
        digits += 1
    return int(np.ceil(np.log(0.02) / np.log(1 - 0.8**digits))), digits


def band_keys(fingerprint: str, bands: int = BANDS, digits: int = KEY_DIGITS) -> list[str]:
    """Keys from digits at random places, the same places for every document with a walk of about that length.

    Places are drawn evenly over the steps of a walk, so octaves count by the weights they have in :func:`likeness`: of two
    fingerprints of likeness x each place agrees with a chance of about x, whatever part of the texts was edited. Lengths
    are graded by halves of an octave. Alike walks differ in length by less than that, so a document has the keys of its own
    grade and of the one below.
    """
    return [f"{scale}.{n}.{''.join(fingerprint[p] for p in row)}"
            for scale in _grades(fingerprint) for n, row in enumerate(_band_places(scale, bands, digits))]


def _grades(fingerprint: str) -> tuple[int, ...]:
    filled = len(fingerprint.rstrip("-"))
    if not filled:
        return ()
    walked = int(sampled_steps(-(-filled // OCTAVE))[filled - 1]) + 1
    grade = int(np.floor(2 * np.log2(walked / OCTAVE)))
    return grade, grade - 1


def key_numbers(fingerprint: str, bands: int = BANDS, digits: int = KEY_DIGITS) -> np.ndarray:
    """:func:`band_keys`, each key as one whole number."""
    row = np.frombuffer(fingerprint.encode(), np.uint8).astype(np.int64)
    values = np.where(row >= ord("a"), row - ord("a") + 10, row - ord("0"))
    return np.concatenate([np.empty(0, np.int64), *[
        ((scale + 64) * bands + np.arange(bands) << 4 * digits)
        | values[_band_places(scale, bands, digits)] @ (1 << 4 * np.arange(digits)) for scale in _grades(fingerprint)]])


def _alike(rows: np.ndarray, row: np.ndarray, weight: np.ndarray) -> np.ndarray:
    """:func:`likeness` of one padded fingerprint to each of ``rows``."""
    out = np.empty(len(rows))
    for start in range(0, len(rows), 4096):
        some = rows[start : start + 4096]
        alive = (some != END) | (row != END)
        total = alive @ weight
        out[start : start + 4096] = ((some == row) & alive) @ weight / np.where(total > 0, total, 1.0)
    return out


def _forest(members: list[str], at_least: float) -> list[tuple[int, int, float]]:
    """Links (i, j, likeness) that connect the same members as all pairs of ``at_least`` do.

    A member meets one representative of each class so far, then all others of the classes it is not yet linked to. So
    a group of near copies takes a comparison or two each, and only members unlike each other are compared in full.
    """
    length = max(map(len, members))
    rows = np.frombuffer("".join(s.ljust(length, "-") for s in members).encode(), np.uint8).reshape(len(members), length)
    weight = 2.0 ** np.maximum(0, np.arange(length) // OCTAVE - 1)
    label, links = np.arange(len(members)), []
    for i in range(1, len(members)):
        known = label[:i]
        first = np.flatnonzero(known == np.arange(i))           # a class is named by its first member
        for others in (first, None):
            if others is None:
                others = np.flatnonzero((known != np.arange(i)) & (known != label[i]))
            found = _alike(rows[others], rows[i], weight)
            for j in np.flatnonzero(found >= at_least):
                a, b = label[others[j]], label[i]
                if a != b:
                    links.append((i, int(others[j]), float(found[j])))
                    part = label[: i + 1]
                    part[part == max(a, b)] = min(a, b)
    return links


def near_documents(prints: DataFrame, at_least: float = 0.8, block: int = BLOCK) -> DataFrame:
    """(fingerprint, near, likeness): links that connect all fingerprints that meet in a band and are alike.

    Any two fingerprints of a key that are alike are linked, directly or through others. Equal fingerprints are folded
    first; keys of one fingerprint, and all but one of the keys that have the same fingerprints (by 128 bits of hashes), are
    left out before fingerprints are sent to their keys. A key with more than
    ``block`` is dealt in blocks, each pair of blocks being searched in a task of its own, so no pair is left out.
    """
    distinct = materialize(prints.select("fingerprint").where("fingerprint IS NOT NULL").distinct().withColumn(
        "id", F.monotonically_increasing_id()), "fingerprints", "zstd")
    one, other = (distinct.select(F.col("id").alias(i), F.col("fingerprint").alias(f"{i}_print")) for i in "uv")
    return links(distinct, at_least, block).join(one, "u").join(other, "v").select(
        F.greatest("u_print", "v_print").alias("fingerprint"), F.least("u_print", "v_print").alias("near"), "likeness")


def links(distinct: DataFrame, at_least: float, block: int = BLOCK) -> DataFrame:
    """u, v, likeness for rows (fingerprint, id) of distinct fingerprints, a written table, see :func:`near_documents`.

    Keys are counted first and made a second time for those that met, which takes less room than to write them all.
    Fingerprints travel to their keys as bytes of two digits.
    """
    bands, digits = key_shape(distinct.count())
    numbers = F.pandas_udf(lambda s: s.map(lambda x: key_numbers(x, bands, digits)), "array<long>")
    keyed = distinct.select("id", F.explode(numbers("fingerprint")).alias("key"))
    twice = materialize(keyed.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where("n > 1"), "keys", "zstd")
    met = materialize(keyed.join(twice, "key").select("id", "key", "n"), "met", "zstd")
    members = [F.bit_xor(F.xxhash64("id", F.lit(i))).alias(f"members{i}") for i in (0, 1)]
    chosen = met.groupBy("key", "n").agg(*members).groupBy("n", "members0", "members1").agg(F.min("key").alias("key"))
    met = met.join(chosen.select("key"), "key").withColumn("of", F.ceil(F.col("n") / block).cast("int")).withColumn(
        "mine", F.expr("CAST(pmod(xxhash64(id), of) AS INT)"))
    met = met.select("id", "key", F.explode(F.expr(
        "IF(of = 1, array(struct(0 AS a, 0 AS b)), transform(filter(sequence(0, of - 1), x -> x <> mine), "
        "x -> struct(least(x, mine) AS a, greatest(x, mine) AS b)))")).alias("pair")).select("id", "key", "pair.*")

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group, ids, texts = None, [], []

        def found() -> Iterator[pa.RecordBatch]:
            linked = [(ids[i], ids[j], x) for i, j, x in _forest(texts, at_least)] if len(ids) > 1 else []
            if linked:
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*linked, strict=True)], names=["u", "v", "likeness"])

        for batch in batches:
            for *of, id_, filled, packed in zip(
                    *(batch[c].to_pylist() for c in ("key", "a", "b", "id", "filled", "packed")), strict=True):
                if of != group:
                    yield from found()
                    group, ids, texts = of, [], []
                ids.append(id_)
                texts.append(packed.hex()[:filled])
        yield from found()

    text = F.rtrim("fingerprint", F.lit("-"))
    packed = distinct.select("id", F.length(text).alias("filled"), F.unhex(
        F.concat(text, F.when(F.length(text) % 2 == 1, "0").otherwise(""))).alias("packed"))
    dealt = met.join(packed, "id").repartition("key", "a", "b").sortWithinPartitions("key", "a", "b", "packed", "filled")
    return dealt.mapInArrow(search, "u long, v long, likeness double").distinct()


def document_classes(docs: DataFrame, at_least: float = 0.8) -> DataFrame:
    """The columns of :func:`fingerprint_documents` and ``near_class``, the smallest id of the document's class.

    A class are the documents connected by equal fingerprints and by the links of :func:`near_documents`. Null ids count
    only where a class has no other; its near_class is null then. Only classes of two documents or more are joined to rows.
    """
    rows = materialize(fingerprint_documents(docs), "edit-fingerprints", "zstd")
    distinct = materialize(rows.groupBy("fingerprint").agg(F.min("doc_id").alias("first"), F.count(F.lit(1)).alias("n"))
                           .withColumn("id", F.monotonically_increasing_id()), "fingerprints", "zstd")
    member = components(links(distinct.select("fingerprint", "id"), at_least).select("u", "v"))
    known = materialize(distinct.join(member, F.col("id") == F.col("node"), "left").where(
        "n > 1 OR node IS NOT NULL").select("fingerprint", "first", F.coalesce("root", "id").alias("root")), "classes", "zstd")
    least = known.groupBy("root").agg(F.min("first").alias("least"))
    named = materialize(known.join(least, "root").select("fingerprint", F.lit(True).alias("shared"), "least"), "named", "zstd")
    return rows.join(named, "fingerprint", "left").select(
        *rows.columns, F.when(F.col("shared"), F.col("least")).otherwise(F.col("doc_id")).alias("near_class"))
