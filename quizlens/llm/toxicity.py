"""Operator 2: toxic spans by a linear-chain conditional random field.

Training uses a bounded sample of labelled documents. Words and word beginnings that occur in toxic documents and
practically never in others become the labelled tokens; a field over (clean, toxic) then learns weights of hashed
word features and of the transitions from whole lines, by the gradient that forward and backward messages give.
Scoring runs both messages over every line of every document. The marginals give the offending spans, and the largest
marginal, calibrated on the sample, the score of the document. Everything per document happens in its own task; the
model is one array of fixed size.
"""

from __future__ import annotations

import heapq
import re
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quizlens.llm.text_words import WordTable

#: Bounds of the training sample: documents of either class, and characters of one of them.
SAMPLE_TOXIC, SAMPLE_CLEAN, SAMPLE_CHARS = 1500, 3000, 20_000
#: Bounds of the training lines: number, and tokens of a piece of one.
TRAIN_LINES, TRAIN_TOKENS = 10_000, 64
FEATURES = 1 << 18
FOLDS = 5
#: Toxic documents that share a word where no word is beyond chance.
FEWEST = 2
CHANCE = 1e-6
LIMIT = 30.0
TOKEN = re.compile(r"[^ \t-\r]+")
SPAN = "array<struct<start:int,end:int,probability:double>>"


def held_out(doc_id: Column) -> Column:
    """Every fifth document by a checksum of its id; labels of these are never learned from."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % FOLDS == 0, F.lit(False))


def plain(word: bytes) -> str:
    """The word in lower case, without signs at its ends."""
    return word.decode("utf-8", "replace").lower().strip(".,;:!?\"'()[]{}<>|*#$%&-_/\\")


def names(token: str) -> list[str]:
    """Features of a token: itself, how it begins and how it ends."""
    out = ["w=" + token]
    if len(token) > 4:
        out.append("4=" + token[:4])
        if len(token) > 5:
            out.append("5=" + token[:5])
            if len(token) > 6:
                out.append("6=" + token[:6])
    out.append("s=" + token[-3:])
    return out


def hashed(token: str) -> list[int]:
    return [zlib.crc32(x.encode("utf-8", "surrogatepass")) % FEATURES for x in names(token)]


@dataclass
class Model:
    """Log odds of each feature, of the start, and the four transition weights (from, to)."""

    weights: np.ndarray = field(default_factory=lambda: np.zeros(FEATURES, np.float32))
    bias: float = -LIMIT
    start: float = 0.0
    moves: np.ndarray = field(default_factory=lambda: np.zeros((2, 2)))
    slope: float = 1.0
    offset: float = 0.0

    def emissions(self) -> WordTable:
        """Log odds of words, computed from a list, which is quicker one value at a time."""
        weights, bias = self.weights.tolist(), self.bias

        def emission(word: bytes) -> float:
            token, value = plain(word), bias
            if token:
                for at in hashed(token):
                    value += weights[at]
            return min(LIMIT, max(-LIMIT, value))

        return WordTable(emission)

    def probability(self, largest: np.ndarray) -> np.ndarray:
        x = np.clip(self.slope * np.clip(largest, -LIMIT, LIMIT) + self.offset, -LIMIT, LIMIT)
        return 1 / (1 + np.exp(-x))


def messages(odds: np.ndarray, lengths: np.ndarray, start: float, moves: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Forward and backward odds (toxic to clean) of lines that lie end to end in ``odds``, all lines step by step."""
    order = np.argsort(-lengths, kind="stable")
    sizes = lengths[order]
    first = (np.cumsum(lengths) - lengths)[order]
    (c00, c01), (c10, c11) = np.exp(moves)
    forward, backward = np.empty_like(odds), np.ones_like(odds)
    if not len(sizes) or not sizes[0]:
        return forward, backward
    active = np.searchsorted(-sizes, -np.arange(sizes[0]), "left")     # lines longer than each step
    at = first[: active[0]]
    r = forward[at] = odds[at] * np.exp(start)
    for t in range(1, sizes[0]):
        at, r = first[: active[t]] + t, r[: active[t]]
        r = odds[at] * (c01 + c11 * r) / (c00 + c10 * r)
        forward[at] = np.clip(r, 1e-13, 1e13, out=r)
    last = first + sizes - 1
    b = np.empty(0)
    for t in range(1, sizes[0]):                                       # steps from the end of each line
        n = active[t]
        after = last[:n] - t + 1
        q = odds[after] * backward[after]
        b = (c10 + c11 * q) / (c00 + c01 * q)
        backward[after - 1] = np.clip(b, 1e-13, 1e13, out=b)
    return forward, backward


def _lines(text: str | None) -> list[list[bytes]]:
    data = text.encode("utf-8", "surrogatepass") if text else b""
    return [w for line in data.split(b"\n") if (w := line.split())]


def marginals(model: Model, table: WordTable, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """Log odds of the toxic tag for every word of all texts, and the number of words of each."""
    values, lengths, counts = [], [], []
    for text in texts:
        n = 0
        for line in _lines(text):
            values.extend(map(table.__getitem__, line))
            lengths.append(len(line))
            n += len(line)
        counts.append(n)
    odds = np.exp(np.array(values, np.float64))
    forward, backward = messages(odds, np.array(lengths, np.int64), model.start, model.moves)
    return np.log(forward) + np.log(backward), np.array(counts, np.int64)


def telling_features(texts: list[str], toxic: list[bool]) -> set[str]:
    """Words and beginnings that mark toxic documents: almost never elsewhere, and too often for chance.

    Occurrences count by document, and between the same two neighbours once, so copies of a text do not add up. Where toxic
    documents are so few that none is beyond chance, those count that two or more of them share, and at least half as many
    as share the most common one; such labels are less sure.
    """
    counts, seen = {True: Counter(), False: Counter()}, set()
    for text, label in zip(texts, toxic, strict=True):
        found = set()
        for line in _lines(text):
            tokens = [plain(w) for w in line]
            for left, token, right in zip(["", *tokens], tokens, [*tokens[1:], ""], strict=False):
                if token and (left, token, right) not in seen:
                    seen.add((left, token, right))
                    found.update(names(token)[:-1])
        counts[label].update(found)
    share = sum(toxic) / max(1, len(toxic))
    rare = {name: n for name, n in counts[True].items() if counts[False][name] * share < 0.02 * n * (1 - share)}
    sure = {name for name, n in rare.items() if share ** n < CHANCE}
    if sure:
        return sure
    most = max(rare.values(), default=0)
    return {name for name, n in rare.items() if n >= FEWEST and 2 * n >= most}


def _training_lines(texts: list[str], toxic: list[bool], marks: set[str]) -> tuple[list[list[str]], list[list[bool]]]:
    """Pieces of lines with their token labels: half of the bound with a toxic token and half without, or all there are.

    Beyond the bound pieces are chosen by a hash of their words and number, whatever the ids of their documents.
    """
    held: dict[bool, list] = {True: [], False: []}
    number = 0
    known: dict[bytes, tuple[str, bool]] = {}
    for text, label in zip(texts, toxic, strict=True):
        for line in _lines(text):
            for word in line:
                if word not in known:
                    token = plain(word)
                    known[word] = token, bool(token) and any(x in marks for x in names(token)[:-1])
            for at in range(0, len(line), TRAIN_TOKENS):
                pairs = [known[w] for w in line[at : at + TRAIN_TOKENS]]
                tags = [label and mark for _, mark in pairs]
                kind = held[any(tags)]
                number += 1
                rank = -xxhash.xxh64_intdigest(b" ".join(line[at : at + TRAIN_TOKENS]), number)
                if len(kind) < TRAIN_LINES // 2:
                    heapq.heappush(kind, (rank, number, [t for t, _ in pairs], tags))
                elif rank > kind[0][0]:
                    heapq.heapreplace(kind, (rank, number, [t for t, _ in pairs], tags))
    both = [x for kind in (True, False) for x in sorted(held[kind], key=lambda x: x[1])]
    return [x[2] for x in both], [x[3] for x in both]


def fit(texts: list[str], toxic: list[bool], steps: int = 60, rate: float = 0.3, decay: float = 1e-4) -> Model:
    """Train on a sample. Without documents of both classes, or telling words, nothing is called toxic."""
    marks = telling_features(texts, toxic) if any(toxic) and not all(toxic) else set()
    lines, tags = _training_lines(texts, toxic, marks) if marks else ([], [])
    if not lines:
        return Model()
    vocabulary: dict[str, int] = {}
    flat = np.array([vocabulary.setdefault(t, len(vocabulary)) for line in lines for t in line], np.int64)
    y = np.array([t for line in tags for t in line], float)
    lengths = np.array([len(line) for line in lines], np.int64)
    each = [hashed(t) if t else [] for t in vocabulary]
    token = np.repeat(np.arange(len(each)), [len(x) for x in each])
    feature = np.array([f for x in each for f in x], np.int64)
    ends = np.cumsum(lengths)
    inner = np.ones(len(flat), bool)
    inner[ends - lengths] = False
    to = np.flatnonzero(inner)
    before = to - 1
    model = Model(np.zeros(FEATURES), -3.0)
    sums = [np.full(FEATURES, 1e-8), 1e-8, 1e-8, np.full((2, 2), 1e-8)]
    seen_moves = np.array([[((1 - y[before]) * (1 - y[to])).sum(), ((1 - y[before]) * y[to]).sum()],
                           [(y[before] * (1 - y[to])).sum(), (y[before] * y[to]).sum()]])
    for _ in range(steps):
        score = model.bias + np.bincount(token, model.weights[feature], minlength=len(each))
        odds = np.exp(np.clip(score, -LIMIT, LIMIT))[flat]
        forward, backward = messages(odds, lengths, model.start, model.moves)
        p = forward * backward / (1 + forward * backward)
        miss = y - p
        c, r, q = np.exp(model.moves), forward[before], odds[to] * backward[to]
        pairs = np.array([[np.full(len(to), c[0, 0]), c[0, 1] * q], [c[1, 0] * r, c[1, 1] * r * q]])
        moves = seen_moves - (pairs / pairs.sum((0, 1))).sum(2)
        by_token = np.bincount(flat, miss, minlength=len(each))
        slopes = [np.bincount(feature, by_token[token], minlength=FEATURES) - decay * len(flat) * model.weights,
                  miss.sum(), miss[ends - lengths].sum(), moves]
        for i, slope in enumerate(slopes):
            sums[i] = sums[i] + slope * slope
        now = [rate * slope / np.sqrt(total) for slope, total in zip(slopes, sums, strict=True)]
        model.weights = model.weights + now[0]
        model.bias, model.start, model.moves = model.bias + now[1], model.start + now[2], model.moves + now[3]
    model.weights = model.weights.astype(np.float32)
    _calibrate(model, texts, toxic)
    return model


def _calibrate(model: Model, texts: list[str], toxic: list[bool]) -> None:
    x, y = largest_odds(*marginals(model, model.emissions(), texts)), np.array(toxic, float)
    x = np.clip(x, -10, 10)
    model.slope, model.offset = 1.0, 0.0
    for _ in range(50):      # Newton steps of a logistic regression with a weak pull towards (1, 0)
        p = 1 / (1 + np.exp(-np.clip(model.slope * x + model.offset, -LIMIT, LIMIT)))
        w = p * (1 - p)
        gradient = np.array([((y - p) * x).sum() + (1 - model.slope), (y - p).sum() - model.offset])
        second = np.array([[(w * x * x).sum() + 1, (w * x).sum()], [(w * x).sum(), w.sum() + 1]])
        step = np.linalg.solve(second, gradient)
        model.slope, model.offset = model.slope + np.clip(step[0], -1, 1), model.offset + np.clip(step[1], -1, 1)
    model.slope = max(model.slope, 0.1)


def largest_odds(odds: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """The largest log odds of each text; texts without words have the smallest possible."""
    out = np.full(len(counts), -LIMIT)
    first = np.cumsum(counts) - counts
    some = counts > 0
    if some.any():
        out[some] = np.maximum.reduceat(odds, first[some])
    return np.clip(out, -10, 10)


def spans(text: str, odds: np.ndarray) -> list[dict]:
    """Runs of toxic words on one line, as offsets in characters with their largest probability."""
    out, previous = [], None
    for match, value in zip(TOKEN.finditer(text), odds.tolist(), strict=True):
        if value <= 0:
            continue
        start, end = match.span()
        p = 1 / (1 + np.exp(-min(value, LIMIT)))
        if previous and not text[previous["end"] : start].strip(" \t\v\f\r"):
            previous |= {"end": end, "probability": max(p, previous["probability"])}
        else:
            out.append(previous := {"start": start, "end": end, "probability": float(p)})
    return out


def training_sample(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(text, toxic) of at most the bounded number of labelled documents of either class, chosen by a hash of the id."""
    usable = labels.where(~held_out(F.col("doc_id")) & F.col("toxic").isin(0, 1)).select("doc_id", "toxic")
    chosen = [usable.where(F.col("toxic") == kind).orderBy(F.xxhash64("doc_id"), "doc_id").limit(n)
              for kind, n in ((1, SAMPLE_TOXIC), (0, SAMPLE_CLEAN))]
    ids = F.broadcast(chosen[0].union(chosen[1]))       # at most SAMPLE_TOXIC + SAMPLE_CLEAN rows
    return docs.select("doc_id", "text").where(F.length("text") <= SAMPLE_CHARS).join(ids, "doc_id").orderBy(
        "doc_id", "text").limit(SAMPLE_TOXIC + SAMPLE_CLEAN).select("text", "toxic")


def train(docs: DataFrame, labels: DataFrame) -> Model:
    rows = training_sample(docs, labels).toPandas()
    return fit(rows["text"].tolist(), [bool(x) for x in rows["toxic"]])


def score_documents(docs: DataFrame, model: Model) -> DataFrame:
    """All columns and score (double), predicted (int), spans (array of start, end, probability).

    Null and empty texts get the score of a text without toxic words and no span. A column of ``docs`` with the name of
    a result is replaced. Repeated rows are answered each.
    """
    keep = [c for c in docs.columns if c not in ("score", "predicted", "spans")]
    schema = docs.select(*keep, F.lit(0.0).alias("score"), F.lit(0).alias("predicted"),
                         F.lit(None).cast(SPAN).alias("spans")).schema

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = model.emissions()
        kind = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("probability", pa.float64())]))
        for whole in batches:
            for at in range(0, whole.num_rows, 1000):
                batch = whole.slice(at, 1000)
                texts = batch["text"].to_pylist()
                odds, counts = marginals(model, table, texts)
                largest = largest_odds(odds, counts)
                p, found = model.probability(largest), [[] for _ in texts]
                first = np.cumsum(counts) - counts
                for i in np.flatnonzero(largest > 0):
                    found[i] = spans(texts[i], odds[first[i] : first[i] + counts[i]])
                yield pa.RecordBatch.from_arrays(
                    [*(batch[c] for c in keep), pa.array(p), pa.array((p >= 0.5).astype(np.int32)), pa.array(found, kind)],
                    names=[*keep, "score", "predicted", "spans"])

    return docs.select(keep).mapInArrow(score, schema)


def document_scores(docs: DataFrame, labels: DataFrame) -> DataFrame:
    model = train(docs, labels)
    return score_documents(docs.select(F.col("doc_id").cast("long"), "text"), model).select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", "predicted", "spans")


def without_toxic(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The documents not predicted to be toxic, with the columns they came with."""
    model = train(docs, labels)
    slim = [f"_c{i}" for i in range(len(docs.columns))]
    renamed = docs.select(*[F.col(f"`{c}`").alias(n) for c, n in zip(docs.columns, slim, strict=True)],
                          F.col("text").alias("text"))
    return score_documents(renamed, model).where("predicted = 0").select(
        *[F.col(n).alias(c) for c, n in zip(docs.columns, slim, strict=True)])
