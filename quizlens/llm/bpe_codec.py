"""Operator 10: byte-pair encoding and decoding.

A word starts as a doubly linked list of byte symbols. A heap holds the known merges of neighbouring symbols, lowest
rank first and leftmost first among equals. A popped entry whose symbols have changed since is stale and skipped;
otherwise its two symbols become one and the merges with both new neighbours are pushed. Texts are decoded by
joining the vocabulary strings of their ids with a space, which is what a vocabulary file without a decoder asks for.
"""

from __future__ import annotations

import hashlib
import heapq
import json
import re
import unicodedata
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quizlens.llm.text_words import WordTable, words

# How the vocabulary file cuts a word into parts.
PARTS = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d|\p{L}+|\p{N}|[^\p{White_Space}\p{L}\p{N}]+")


def parts_of(word: str) -> list[str]:
    """Normalised parts of a word, which are encoded one by one."""
    plain = unicodedata.normalize("NFC", word)
    plain = plain.lower() if "\u03a3" not in plain else "".join(c.lower() for c in plain)    # no final sigma
    return PARTS.findall(plain)


def byte_symbols() -> list[str]:
    """The visible character that stands for each byte: itself where printable, else the next one from 256 on."""
    visible = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in visible]
    return [chr(b) if b in visible else chr(256 + hidden.index(b)) for b in range(256)]


class Codec:
    """Encoder and decoder of a vocabulary file with word ends (``model.vocab``, ``model.merges``, ``added_tokens``)."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            content = json.load(file)
        model = content["model"]
        self.ids: dict[str, int] = model["vocab"]
        self.end: str = model["end_of_word_suffix"] or ""
        pairs = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]]
        self.merges = {(self.ids[a], self.ids[b]): (rank, self.ids[a + b]) for rank, (a, b) in enumerate(pairs)}
        self.special = {t["content"]: t["id"] for t in content["added_tokens"]}
        self.strings = {i: s for s, i in (self.ids | self.special).items()}
        self.marks = re.compile("|".join(f"({re.escape(s)})" for s in self.special)) if self.special else None
        symbols = byte_symbols()
        self.inner = [self.ids.get(s) for s in symbols]
        self.last = [self.ids.get(s + self.end) for s in symbols]
        self.parts = WordTable(self._encode_part)
        self.encoded = WordTable(self._encode_word)
        self.texts = WordTable(self._texts_of)

    def merge(self, ids: list[int]) -> list[int]:
        """Apply all merges to one part of a word."""
        n, known = len(ids), self.merges.get
        heap = [(m[0], at, *pair, m[1]) for at, pair in enumerate(zip(ids, ids[1:], strict=False)) if (m := known(pair))]
        if not heap:
            return ids
        heapq.heapify(heap)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        pop, push = heapq.heappop, heapq.heappush
        while heap:
            _, at, left, right, merged = pop(heap)
            gone = after[at]
            if ids[at] != left or gone >= n or ids[gone] != right:
                continue
            ids[at], ids[gone] = merged, -1
            after[at] = following = after[gone]
            if following < n:
                before[following] = at
                if m := known((merged, ids[following])):
                    push(heap, (m[0], at, merged, ids[following], m[1]))
            if (previous := before[at]) >= 0 and (m := known((ids[previous], merged))):
                push(heap, (m[0], previous, ids[previous], merged, m[1]))
        return [i for i in ids if i >= 0]

    def _encode_part(self, part: str) -> list[int]:
        data, inner = part.encode("utf-8", "surrogatepass"), self.inner
        ids = [inner[b] for b in data[:-1]]
        ids.append(self.last[data[-1]])
        return self.merge(ids if None not in ids else [i for i in ids if i is not None])

    def _encode_word(self, word: bytes) -> list[int]:
        if word.isalpha():      # ASCII letters only
            return self.parts[word.lower().decode()]
        text, out = word.decode("utf-8", "surrogatepass"), []
        for run in filter(None, self.marks.split(text)) if self.marks and b"<" in word else [text]:
            if run in self.special:
                out.append(self.special[run])
                continue
            for part in parts_of(run):
                out += self.parts[part]
        return out

    def _texts_of(self, word: bytes) -> tuple[str, str]:
        """The ids of a word and its vocabulary strings, each joined by a space."""
        ids, strings = self._encode_word(word), self.strings
        return " ".join(map(str, ids)), " ".join([strings[i] for i in ids])

    def encode(self, text: str | None) -> list[int]:
        return [i for word in words(text) for i in self.encoded[word]]

    def decode(self, ids: list[int]) -> str:
        return " ".join(self.strings[i] for i in ids)


@lru_cache(maxsize=2)
def codec(path: str) -> Codec:
    """One per worker and file."""
    return Codec(path)


def _sha256(text: str) -> str:
    return hashlib.sha256(text.encode("utf-8", "surrogatepass")).hexdigest()


def encode_documents(docs: DataFrame, path: str) -> DataFrame:
    """(doc_id, ids array, decoded text) of every document; a null text has no ids. Other columns are not read."""

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = codec(path)
        for batch in batches:
            ids = [own.encode(t) for t in batch["text"].to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch["doc_id"], pa.array(ids, pa.list_(pa.int32())), pa.array(map(own.decode, ids), pa.string())],
                names=["doc_id", "ids", "decoded"])

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(encode, "doc_id long, ids array<int>, decoded string")


def decode_ids(rows: DataFrame, path: str, ids: str = "ids") -> DataFrame:
    """Add ``decoded`` to rows that hold an array of ids (null array: null)."""

    def decode(values):
        own = codec(path)
        return values.map(lambda v: None if v is None else own.decode(v.tolist() if hasattr(v, "tolist") else v))

    return rows.withColumn("decoded", F.pandas_udf(decode, "string", F.PandasUDFType.SCALAR)(F.col(ids)))


def encoding_digests(docs: DataFrame, path: str) -> DataFrame:
    """Per document: doc_id, n_tokens, ids_sha256 and decoded_sha256, without holding the ids of a text as rows.

    Null and empty texts have no token and the digests of the empty string. Rows that repeat are answered each.
    """

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = codec(path)
        for batch in batches:
            rows = []
            for text in batch["text"]:
                pairs = list(map(own.texts.__getitem__, words(text.as_py())))
                ids = " ".join([a for a, _ in pairs if a])
                decoded = " ".join([b for _, b in pairs if b])
                rows.append((ids.count(" ") + 1 if ids else 0, _sha256(ids), _sha256(decoded)))
            n, a, b = zip(*rows, strict=True) if rows else ((), (), ())
            yield pa.RecordBatch.from_arrays(
                [batch["doc_id"], pa.array(n, pa.int64()), pa.array(a, pa.string()), pa.array(b, pa.string())],
                names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(
        digest, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")
