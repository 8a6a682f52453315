import hashlib
import random

import public_tokenizers
import pytest
from tokenizers import Tokenizer

from quizlens.llm import bpe_codec as bc
from tests.llm.frames import documents, frame

PATH = public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


def texts():
    r = random.Random(1)
    out = ["".join(r.choice("aAeéßΣσ's<|>endoftext  12½日´̈ǅ\t\n ") for _ in range(200)) for _ in range(200)]
    return out + ["", " ", "It's I'll 'd don''t ΣΑΣ İstanbul \x1c a\x1cb \x85x é ́x <|endoftext|>x<|startoftext|> a", "ab" * 3000,
                  "ﬁ ﬂ Ǆ ẞ ​ ﻿ x‍y K 🙂🙂 Ⅳ", "don'S 'RE </w> a</w>", *[r[1] or "" for r in documents(1)]]


def test_equals_the_library(library):
    codec = bc.Codec(PATH)
    for text in texts():
        ids = library.encode(text, add_special_tokens=False).ids
        assert codec.encode(text) == ids
        assert codec.decode(ids) == library.decode(ids, skip_special_tokens=False)


def test_every_id_decodes_to_its_string(library):
    codec = bc.Codec(PATH)
    assert all(codec.decode([i]) == library.id_to_token(i) for i in range(library.get_vocab_size()))


def test_tables(spark, library):
    rows = documents(1) + [(900 + i, t, None, None, None, None, None) for i, t in enumerate(texts())]
    docs = frame(spark, rows)
    got = sorted(map(tuple, bc.encoding_digests(docs, PATH).collect()), key=str)

    def sha(text):
        return hashlib.sha256(text.encode()).hexdigest()

    expected = []
    for doc_id, text in ((r[0], r[1] or "") for r in rows):
        ids = library.encode(text, add_special_tokens=False).ids
        expected.append((doc_id, len(ids), sha(" ".join(map(str, ids))), sha(library.decode(ids, skip_special_tokens=False))))
    assert got == sorted(expected, key=str)
    encoded = bc.encode_documents(docs, PATH)
    for r in bc.decode_ids(encoded.withColumnRenamed("decoded", "direct"), PATH).collect():
        assert r.decoded == r.direct
    assert bc.encoding_digests(frame(spark, []), PATH).count() == 0


def test_word_table_starts_anew(monkeypatch):
    from quizlens.llm import text_words

    monkeypatch.setattr(text_words, "CACHE_ENTRIES", 3)
    table = text_words.WordTable(len)
    assert [table[b"x" * n] for n in range(1, 9)] == list(range(1, 9)) and len(table) <= 3
    assert table[b"y" * 100] == 100 and b"y" * 100 not in table
