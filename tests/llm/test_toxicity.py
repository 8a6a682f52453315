import itertools
import random
import zlib

import numpy as np

from quizlens.llm import toxicity as tx
from quizlens.llm.tables import table
from tests.llm.frames import documents, frame, prose


def test_messages_equal_enumeration():
    rng = np.random.default_rng(0)
    lengths = np.array([4, 1, 6, 3])
    scores, start, moves = rng.normal(size=lengths.sum()), 0.3, rng.normal(size=(2, 2))
    forward, backward = tx.messages(np.exp(scores), lengths, start, moves)
    p, at = forward * backward / (1 + forward * backward), 0
    for n in lengths.tolist():
        total, marked = 0.0, np.zeros(n)
        for tags in itertools.product((0, 1), repeat=n):
            weight = np.exp(scores[at : at + n] @ np.array(tags) + start * tags[0] + sum(moves[a, b] for a, b in zip(tags, tags[1:])))
            total += weight
            marked += weight * np.array(tags)
        assert np.allclose(p[at : at + n], marked / total)
        at += n


def corpus(n=900, seed=3):
    r = random.Random(seed)
    rows, labels = [], []
    for i in range(n):
        words = prose(r, r.randint(5, 120)).split(" ")
        toxic = int(r.random() < 0.2)
        if toxic:
            for _ in range(r.randint(1, 3)):
                words.insert(r.randrange(len(words) + 1), r.choice(["Vilest!", "scoundrel,", "rottencore" + r.choice("abcdefgh")]))
        rows.append((i, " ".join(words), None, None, None, None, None))
        if r.random() < 0.8:
            labels.append((i, 1, toxic))
    return rows, labels, {i: t for i, _, t in labels}


def test_held_out_accuracy_and_spans(spark, many_partitions):
    rows, labels, truth = corpus()
    docs = frame(spark, rows)
    got = tx.document_scores(docs, spark.createDataFrame(labels, "doc_id long, quality int, toxic int")).collect()
    assert len(got) == len(rows)
    texts = {r[0]: r[1] for r in rows}
    for r in got:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0)
        assert 0 <= r.score <= 1 and r.predicted == (r.score >= 0.5)
        for s in r.spans:
            assert s.probability > 0.5 and any(w in texts[r.doc_id][s.start : s.end].lower() for w in ("vilest", "scoundrel", "rottencore"))
    held = [r for r in got if r.held_out and r.doc_id in truth]
    assert len(held) > 100 and np.mean([r.predicted == truth[r.doc_id] for r in held]) > 0.97


def test_labels_of_held_out_documents_are_not_read(spark):
    rows, labels, _ = corpus(300)
    changed = [(i, q, 1 - t if zlib.crc32(str(i).encode()) % 5 == 0 else t) for i, q, t in labels]
    one, two = ({r.doc_id: r.score for r in tx.document_scores(
        frame(spark, rows), spark.createDataFrame(x, "doc_id long, quality int, toxic int")).collect()} for x in (labels, changed))
    assert one == two


def test_without_labels_nothing_is_toxic(spark):
    rows = documents(1)
    docs = frame(spark, rows)
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    got = tx.document_scores(docs, labels).collect()
    assert len(got) == len(rows) and not any(r.predicted or r.spans for r in got)
    kept = tx.without_toxic(docs, labels)
    assert kept.schema == docs.schema and kept.count() == len(rows)
    assert tx.document_scores(frame(spark, []), labels).count() == 0


def test_test_tables_are_separable(spark):
    sf = "/root/testdata/sf0.01"
    labels = table(spark, sf, "labels")
    got = tx.document_scores(table(spark, sf, "documents"), labels).join(labels, "doc_id").where("held_out").select(
        "predicted", "toxic").collect()
    assert np.mean([a == b for a, b in got]) > 0.93


def test_training_lines_come_from_all_documents(monkeypatch):
    from quizlens.llm import toxicity

    monkeypatch.setattr(toxicity, "TRAIN_LINES", 100)
    texts = [f"plain{i} words vile{i % 2}\nother plain{i} words" for i in range(600)]
    lines, tags = toxicity._training_lines(texts, [True] * 600, {"vile0", "vile1"} | {
        x for i in (0, 1) for x in toxicity.names(toxicity.plain(f"vile{i}".encode()))[:-1]})
    assert len(lines) == 100 and sum(map(any, tags)) == 50
    numbers = sorted(int(w[5:]) for line in lines for w in map(str, line) if w.startswith("plain"))
    assert numbers[0] < 100 and numbers[-1] > 500


def test_few_labels_still_mark_what_toxic_texts_share():
    """Six toxic texts: no word is beyond chance, yet one they share and others lack marks them."""
    r = random.Random(8)
    plain = [f"we saw w{r.randrange(400)} and w{r.randrange(400)} of it w{i}" for i in range(40)]
    bad = [f"you are a vile{'st' if i % 2 else ''} w{r.randrange(400)} of it q{i}" for i in range(6)]
    texts, labels = plain + bad, [False] * 40 + [True] * 6
    marks = tx.telling_features(texts, labels)
    assert any("vile" in m for m in marks) and not any("saw" in m for m in marks)
    assert tx.telling_features(plain, [False] * 40) == set()
    model = tx.fit(texts, labels)
    assert model.weights.any()
