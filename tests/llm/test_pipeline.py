import random

import corpus_pipeline
from tests.llm.frames import prose
from tests.llm.test_best_fit_packing import check_places
from tests.llm.test_simhash_dedup import brute_components, brute_fingerprint

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def corpus():
    """Documents of each kind, and the ids of those that have to stay."""
    r = random.Random(8)
    passage = " ".join(f"shared{i}" for i in range(60))
    rows, clean, labels = [], [], []
    for i in range(120):
        text = prose(r, 150).strip()
        if i % 12 == 0:
            text += "\n" + passage
        rows.append((i, text))
        clean.append(i)
        labels.append((i, 1, 0))
    rows += [(200 + i, prose(r, 100) + " vilest scoundrel") for i in range(60)]
    labels += [(200 + i, 0, 1) for i in range(60)]
    rows += [(300 + i, rows[i][1]) for i in range(0, 40)] + [(400, "too short"), (401, None), (402, "the same words " * 80)]
    r.shuffle(rows)
    return [(i, t, "en", "a", None) for i, t in rows], clean, labels, passage


def test_stages_do_what_they_say(spark, tmp_path, many_partitions):
    rows, clean, labels, passage = corpus()
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    stages, texts = dict(corpus_pipeline.STAGES), {r[0]: r[1] for r in rows}

    def step(name, given):
        stages[name](spark, given, str(tmp_path)).write.parquet(f"{tmp_path}/{name}")
        out = spark.read.parquet(f"{tmp_path}/{name}")
        return out, {r.doc_id: r for r in out.collect()}

    kept, by_id = step("quality_rules", docs)
    assert kept.columns == COLUMNS and by_id.keys() == texts.keys() - {400, 401, 402}
    kept, by_id = step("toxicity", kept)
    assert kept.columns == COLUMNS and by_id.keys() == set(clean) | set(range(300, 340))
    kept, by_id = step("simhash_dedup", kept)
    prints = {i: brute_fingerprint(texts[i]) for i in set(clean) | set(range(300, 340))}
    component, first = brute_components(set(prints.values())), {}
    for i in sorted(prints):
        first.setdefault(component[prints[i]], i)
    assert kept.columns == COLUMNS and by_id.keys() == set(first.values())
    kept, by_id = step("substring_dedup", kept)
    assert kept.columns == COLUMNS
    assert [i for i in by_id if passage in by_id[i].text] == [0]
    assert all(by_id[i].text == texts[i] for i in by_id if i % 12)
    packed, _ = step("best_fit_packing", kept)
    assert check_places(packed.collect(), 2048) > 0
    assert {r.doc_id for r in packed.collect()} == by_id.keys()


def test_run_gives_the_last_stage(spark, tmp_path):
    rows, _, labels, _ = corpus()
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(
        f"{tmp_path}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    got = corpus_pipeline.run(spark, str(tmp_path)).collect()
    check_places(got, 2048)
    assert all(sum(r.length for r in got if r.doc_id == i) > 0 for i in {r.doc_id for r in got})


def test_empty_documents(spark, tmp_path):
    docs = spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long")
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0
