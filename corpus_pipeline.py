"""From raw documents to packed training sequences, each stage one operator over all that its predecessor kept.

quality rules -> toxicity -> SimHash near-duplicates -> repeated passages -> best-fit packing
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from quizlens.llm import best_fit_packing, quality_rules, simhash_dedup, substring_dedup, toxicity
from quizlens.llm.tables import table
from quizlens.operators.materialize import materialize

VOCABULARY = public_tokenizers.path("word_bpe_49k.json")


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the rules for documents and hosts."""
    return quality_rules.kept_documents(docs)


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents not predicted to be toxic by a model of the labelled documents among them."""
    return toxicity.without_toxic(docs, table(spark, sf_dir, "labels"))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates, the one with the smallest id."""
    return simhash_dedup.one_of_each(docs)


def cut_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without passages of twenty words or more that an earlier place has."""
    return substring_dedup.without_repeats(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents and their places in sequences of 2048 tokens."""
    return best_fit_packing.pack_documents(docs, VOCABULARY)


STAGES = [
    ("quality_rules", keep_quality), ("toxicity", drop_toxic), ("simhash_dedup", drop_near_duplicates),
    ("substring_dedup", cut_repeats), ("best_fit_packing", pack),
]

#: A trained field, fingerprints and token ids are beyond SQL; tests/llm holds the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each result written and read again for the next."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
