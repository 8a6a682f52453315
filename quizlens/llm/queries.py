"""The operators over whole tables, as registered queries."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from quizlens.llm import (
    best_fit_packing,
    bpe_codec,
    edit_fingerprints,
    hard_negatives,
    html_extraction,
    quality_rules,
    sharding,
    simhash_dedup,
    spelling,
    substring_dedup,
    tool_calls,
    toxicity,
    warc,
)
from quizlens.llm.tables import table

VOCABULARY = public_tokenizers.path("word_bpe_49k.json")


def op1_quality_rules(spark: SparkSession, sf: str) -> DataFrame:
    return quality_rules.document_verdicts(table(spark, sf, "documents"))


def op2_toxicity(spark: SparkSession, sf: str) -> DataFrame:
    return toxicity.document_scores(table(spark, sf, "documents"), table(spark, sf, "labels"))


def op3_html_extraction(spark: SparkSession, sf: str) -> DataFrame:
    return html_extraction.extract_pages(table(spark, sf, "pages"))


def op4_best_fit_packing(spark: SparkSession, sf: str) -> DataFrame:
    return best_fit_packing.pack_documents(table(spark, sf, "documents"), VOCABULARY)


def op5_substring_dedup(spark: SparkSession, sf: str) -> DataFrame:
    return substring_dedup.removal_digests(table(spark, sf, "documents"))


def op6_sharding(spark: SparkSession, sf: str) -> DataFrame:
    return sharding.shard_documents(table(spark, sf, "documents"))


def op7_simhash_dedup(spark: SparkSession, sf: str) -> DataFrame:
    return simhash_dedup.near_duplicates(table(spark, sf, "documents"))


def op8_edit_fingerprints(spark: SparkSession, sf: str) -> DataFrame:
    return edit_fingerprints.document_classes(table(spark, sf, "documents"))


def op9_tool_calls(spark: SparkSession, sf: str) -> DataFrame:
    return tool_calls.conversation_calls(table(spark, sf, "conversations"))


def op9_conversation_messages(spark: SparkSession, sf: str) -> DataFrame:
    return tool_calls.conversation_messages(table(spark, sf, "conversations"))


def op10_bpe_codec(spark: SparkSession, sf: str) -> DataFrame:
    return bpe_codec.encoding_digests(table(spark, sf, "documents"), VOCABULARY)


def op11_warc(spark: SparkSession, sf: str) -> DataFrame:
    return warc.archived_pages(table(spark, sf, "pages"))


def op12_hard_negatives(spark: SparkSession, sf: str) -> DataFrame:
    return hard_negatives.mined_embeddings(table(spark, sf, "embeddings"))


def op13_spelling_variants(spark: SparkSession, sf: str) -> DataFrame:
    return spelling.spelling_variants(table(spark, sf, "documents"))


ALL = [
    op1_quality_rules, op2_toxicity, op3_html_extraction, op4_best_fit_packing, op5_substring_dedup, op6_sharding,
    op7_simhash_dedup, op8_edit_fingerprints, op9_tool_calls,
    op9_conversation_messages, op10_bpe_codec, op11_warc, op12_hard_negatives,
    op13_spelling_variants,
]
ORACLE: dict[str, str] = {
    "op1_quality_rules": quality_rules.ORACLE, "op9_tool_calls": tool_calls.ORACLE,
    "op9_conversation_messages": tool_calls.MESSAGES_ORACLE,
    "op11_warc": warc.ORACLE, "op12_hard_negatives": hard_negatives.ORACLE}


def registry() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {query.__name__: query for query in ALL}
