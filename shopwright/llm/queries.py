"""The operators of this subpackage as named queries over whole tables, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from shopwright.llm import (
    chat,
    collocations,
    decontaminate,
    hard_negatives,
    html_text,
    language,
    licenses,
    line_dedup,
    near_dup,
    packing,
    quality,
    toxicity,
    url_filter,
)
from shopwright.llm.expr import table
from shopwright.llm.oracle import ORACLE


def op1_html_text(spark: SparkSession, folder: str) -> DataFrame:
    return html_text.page_report(table(spark, folder, "pages"))


def op2_licenses(spark: SparkSession, folder: str) -> DataFrame:
    return licenses.license_report(table(spark, folder, "documents"))


def op3_line_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return line_dedup.line_report(table(spark, folder, "documents"))


def op4_decontaminate(spark: SparkSession, folder: str) -> DataFrame:
    return decontaminate.contamination(table(spark, folder, "documents"), table(spark, folder, "benchmark"))


def op5_language(spark: SparkSession, folder: str) -> DataFrame:
    return language.language_report(table(spark, folder, "documents"))


def op6_quality(spark: SparkSession, folder: str) -> DataFrame:
    return quality.judged(table(spark, folder, "documents"))


def op7_url_filter(spark: SparkSession, folder: str) -> DataFrame:
    return url_filter.judged_urls(table(spark, folder, "pages"), url_filter.rule_table(spark))


def op8_packing(spark: SparkSession, folder: str) -> DataFrame:
    return packing.packed(table(spark, folder, "documents"), public_tokenizers.path("word_bpe_49k.json"))


def op9_chat(spark: SparkSession, folder: str) -> DataFrame:
    turns = table(spark, folder, "conversations").select("conv_id", "turn", "role", "text")
    return chat.chat_report(turns.unionByName(chat.probe(spark)))


def op10_near_duplicates(spark: SparkSession, folder: str) -> DataFrame:
    """Two-word shingles, 80 % similarity."""
    return near_dup.near_duplicates(table(spark, folder, "documents"), shingle=2)


def op11_hard_negatives(spark: SparkSession, folder: str) -> DataFrame:
    return hard_negatives.mined(table(spark, folder, "embeddings"))


def op12_collocations(spark: SparkSession, folder: str) -> DataFrame:
    return collocations.collocations(table(spark, folder, "documents"))


def op13_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    return toxicity.toxicity_report(table(spark, folder, "documents"), table(spark, folder, "labels"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    query.__name__: query
    for query in (
        op1_html_text,
        op2_licenses,
        op3_line_dedup,
        op4_decontaminate,
        op5_language,
        op6_quality,
        op7_url_filter,
        op8_packing,
        op9_chat,
        op10_near_duplicates,
        op11_hard_negatives,
        op12_collocations,
        op13_toxicity,
    )
}

__all__ = ["ORACLE", "QUERIES"]
