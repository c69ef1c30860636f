"""From raw documents to packed training sequences, stage by stage.

Each stage reads what the one before it kept, written as Parquet. All but the last
return the columns of ``documents``; the last returns the pieces of packed sequences.

Defined cases are those of the operators. Rows with a null text go in the first
stage, as they have no language. ``n_chars`` follows the text where a stage changes it.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shopwright.llm import decontaminate, language, line_dedup, near_dup, packing
from shopwright.llm.expr import table
from shopwright.shared import stored


def clear_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is told with a sufficient margin, learned from the rows at hand."""
    return language.recognised(docs)


def fresh_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines of templates that recur across documents are taken out of every text."""
    return line_dedup.without_recurring_lines(docs).withColumn("n_chars", F.length("text").cast("long"))


def distinct_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group with equal or similar texts (five-word shingles, 0.8)."""
    return near_dup.drop_near_duplicates(docs)


def unseen_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a window of a test item go."""
    return decontaminate.clean(docs, table(spark, sf_dir, "benchmark"))


def sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents' tokens, cut and packed into sequences."""
    return packing.packed(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [
    ("language", clear_language),
    ("line_dedup", fresh_lines),
    ("near_dup", distinct_documents),
    ("decontaminate", unseen_benchmark),
    ("packing", sequences),
]

# Compression sizes and token ids have no SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents table; one row per piece."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
