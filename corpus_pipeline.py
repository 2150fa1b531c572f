"""The corpus pipeline: documents through five operators, each stage on what its predecessor kept.

A row is judged by its own text: rows with a null or repeated id are rows like others, and take no other row along. Null,
empty and wordless texts are kept or rejected by the classifier as texts of their own kind, have no copies, hold no item and
no secret, and have no tokens. Other columns than doc_id, text and n_chars (the length, made anew where the table has it)
pass as they are. An empty table goes through. Every stage sends TEXTS_AT_ONCE rows to Python at once, at most.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marquee.llm.bpe import bpe_tokens
from marquee.llm.decontam import without_contaminated
from marquee.llm.jaccard import one_of_each
from marquee.llm.quality import good_documents
from marquee.llm.secrets import train_char_models, without_secrets
from marquee.llm.shared import few_rows_a_batch, staged


def good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Stage 1: documents that the quality classifier rejects go."""
    few_rows_a_batch(spark)
    return good_documents(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def different(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Stage 2: one document of each group of near copies stays (five words, similarity 0.8)."""
    few_rows_a_batch(spark)
    return one_of_each(docs, words=5, num=80)


def clean(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Stage 3: documents that hold a benchmark item go."""
    few_rows_a_batch(spark)
    return without_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def without_keys(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Stage 4: secrets are replaced; n_chars follows the text."""
    few_rows_a_batch(spark)
    replaced = without_secrets(docs, train_char_models(docs))
    if "n_chars" not in docs.columns:
        return replaced
    return replaced.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))


def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Stage 5: the token ids of every document that is left, and the round trip."""
    few_rows_a_batch(spark)
    return bpe_tokens(docs, public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)


STAGES = [
    ("quality", good),
    ("jaccard", different),
    ("decontamination", clean),
    ("secrets", without_keys),
    ("byte_bpe", encoded),
]

#: SQL can't express trained models, alignment or merges; tests/llm compares with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
