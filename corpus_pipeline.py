"""A training-data pipeline over ``documents``: each stage is one operator, works on all that its predecessor
kept, and is written as Parquet before the next one reads it.

    quality rules -> near-duplicates -> repeated passages -> benchmark leaks -> SentencePiece ids

The first and fourth stage drop rows, the second keeps one row of each group,
the third cuts words from ``text``, and the last returns the ids.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tripwire.llm import decontaminate, near_dedup, quality_rules, sentencepiece_codec, substring_dedup
from tripwire.llm._tables import read_table, stored
from tripwire.llm.queries import ship_package, tokenizer_path


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the quality rules."""
    ship_package(spark)
    return quality_rules.keep_good(docs)


def deduplicate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate group (five-word shingles, similarity 0.8)."""
    ship_package(spark)
    return near_dedup.keep_representatives(docs, shingle=5, percent=80)


def cut_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without words that repeat an earlier passage of 20 words or more."""
    ship_package(spark)
    return substring_dedup.cut_repeats(docs)


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    ship_package(spark)
    return decontaminate.keep_clean(docs, read_table(spark, sf_dir, "benchmark"))


def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """SentencePiece ids of each document, with the source bytes of each piece."""
    ship_package(spark)
    return sentencepiece_codec.encode(docs, tokenizer_path())


STAGES = [
    ("quality_rules", quality),
    ("near_duplicates", deduplicate),
    ("substring_dedup", cut_passages),
    ("decontamination", decontaminated),
    ("sentencepiece", encoded),
]

# The first stage weighs its rules by expectation-maximisation and the last needs the tokenizer: no SQL for them.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each but the last is written and read again."""
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
