"""Corpus pipeline: documents to packed training sequences, a stage at a time.

Every stage takes the rows its predecessor kept, with all their columns, and all but the
last return rows of the same columns. Empty tables, null columns and repeated rows pass as
the operators state; where there is nothing to learn from, the quality and language stages
keep every row.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from envlake.llm import language, line_dedup, packing, quality, simhash
from envlake.llm.tables import read_table, written


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows that the quality classifier accepts."""
    return quality.drop_low_quality(docs, read_table(spark, sf_dir, "labels"))


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows with a recognised language."""
    return language.drop_unknown_language(docs)


def line_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows without the boilerplate lines of their source."""
    return line_dedup.drop_boilerplate(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of near copies."""
    return simhash.drop_near_duplicates(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the texts that are left, in sequences with all sources in proportion."""
    return packing.pack(docs, public_tokenizers.path("byte_bpe_50k.json"))


STAGES = [
    ("quality_classifier", quality_classifier),
    ("language_id", language_id),
    ("line_dedup", line_dedup_stage),
    ("simhash_near_dedup", near_dedup),
    ("packing", pack),
]

# Trained models, similarity groups and token ids are beyond SQL; tests/llm holds the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents; each stage is written and reread as the next one's input."""
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
