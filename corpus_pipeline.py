"""The training-data pipeline: five stages over ``documents``, each one operator.

Every stage takes documents with a null in any column, empty and very long texts, ties, repeated rows, any
further columns whatever their names, and none at all; an empty table stays one, with its columns. What
each stage does with a null or empty text stands in its own docstring.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from holdfast.llm import lines, mixing, neardup, quality, tokens
from holdfast.llm.common import table, written


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the current policy keeps; a null, empty or blank text is too short and goes. Repeated rows are judged alike."""
    return quality.filtered(docs)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without passages that stand elsewhere; one of which nothing remains goes.

    A null or empty text stays as it is. Of repeated rows the first keeps its passages (least doc_id, null last).
    """
    return lines.deduplicated(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates: the one with the least doc_id, null last.

    Texts without words, null ones included, are linked with nothing and all stay; of repeated rows one stays.
    """
    return neardup.deduplicated(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in the mix's order; one that is taken twice occurs twice.

    A text without words has no size and is never taken. A null source is a source of its own.
    """
    return mixing.mix(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Ids of each document, with digests of the ids and of the text decoded from them; a null text is empty."""
    return tokens.token_columns(
        docs,
        public_tokenizers.path("byte_bpe_50k.tiktoken"),
        public_tokenizers.PATTERN,
        ("n_tokens", "ids", "ids_sha256", "decoded_sha256"),
    )


STAGES = [
    ("quality rules", quality_rules),
    ("line dedup", line_dedup),
    ("near-duplicates", near_duplicates),
    ("mixing", mix_sources),
    ("bpe", encode),
]

# Near-duplicate search and BPE ids are beyond SQL; tests/llm holds the stages against brute force
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in order; what a stage returns is written and read again, so each works on all that the one before kept."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{name.replace(' ', '-')}")
    return STAGES[-1][1](spark, docs, sf_dir)
