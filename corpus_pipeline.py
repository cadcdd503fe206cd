"""The corpus pipeline: quality rules, SimHash near-duplicates, benchmark
decontamination, mixing to target weights, token ids.

Each stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame, which is
written as Parquet and read again as the next stage's ``docs``. All stages but
the last return the columns of ``documents``; each one's operator says what it
does with nulls, repeated rows, empty tables and further columns.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from framelake.llm import decontaminate, mixing, quality, simhash_dedup, token_codes
from framelake.llm.common import table, written
from framelake.llm.queries import END_ID, word_tokenizer


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the adaptive rules reject go."""
    return quality.apply_rules(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of linked fingerprints stays."""
    return simhash_dedup.deduplicate(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Benchmark passages are cut out; a document mostly made of them goes."""
    return decontaminate.decontaminate(docs, table(spark, sf_dir, "benchmark"))


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as systematic sampling to the target weights emits it."""
    return mixing.mix(docs)


def token_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix as a token file, and where in it each document is."""
    return token_codes.token_index(docs, word_tokenizer(), END_ID)


STAGES = [
    ("quality rules", quality_rules),
    ("SimHash near-dedup", near_duplicates),
    ("benchmark decontamination", decontamination),
    ("mixing sources to target weights", source_mix),
    ("token-ID / binary output", token_ids),
]
# SQL has neither the fingerprints' hash nor the tokenizer.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = table(spark, sf_dir, "documents")
    for number, (_, stage) in enumerate(STAGES[:-1]):
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{number}")
    return STAGES[-1][1](spark, docs, sf_dir)
