"""From raw documents to a mixed, encoded corpus, as five stages.

Each stage is a function of (spark, docs, sf_dir) whose result is written as Parquet and
read again as the next stage's ``docs``. All stages but the last return the columns of
``documents``; their decisions take effect in the rows and texts that they return.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from braidwork.llm.bpe import bpe_digests
from braidwork.llm.common import materialise, read_table
from braidwork.llm.mixing import mixed_documents
from braidwork.llm.quality import keep_good
from braidwork.llm.simhash import one_of_each
from braidwork.llm.suffixes import without_repeats


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that fail the quality rules go."""
    return keep_good(docs)


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate group stays."""
    return one_of_each(docs)


def repeated_text_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Bytes covered by repeated 200-byte strings are cut; documents without a word go."""
    return without_repeats(docs)


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often, and as far, as the mix takes them."""
    return mixed_documents(docs)


def encoding_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token counts and hashes of the ids and of the decoded text."""
    from public_tokenizers import path

    return bpe_digests(docs, path("word_bpe_49k.json"))


STAGES = [
    ("quality_rules", quality_stage),
    ("near_duplicates", near_duplicate_stage),
    ("repeated_text", repeated_text_stage),
    ("source_mixing", mixing_stage),
    ("bpe_encoding", encoding_stage),
]

# The fingerprints, the seeded mix and the encoding have no SQL form.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir)
    for name, stage in STAGES:
        docs = materialise(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
