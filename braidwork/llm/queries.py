"""The registered queries of the training-data operators and their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from braidwork.llm import oracle
from braidwork.llm.common import read_table


def op1_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    from braidwork.llm.fingerprints import compare_versions

    return compare_versions(read_table(spark, sf_dir))


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    from braidwork.llm.toxicity import score_toxicity

    return score_toxicity(read_table(spark, sf_dir), read_table(spark, sf_dir, "labels"))


def op3_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    from braidwork.llm.quality import quality_rules

    return quality_rules(read_table(spark, sf_dir)).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"
    )


def op4_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    from public_tokenizers import path

    from braidwork.llm.bpe import bpe_digests

    return bpe_digests(read_table(spark, sf_dir), path("word_bpe_49k.json"))


def op5_substring(spark: SparkSession, sf_dir: str) -> DataFrame:
    from braidwork.llm.substring import substring_dedup

    return substring_dedup(read_table(spark, sf_dir))


def op6_suffixes(spark: SparkSession, sf_dir: str) -> DataFrame:
    from braidwork.llm.suffixes import suffix_dedup

    return suffix_dedup(read_table(spark, sf_dir))


def op7_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    from braidwork.llm.simhash import near_duplicates

    return near_duplicates(read_table(spark, sf_dir))


def op8_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    from braidwork.llm.mixing import mix_sources

    return mix_sources(read_table(spark, sf_dir)).select("doc_id", "size", "source_size", "target", "taken", "seats", "quota", "shard")


def op9_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    from braidwork.llm.licenses import license_scan

    return license_scan(read_table(spark, sf_dir))


def op10_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    from braidwork.llm.language import identify_languages

    return identify_languages(read_table(spark, sf_dir))


def op11_ranking(spark: SparkSession, sf_dir: str) -> DataFrame:
    from braidwork.llm.ranking import rank_documents

    return rank_documents(read_table(spark, sf_dir), read_table(spark, sf_dir, "benchmark"))


def op12_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    from braidwork.llm.secret_scan import secret_scan

    return secret_scan(read_table(spark, sf_dir))


def op13_conversations(spark: SparkSession, sf_dir: str) -> DataFrame:
    from braidwork.llm.conversations import damaged, repair_audits

    return repair_audits(damaged(read_table(spark, sf_dir, "conversations")), present="present")


QUERIES = (
    op1_fingerprints, op2_toxicity, op3_quality_rules, op4_bpe, op5_substring, op6_suffixes, op7_simhash, op8_mixing, op9_licenses,
    op10_language, op11_ranking, op12_secrets, op13_conversations,
)


def queries() -> dict:
    return {f.__name__: f for f in QUERIES}


def oracle_sql() -> dict[str, str]:
    return dict(oracle.SQL)
