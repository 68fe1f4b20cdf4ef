"""Registered queries of the training-data operators and their SQL twins."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from marketlens.llm import (
    decontaminate, fingerprint, langid, line_dedup, packing, prefixtrie, quality, repeats, rules, simhash, toxicity, urlfilter,
    whitening)
from marketlens.llm.common import table

Query = Callable[[SparkSession, str], DataFrame]


def op1_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Perplexity of every document, its language's threshold, and whether it is kept."""
    return quality.quality_digest(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op2_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SimHash fingerprint and near-duplicate class of every document."""
    return simhash.simhash_digest(table(spark, sf_dir, "documents"))


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity score of every document."""
    return toxicity.toxicity_digest(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op4_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rule and verdict of every page's URL."""
    return urlfilter.url_digest(table(spark, sf_dir, "pages"))


def op5_document_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of every document and of its edited text, with their likeness."""
    return fingerprint.fingerprint_digest(table(spark, sf_dir, "documents"))


def op6_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document without the lines that an earlier document holds."""
    return line_dedup.line_digest(table(spark, sf_dir, "documents"))


def op7_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The pieces of every document, placed in sequences of 2048 tokens."""
    return packing.packing_digest(table(spark, sf_dir, "documents"))


def op8_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document without the bytes that repeat a smaller document."""
    return repeats.repeats_digest(table(spark, sf_dir, "documents"))


def op9_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents that hold a passage of the benchmark, with item, score and span."""
    return decontaminate.leak_digest(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op10_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Predicted language of every document."""
    return langid.langid_digest(table(spark, sf_dir, "documents"))


def op11_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whitened values of every embedding on the 32 leading components."""
    return whitening.whitening_digest(table(spark, sf_dir, "embeddings"))


def op12_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts and verdict of every document."""
    return rules.rules_digest(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op13_conversation_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nodes of the trie of rebuilt conversations, with subtree figures."""
    return prefixtrie.trie_digest(table(spark, sf_dir, "conversations"))


QUERIES: dict[str, Query] = {
    "op1_quality_classifier": op1_quality_classifier,
    "op2_simhash_near_dedup": op2_simhash_near_dedup,
    "op3_toxicity": op3_toxicity,
    "op4_url_filter": op4_url_filter,
    "op5_document_fingerprints": op5_document_fingerprints,
    "op6_line_dedup": op6_line_dedup,
    "op7_best_fit_packing": op7_best_fit_packing,
    "op8_suffix_array_dedup": op8_suffix_array_dedup,
    "op9_decontamination": op9_decontamination,
    "op10_language_id": op10_language_id,
    "op11_embedding_whitening": op11_embedding_whitening,
    "op12_quality_rules": op12_quality_rules,
    "op13_conversation_prefix_trie": op13_conversation_prefix_trie,
}

ORACLE: dict[str, str] = {
    "op6_line_dedup": line_dedup.ORACLE_SQL,
    "op8_suffix_array_dedup": repeats.ORACLE_SQL,
    "op13_conversation_prefix_trie": prefixtrie.ORACLE_SQL,
}
