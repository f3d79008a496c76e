"""The registered queries of the corpus operators and their DuckDB SQL."""

from __future__ import annotations

from public_tokenizers import path as tokenizer

from clickscope.session import run_dir

from . import (decontamination, divergence_audit, exact_dedup, language_id, language_model, line_dedup, prefix_trie, quality_classifier,
               quality_rules, sentencepiece_codec, sharding, simhash, substring_dedup)
from .common import documents


def op1_simhash(spark, sf_dir):
    """Fingerprint and near-copy group of every document."""
    return simhash.near_groups(documents(spark, sf_dir), shingle=4, radius=4)


def op2_line_dedup(spark, sf_dir):
    """Lines that every document loses to recurring templates."""
    return line_dedup.summary(documents(spark, sf_dir))


def op3_decontamination(spark, sf_dir):
    """Benchmark passages found in documents: one row per (doc_id, item_id)."""
    return decontamination.matches(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def op4_quality_classifier(spark, sf_dir):
    """Quality score of every document; learned from the labels of three folds."""
    return quality_classifier.scores(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet"))


def op5_quality_rules(spark, sf_dir):
    """Measures and verdict of every document under the policy v2."""
    return quality_rules.quality(documents(spark, sf_dir), "v2")


def op6_language_id(spark, sf_dir):
    """Language of every document; learned from three folds."""
    return language_id.predictions(documents(spark, sf_dir))


def op7_substring_dedup(spark, sf_dir):
    """Words that every document loses to passages of documents with smaller ids."""
    return substring_dedup.dedup(documents(spark, sf_dir))


def op8_lm_scoring(spark, sf_dir):
    """log10 probability of every document under the hierarchical Pitman-Yor model."""
    return language_model.scores(documents(spark, sf_dir))


def op9_sentencepiece(spark, sf_dir):
    """Ids and round trip of every document with the 32k merge-type model."""
    return sentencepiece_codec.encode_documents(documents(spark, sf_dir), tokenizer("piece_bpe_32k.model"))


def op10_sharding(spark, sf_dir):
    """Shard of every document by extendible hashing."""
    return sharding.shards(documents(spark, sf_dir), sharding.LIMIT)


def op11_prefix_trie(spark, sf_dir):
    """Nodes of the prefix trie of the rebuilt conversations."""
    return prefix_trie.nodes(spark.read.parquet(f"{sf_dir}/conversations.parquet"))


def op12_divergence_audit(spark, sf_dir):
    """Divergence of every (lang, source) group from the language's other sources, and its leading terms."""
    return divergence_audit.report(documents(spark, sf_dir), min_docs=3, top=200)


def op13_exact_dedup(spark, sf_dir):
    """The row that stays of equal texts, decided by a stream's keyed state."""
    return exact_dedup.dedup(spark, f"{sf_dir}/documents.parquet", run_dir(spark, "exact-dedup"))


QUERIES = {f.__name__: f for f in (
    op1_simhash, op2_line_dedup, op3_decontamination, op4_quality_classifier, op5_quality_rules, op6_language_id,
    op7_substring_dedup, op8_lm_scoring, op9_sentencepiece, op10_sharding,
    op11_prefix_trie, op12_divergence_audit, op13_exact_dedup)}

ORACLE = {
    "op2_line_dedup": line_dedup.ORACLE,
    "op5_quality_rules": quality_rules.ORACLE,
    "op7_substring_dedup": substring_dedup.ORACLE,
    "op10_sharding": sharding.ORACLE,
    "op11_prefix_trie": prefix_trie.ORACLE,
    "op12_divergence_audit": divergence_audit.ORACLE,
    "op13_exact_dedup": exact_dedup.ORACLE,
}
