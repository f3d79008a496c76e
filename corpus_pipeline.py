"""Corpus pipeline: language ID, line dedup, near-dedup, decontamination, tokens.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame that is written as
Parquet in the shared folder and read again as the next stage's ``docs``.  All but
the last return the columns of ``documents``.
"""

from __future__ import annotations

from public_tokenizers import path as tokenizer
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clickscope.llm import decontamination, language_id, line_dedup, sentencepiece_codec, simhash
from clickscope.llm.common import documents, written


def language_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the filters of some learned language hold; the others go."""
    return language_id.accepted(docs)


def line_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document, its text without recurring lines and n_chars of what is left."""
    return line_dedup.without_recurring(docs).withColumn("n_chars", F.length("text").cast("long"))


def near_copy_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id of each near-copy group."""
    return simhash.keep_one(docs, shingle=4, radius=4)


def benchmark_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a benchmark passage."""
    return decontamination.clean(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def token_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document with its token ids; the text as the tokens decode to it."""
    return sentencepiece_codec.with_round_trip(docs, tokenizer("piece_bpe_32k.model"))


STAGES = [
    ("language_id", language_stage),
    ("line_dedup", line_stage),
    ("near_dedup", near_copy_stage),
    ("decontamination", benchmark_stage),
    ("sentencepiece", token_stage),
]

#: Fingerprints and random walks have no SQL: tested against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of ``sf_dir``."""
    docs = documents(spark, sf_dir)
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
