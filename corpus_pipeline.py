"""Corpus pipeline: documents to packed training sequences, each stage on all that the last one kept.

Also hands on the queries of the training-data operators.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from strataflow.llm import bpe, exact, language, packing, queries, secrets, simhash
from strataflow.llm.common import stored


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is found; those without letters, or without a likely language, go."""
    return language.identified(docs, language.read_pieces(public_tokenizers.path(queries.PIECES)))


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the document with the largest id stays."""
    return exact.distinct_documents(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each component of near copies (fingerprints of three-word shingles at three or fewer
    differing bits) the document with the smallest id stays."""
    return simhash.distinct_documents(docs)


def mask_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents; what is a secret in their texts is masked."""
    return secrets.redact(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents with their places in sequences."""
    return packing.pack(docs, bpe.read_ranks(public_tokenizers.path(queries.RANKS)), public_tokenizers.PATTERN)


STAGES = [
    ("language", known_language),
    ("exact", exact_dedup),
    ("near", near_dedup),
    ("secrets", mask_secrets),
    ("packing", pack),
]

#: Trained models and components have no SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = spark.read.parquet(f"{sf_dir.rstrip('/')}/documents.parquet")
    for name, stage in STAGES:
        rows = stored(stage(spark, rows, sf_dir), f"pipeline-{name}")
    return rows


QUERIES = {**queries.QUERIES, "pipeline": run}
SQL = dict(queries.SQL)
