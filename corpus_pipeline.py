"""A corpus pipeline of stages over ``documents``: each takes what its predecessor kept."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from basketry.llm import near_dedup, piece_codec, quality_rules, secret_scan, source_mix
from basketry.llm.common import stage, table


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the line-first rules, without their failing lines."""
    return quality_rules.keep_documents(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, that of the smallest id, of each group of near copies."""
    return near_dedup.drop_near_duplicates(docs)


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The same documents with secrets masked."""
    return secret_scan.mask_secrets(docs)


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix: a row per document and pass over it, the last pass cut to the words taken."""
    return source_mix.mixed_documents(docs)


def pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Piece ids of every text of the mix, with the digest of what they decode to."""
    return piece_codec.encode_documents(docs)


STAGES = [
    ("quality rules", quality),
    ("minhash near-dedup", near_duplicates),
    ("secret scans", secrets),
    ("source mix", mixture),
    ("piece codec", pieces),
]

#: Near-duplicate search and piece encoding have no SQL form; the pipeline is tested by brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, step in STAGES[:-1]:
        docs = stage(step(spark, docs, sf_dir), f"pipeline-{name.replace(' ', '-')}")
    return STAGES[-1][1](spark, docs, sf_dir)
