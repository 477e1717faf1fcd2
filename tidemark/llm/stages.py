"""The stages of the corpus pipeline; each takes (spark, docs, folder of tables)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tidemark.llm import decontaminate, line_dedup, quality, sentencepiece_codec, simhash
from tidemark.llm.common import table


def piece_model_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


def quality_stage(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Rejected documents go; the classifier learns from labelled documents of ``docs``, but for held-out ones."""
    return quality.good_documents(docs, table(spark, folder, "labels"))


def lines_stage(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Repeated lines go from texts."""
    return line_dedup.drop_lines(docs)


def near_copies_stage(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Fingerprints of three-word shingles that differ in at most three of 64 bits; the smallest id of a component stays."""
    return simhash.drop_copies(docs)


def benchmark_stage(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Documents that hold a benchmark passage go."""
    return decontaminate.clean_documents(docs, table(spark, folder, "benchmark"))


def pieces_stage(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """doc_id, number of ids, and digests of the ids and of the decoded text."""
    return sentencepiece_codec.digests(docs, sentencepiece_codec.read_model(piece_model_path()))
