"""The corpus pipeline: five stages, each written as Parquet and read again as the next one's documents.

1. quality: documents that the classifier rejects go.
2. lines: lines that a document with a smaller id holds go; every document stays, if only with what is left.
3. near_copies: of each component of SimHash fingerprints (three-word shingles, at most three of 64 bits) the
   smallest id stays.
4. benchmark: documents that hold a benchmark passage, up to a few edits, go.
5. pieces: what is left is encoded and decoded; a row for each document.

Every stage but the last returns the columns of ``documents``, and works on all that its predecessor kept.
Null texts count as empty and stay null where a document stays; texts without words have one fingerprint. Rows with a null ``doc_id`` take no part in comparisons between documents and stay. Rows that repeat
both ``doc_id`` and text stay or go together. An empty table passes through all stages.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tidemark.llm import stages
from tidemark.session import pin_session, scratch_path

#: (name, function of spark, docs and the folder of tables)
STAGES = [
    ("quality", stages.quality_stage),
    ("lines", stages.lines_stage),
    ("near_copies", stages.near_copies_stage),
    ("benchmark", stages.benchmark_stage),
    ("pieces", stages.pieces_stage),
]

#: SQL cannot express the classifier, the fingerprints or the encoder.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    pin_session(spark)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for number, (name, stage) in enumerate(STAGES):
        if number:
            docs = spark.read.schema(docs.schema).parquet(path)
        docs = stage(spark, docs, sf_dir)
        path = scratch_path(spark, f"pipeline-{name}")
        docs.write.parquet(path)
    return spark.read.schema(docs.schema).parquet(path)
