"""Registered queries of the operators, over whole tables with production parameters."""

from __future__ import annotations

import zlib
from collections.abc import Callable

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import (
    alignment,
    decontaminate,
    kneser_ney,
    line_dedup,
    periodic_runs,
    quality,
    recompression,
    sharding,
    simhash,
    stages,
    suffix_array,
    topk,
    url_filter,
)
from tidemark.llm.common import table
from tidemark.llm.oracles import ORACLES
from tidemark.session import pin_session

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}

__all__ = ["ORACLES", "QUERIES"]


def query(function: Query) -> Query:
    def run(spark: SparkSession, folder: str) -> DataFrame:
        return function(pin_session(spark), folder)

    QUERIES[function.__name__] = run
    return function


@query
def op1_quality_classifier(spark: SparkSession, folder: str) -> DataFrame:
    return quality.rated(table(spark, folder, "documents"), table(spark, folder, "labels"))


@query
def op2_sharding(spark: SparkSession, folder: str) -> DataFrame:
    return sharding.place(table(spark, folder, "documents").select("doc_id"), "doc_id").select("doc_id", "slot", "shard")


@query
def op3_sentencepiece(spark: SparkSession, folder: str) -> DataFrame:
    return stages.pieces_stage(spark, table(spark, folder, "documents"), folder)


@query
def op4_suffix_array(spark: SparkSession, folder: str) -> DataFrame:
    return suffix_array.digests(table(spark, folder, "documents"))


@query
def op5_url_filter(spark: SparkSession, folder: str) -> DataFrame:
    """The list: every URL of `pages` on a host that advertises bets, pills or tracking."""
    pages = table(spark, folder, "pages").select("page_id", "url")
    listed = pages.where(url_filter.host_of(F.col("url")).rlike("casino|bets|pills|track")).select("url")
    return url_filter.judge(pages, listed)


@query
def op6_threshold_search(spark: SparkSession, folder: str) -> DataFrame:
    vectors = table(spark, folder, "embeddings").select("vec_id", "embedding")
    return topk.search(vectors, F.col("vec_id") % 50 == 0, 5)


@query
def op7_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    return decontaminate.find_leaks(table(spark, folder, "documents"), table(spark, folder, "benchmark"))


@query
def op8_simhash(spark: SparkSession, folder: str) -> DataFrame:
    return simhash.components(table(spark, folder, "documents"))


@query
def op9_recompression(spark: SparkSession, folder: str) -> DataFrame:
    return recompression.digests(table(spark, folder, "documents"))


@query
def op10_line_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return line_dedup.line_digests(table(spark, folder, "documents"))


def rewritten(doc: int | None, n: int) -> np.ndarray | None:
    """Fixed rule of the query: in a tenth of the documents the words from some place on repeat."""
    h = 1 if doc is None else zlib.crc32(str(doc).encode())
    if h % 10 or not n:
        return None
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    at = np.arange(n)
    return np.where(at < a, at, a + (at - a) % p)


@query
def op13_periodic_runs(spark: SparkSession, folder: str) -> DataFrame:
    return periodic_runs.digests(table(spark, folder, "documents"), rewritten)


@query
def op11_cross_tokenizer_alignment(spark: SparkSession, folder: str) -> DataFrame:
    import public_tokenizers

    a, b = (public_tokenizers.path(f) for f in ("byte_bpe_50k.json", "piece_bpe_32k.model"))
    return alignment.digests(table(spark, folder, "documents"), a, b)


@query
def op12_kneser_ney(spark: SparkSession, folder: str) -> DataFrame:
    """A row without an id is learnt from."""
    held_out = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 2, F.lit(False))
    return kneser_ney.held_out_scores(table(spark, folder, "documents"), held_out)
