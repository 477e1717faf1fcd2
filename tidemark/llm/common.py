"""What the operators share: reading tables, keys of texts, tables in the shared folder, packed spans.

Rows are named by (doc_id, text_key). The text key is a hash of the text, so two rows that repeat a
``doc_id`` with different texts are never mixed up, and rows that repeat both get the same result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.session import scratch_path

ASCII_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
ASCII_LOWER = "abcdefghijklmnopqrstuvwxyz"


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def text_key() -> Column:
    """32 bits that tell rows with one doc_id apart; null texts have a key of their own."""
    return F.hash("text")


def keyed_texts(docs: DataFrame) -> DataFrame:
    """doc_id as long, text_key, text; all other columns are left out."""
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_key().alias("text_key"), "text")


def stored(frame: DataFrame, purpose: str) -> DataFrame:
    """Cut lineage: write to the folder all executors share, and read back."""
    path = scratch_path(frame.sparkSession, purpose)
    frame.write.parquet(path)
    return frame.sparkSession.read.schema(frame.schema).parquet(path)


def unused(frame: DataFrame, name: str) -> str:
    """A column name that the frame does not have, in any spelling."""
    taken = {c.lower() for c in frame.columns}
    while name.lower() in taken:
        name = "_" + name
    return name


def lower_ascii(column: Column) -> Column:
    """A-Z lower-cased, all other letters as they are."""
    return F.translate(column, ASCII_UPPER, ASCII_LOWER)


def octets(batch: pa.RecordBatch, name: str = "text") -> list[bytes]:
    """UTF-8 bytes of each text; null is empty."""
    return [x or b"" for x in batch.column(name).cast(pa.large_binary()).to_pylist()]


def longs(batch: pa.RecordBatch, name: str) -> np.ndarray:
    """A column without nulls as int64."""
    return batch.column(name).to_numpy(zero_copy_only=False).astype(np.int64, copy=False)


def slices(batch: pa.RecordBatch, limit: int = 8 << 20) -> Iterator[pa.RecordBatch]:
    """A batch in pieces of about ``limit`` bytes of text, so that working memory has a bound."""
    if "text" not in batch.schema.names:
        yield batch
        return
    start, size = 0, 0
    lengths = batch.column("text").cast(pa.large_binary())
    for i in range(batch.num_rows):
        value = lengths[i]
        size += value.as_buffer().size if value.is_valid else 0
        if size >= limit:
            yield batch.slice(start, i + 1 - start)
            start, size = i + 1, 0
    if start < batch.num_rows:
        yield batch.slice(start)


def binaries(parts: list[bytes]) -> pa.Array:
    return pa.array(parts, pa.binary())


def split_at(values: np.ndarray) -> np.ndarray:
    """Starts of the runs of equal values (rows, for two dimensions), and the length at the end."""
    if not len(values):
        return np.zeros(1, np.int64)
    new = values[1:] != values[:-1]
    new = new.any(axis=1) if new.ndim > 1 else new
    return np.concatenate(([0], np.flatnonzero(new) + 1, [len(values)]))
