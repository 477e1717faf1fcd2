"""Remove every byte that a repeated 200-byte string covers.

Method: this stands in for prefix doubling, which it is not: no rank is made of a pair of ranks, no offset
doubles and nothing is reranked. A name is a polynomial fingerprint of a range of bytes, the same for equal
ranges everywhere, taken from prefix sums in constant time. Spark sorts names, drops those that are unique, and
names the others at another length, in three fixed rounds (``windows``: ranges of 137 bytes, then whole contexts
of up to 263, then single strings of 200). Prefix doubling sorts a row for every position in each of its
rounds: from 8-byte ranks on, pairs at 8, 16, 32, 64 and then 72 bytes, positions dropped as soon as they are
unique, it shuffled 29.6 times the text of 2.5 MB and took 4,500 CPU seconds a GB, several times what this
operator may use. Here all but one position of 64 are left out of the first round.

The first round need not name all positions: of each ``SAMPLE`` consecutive ones it takes the one whose
next ``GRAM`` bytes hash lowest. Equal strings choose the same position inside them, so none is missed.

Null and empty texts have no bytes, and texts shorter than the threshold nothing to remove. Matches never
cross documents. Rows whose ``doc_id`` is null take no part and keep all bytes. Repeated rows are copies
of each other like any others. An empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm import windows
from tidemark.llm.common import keyed_texts, slices
from tidemark.llm.occurrences import Fingerprints, smallest

THRESHOLD = 200
SAMPLE = 64
GRAM = 12
PART = 1 << 18  # windows handled at once

_VALUES = np.random.default_rng(7).integers(0, 1 << 64, (2, 256), np.uint64)


def parts(threshold: int = THRESHOLD, sample: int = SAMPLE, gram: int = GRAM) -> windows.Parts:
    """Runs of windows by sampled position."""
    if not 0 < sample <= threshold - gram + 1:
        raise ValueError("a window must hold whole grams of all its sampled positions")
    core = threshold - sample + 1

    def cut(texts: windows.Texts) -> Iterator[windows.Part]:
        data = [(t or "").encode() for t in texts]
        for group in windows.pieces([len(x) for x in data], threshold, PART):
            joined = np.frombuffer(b"".join([data[i][a:b] for i, a, b in group]), np.uint8)
            prints = Fingerprints((_VALUES[0][joined], _VALUES[1][joined]))
            n = len(joined) - threshold + 1
            at = np.arange(n + sample - 1)
            bits = np.uint64(int(len(at)).bit_length())
            order = prints.half(0, at, at + gram)
            keys = ((order >> bits) << bits) | at.astype(np.uint64)  # the lowest hash, then the leftmost
            anchor_of = (smallest(keys, sample) & ((np.uint64(1) << bits) - np.uint64(1))).astype(np.int64)

            def anchored(first: np.ndarray, anchor_of=anchor_of) -> windows.Anchored:
                anchor = anchor_of[first]
                return windows.Anchored(anchor, anchor, anchor + core, anchor, np.zeros(len(anchor), np.uint64))

            yield windows.part_of(group, prints, threshold, anchored)

    return cut


def removed(batch: pa.RecordBatch, threshold: int = THRESHOLD) -> Iterator[tuple[bytes, np.ndarray]]:
    """Of each document the bytes, and which of them go."""
    for piece in slices(batch):
        rows = piece.to_pylist()
        data = [(r["text"] or "").encode() for r in rows]
        yield from zip(data, windows.repeated(rows, parts(threshold), threshold, [len(x) for x in data]), strict=True)


def spans(gone: np.ndarray) -> np.ndarray:
    """Begins and ends of the maximal removed runs."""
    edges = np.flatnonzero(np.diff(np.concatenate(([0], gone.astype(np.int8), [0]))))
    return edges.reshape(-1, 2)


def _digests(threshold: int):
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            done = []
            for data, gone in removed(batch, threshold):
                kept = np.frombuffer(data, np.uint8)[~gone].tobytes()
                done.append((int(gone.sum()), len(spans(gone)), hashlib.sha256(kept).hexdigest()))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    batch.column("text_key"),
                    pa.array([x[0] for x in done], pa.int64()),
                    pa.array([x[1] for x in done], pa.int64()),
                    pa.array([x[2] for x in done], pa.string()),
                ],
                names=["doc_id", "text_key", "n_removed", "n_spans", "sha"],
            )

    return rows


def repeated_spans(docs: DataFrame, threshold: int = THRESHOLD) -> DataFrame:
    """doc_id, text_key and spans (begin and end in bytes) of the documents that lose something."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [spans(gone).tolist() for _, gone in removed(batch, threshold)]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("text_key"), pa.array(found, pa.list_(pa.list_(pa.int64())))],
                names=["doc_id", "text_key", "spans"],
            )

    found = windows.find(docs, parts(threshold), threshold, smaller=False)
    spanned = found.mapInArrow(rows, "doc_id long, text_key int, spans array<array<long>>")
    return spanned.where("size(spans) > 0").distinct()


def digests(docs: DataFrame, threshold: int = THRESHOLD) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans and kept_sha256 of each document."""
    lost = windows.find(docs, parts(threshold), threshold, smaller=False).mapInArrow(
        _digests(threshold), "doc_id long, text_key int, n_removed long, n_spans long, sha string"
    )
    lost = lost.distinct()  # repeated rows come with equal results
    text = F.coalesce("text", F.lit("")).cast("binary")
    whole = keyed_texts(docs).select(
        "doc_id", "text_key", F.octet_length(text).cast("long").alias("n_bytes"), F.sha2(text, 256).alias("whole")
    )
    return whole.join(lost, ["doc_id", "text_key"], "left").select(
        "doc_id",
        "n_bytes",
        F.coalesce("n_removed", F.lit(0).cast("long")).alias("n_removed"),
        F.coalesce("n_spans", F.lit(0).cast("long")).alias("n_spans"),
        F.coalesce("sha", "whole").alias("kept_sha256"),
    )
