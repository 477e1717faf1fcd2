"""Remove words of 13-word windows that a document with a smaller id already holds.

Method: recompression. In each of ``LEVELS`` rounds, every maximal run of one symbol becomes a symbol named by
the symbol and its length, then every pair of a left and a right symbol becomes one named by both (a bit of
a symbol's name says which it is). Names are fingerprints, so all tasks give equal strings equal symbols
without asking each other. Each symbol also knows its *reach*: the words that decide how it came about. A
window that holds the whole reach has this symbol, wherever it stands.

The lowest-named of the highest symbols that a window is sure to have is its anchor, and the reach is its
core. Spark then finds shared symbols by sorting their names, and verifies the repeats around them (the
rounds of ``windows``). A window without sure symbols (inside one long run) is anchored at its lowest word.

Null and empty texts have no words. Rows whose ``doc_id`` is null take no part and keep all words. Repeated
rows have one id, so they never remove each other's words. Texts shorter than a window lose nothing. An
empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from xxhash import xxh3_128_digest

from tidemark.llm import windows
from tidemark.llm.common import keyed_texts, octets, slices, split_at
from tidemark.llm.occurrences import Fingerprints, mixed

WINDOW = 13
LEVELS = 2
PART = 1 << 16  # windows handled at once
FAR = 1 << 40


def words_of(text: bytes) -> list[bytes]:
    return text.split()  # ASCII white space


def word_values(words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    both = np.frombuffer(b"".join(map(xxh3_128_digest, words)), "<u8").reshape(-1, 2)
    return both[:, 0].copy(), both[:, 1].copy()


class Symbols:
    """One level: names, and for each symbol the words [low, high) that decide it."""

    def __init__(self, name: np.ndarray, low: np.ndarray, high: np.ndarray):
        self.name, self.low, self.high = name, low, high

    def __len__(self) -> int:
        return len(self.name)

    def _neighbours(self) -> tuple[np.ndarray, np.ndarray]:
        """Reach of the symbol before and behind; beyond the text nothing is known."""
        return np.concatenate(([-FAR], self.low[:-1])), np.concatenate((self.high[1:], [FAR]))

    def runs(self) -> Symbols:
        """A run ends where its neighbours differ, so they belong to its reach."""
        bounds = split_at(self.name)
        first, last, sizes = bounds[:-1], bounds[1:] - 1, np.diff(bounds)
        before, behind = self._neighbours()
        name = np.where(sizes > 1, mixed(self.name[first] ^ mixed(sizes.astype(np.uint64))), self.name[first])
        return Symbols(name, np.minimum(before[first], self.low[first]), np.maximum(behind[last], self.high[last]))

    def pairs(self, level: int) -> Symbols:
        """A pair needs no neighbours; a symbol left alone depends on the one that it did not join."""
        right = (mixed(self.name + np.uint64(level + 1)) & np.uint64(1)).astype(bool)
        joins = np.zeros(len(self), bool)  # with the next one
        joins[:-1] = ~right[:-1] & right[1:]
        joined = np.concatenate(([False], joins[:-1]))
        before, behind = self._neighbours()
        following = np.roll(self.name, -1)
        name = np.where(joins, mixed(self.name * np.uint64(0x9E3779B97F4A7C15) ^ mixed(following)), self.name)
        alone = ~joins
        low = np.where(alone & right, np.minimum(before, self.low), self.low)
        high = np.where(alone & right, self.high, np.maximum(behind, self.high))
        return Symbols(name[~joined], low[~joined], high[~joined])


def levels(values: np.ndarray, count: int = LEVELS) -> list[Symbols]:
    """From words up."""
    at = np.arange(len(values))
    out = [Symbols(values, at, at + 1)]
    for level in range(count):
        out.append(out[-1].runs().pairs(level))
    return out


def _lowest(name: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Place of the lowest name (the leftmost, if equal) in each range; ranges are not empty."""
    bits = np.uint64(int(len(name)).bit_length())
    table = [((mixed(name) >> bits) << bits) | np.arange(len(name), dtype=np.uint64)]
    longest = int((end - start).max())
    while (2 << len(table)) <= 2 * longest and len(table[-1]) > (half := 1 << (len(table) - 1)):
        table.append(np.minimum(table[-1][:-half], table[-1][half:]))
    found = np.zeros(len(start), np.uint64)
    step = np.frexp((end - start).astype(np.float64))[1] - 1
    for k, row in enumerate(table):
        own = step == k
        found[own] = np.minimum(row[start[own]], row[end[own] - (1 << k)])
    return (found & ((np.uint64(1) << bits) - np.uint64(1))).astype(np.int64)


def parts(window: int = WINDOW) -> windows.Parts:
    """Runs of windows by anchoring symbol."""

    def anchors(values: np.ndarray, at: np.ndarray) -> windows.Anchored:
        ladder = levels(values)
        anchor, low, high, tag = (np.zeros(len(at), np.int64) for _ in range(4))
        left = np.arange(len(at))  # windows without an anchor yet
        for level in range(len(ladder) - 1, -1, -1):
            symbols = ladder[level]
            start = np.searchsorted(symbols.low, at[left])
            end = np.searchsorted(symbols.high, at[left] + window, "right")
            sure = end > start
            own = left[sure]
            if len(own):
                best = _lowest(symbols.name, start[sure], end[sure])
                anchor[own], low[own], high[own] = symbols.low[best], symbols.low[best], symbols.high[best]
                tag[own] = best * len(ladder) + level
            left = left[~sure]
            if not len(left):
                break
        return windows.Anchored(anchor, low, high, tag, (tag % len(ladder)).astype(np.uint64))

    def cut(texts: windows.Texts) -> Iterator[windows.Part]:
        words = [words_of((t or "").encode()) for t in texts]
        for group in windows.pieces([len(w) for w in words], window, PART):
            values = word_values([x for i, a, b in group for x in words[i][a:b]])
            yield windows.part_of(group, Fingerprints(values), window, partial(anchors, values[0]))

    return cut


def kept_words(batch: pa.RecordBatch, window: int = WINDOW) -> Iterator[tuple[list[bytes], int]]:
    """Of each document the words that stay, and how many go."""
    for piece in slices(batch):
        rows = piece.to_pylist()
        words = [words_of((r["text"] or "").encode()) for r in rows]
        lost = windows.repeated(rows, parts(window), window, [len(w) for w in words])
        for own, gone in zip(words, lost, strict=True):
            yield [w for w, g in zip(own, gone.tolist(), strict=True) if not g], int(gone.sum())


def _digest(words: list[bytes]) -> str:
    return hashlib.sha256(b" ".join(words)).hexdigest()


def _lost(window: int):
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            done = [(n, _digest(kept)) for kept, n in kept_words(batch, window)]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    batch.column("text_key"),
                    pa.array([x[0] for x in done], pa.int64()),
                    pa.array([x[1] for x in done], pa.string()),
                ],
                names=["doc_id", "text_key", "n_removed", "sha"],
            )

    return rows


def _whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        found = [words_of(t) for t in octets(batch)]
        yield pa.RecordBatch.from_arrays(
            [
                batch.column("doc_id"),
                batch.column("text_key"),
                pa.array([len(w) for w in found], pa.int64()),
                pa.array([_digest(w) for w in found], pa.string()),
            ],
            names=["doc_id", "text_key", "n_words", "whole"],
        )


def digests(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """doc_id, n_words, n_removed and kept_sha256 of each document."""
    lost = windows.find(docs, parts(window), window, smaller=True).mapInArrow(
        _lost(window), "doc_id long, text_key int, n_removed long, sha string"
    )
    whole = keyed_texts(docs).mapInArrow(_whole, "doc_id long, text_key int, n_words long, whole string")
    return whole.join(lost.distinct(), ["doc_id", "text_key"], "left").select(
        "doc_id",
        "n_words",
        F.coalesce("n_removed", F.lit(0).cast("long")).alias("n_removed"),
        F.coalesce("sha", "whole").alias("kept_sha256"),
    )


def drop_repeats(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """doc_id, text_key and the kept text (words joined by one space) of the documents that lose words."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [b" ".join(kept).decode() if n else None for kept, n in kept_words(batch, window)]
            columns = [batch.column("doc_id"), batch.column("text_key"), pa.array(texts, pa.string())]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "text_key", "text"])

    found = windows.find(docs, parts(window), window, smaller=True)
    return found.mapInArrow(rows, "doc_id long, text_key int, text string").where("text is not null").distinct()
