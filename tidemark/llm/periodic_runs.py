"""Runs of words that repeat with a period, and texts with such runs collapsed to their first period.

Method: online square catching over dyadic blocks. A catcher of level k holds one completed block of 2^k words
and waits for the block to come back q words later, for each q from 2^(k+1)-1 to 2^(k+2)-2: a square with
halves that long has a whole aligned block of level k in its left half, so no square escapes. When the block
comes back, suffix comparisons of the words q apart reach out to both sides as long as words agree. What
they cover is the square, and squares with one period that touch are one run.

Words are appended a slice of documents at a time, and all words of a slice advance the catchers of a level
together: one array comparison for each shift. Texts are handled with others of about their length, so short
texts cost no catchers that only long ones need. Blocks are compared by fingerprints; every run is checked word
by word at the end. Time grows with n log n for n words, whatever they are.

Null and empty texts have no words and no runs. Rows are independent: repeated rows give equal results, an
empty table an empty result, a null ``doc_id`` is kept (its text is never rewritten). Other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import octets, slices, split_at
from tidemark.llm.occurrences import Fingerprints, covered, mixed

EXPONENT, LEAST = 4, 6  # periods and words that a run has at least

#: From a document's id and number of words: the place in the text that gives each word, or None for the text itself.
Rewrite = Callable[[int | None, int], np.ndarray | None]

DIGESTS = (
    "doc_id long, n_runs long, start long, length long, period long, exponent_milli long, "
    "runs_sha256 string, collapsed_sha256 string"
)


def words_of(text: bytes) -> list[bytes]:
    return text.split()  # ASCII white space


@lru_cache(maxsize=1 << 16)
def prime_divisors(n: int) -> tuple[int, ...]:
    found, p = [], 2
    while p * p <= n:
        if n % p == 0:
            found.append(p)
            while n % p == 0:
                n //= p
        p += 1
    return (*found, n) if n > 1 else tuple(found)


class Catchers:
    """Catchers over texts put together; a unique word stands between texts, so that nothing crosses it."""

    def __init__(self, words: np.ndarray, longest: int, exponent: int = EXPONENT, least: int = LEAST):
        self.words, self.longest, self.exponent, self.least = words, longest, exponent, least
        seeds = words.astype(np.uint64)
        self.prints = Fingerprints((mixed(seeds), seeds))

    def _same(self, a: np.ndarray, b: np.ndarray, size: np.ndarray) -> np.ndarray:
        return self.prints.half(0, a, a + size) == self.prints.half(0, b, b + size)

    def caught(self, level: int) -> Iterator[tuple[np.ndarray, int]]:
        """For each shift of a level the blocks that come back and open a long enough row of such blocks."""
        block = 1 << level
        at = np.arange(len(self.words) - block + 1)
        seen = self.prints.half(0, at, at + block)
        for q in range(2 * block - 1, min(4 * block - 2, self.longest // self.exponent) + 1):
            waiting, later = seen[::block], seen[q::block]
            back = np.flatnonzero(waiting[: len(later)] == later)
            # A run of that period covers so many blocks in a row at the least.
            row = max(1, ((self.exponent - 1) * q - block + 1) // block)
            if len(back) >= row:
                bounds = np.concatenate(([0], np.flatnonzero(np.diff(back) != 1) + 1, [len(back)]))
                first = back[bounds[:-1][np.diff(bounds) >= row]]
                if len(first):
                    yield first * block, q

    def _reach(self, a: np.ndarray, b: np.ndarray, room: np.ndarray, step: int) -> np.ndarray:
        """How many words agree from ``a`` and ``b`` on (``step`` 1) or before them (-1), at most ``room``."""
        low, high = np.zeros(len(a), np.int64), room.copy()
        while (low < high).any():
            half = (low + high + 1) >> 1
            same = self._same(a, b, half) if step > 0 else self._same(a - half, b - half, half)
            low, high = np.where(same, half, low), np.where(same, high, half - 1)
        return low

    def _squares(self) -> np.ndarray:
        """Rows of (start, period, end): the widest stretch around each caught block."""
        found, level = [], 0
        while self.exponent * ((2 << level) - 1) <= self.longest:
            hits = list(self.caught(level))
            if hits:
                a = np.concatenate([h[0] for h in hits])
                q = np.repeat([h[1] for h in hits], [len(h[0]) for h in hits])
                right = self._reach(a, a + q, len(self.words) - a - q, 1)
                left = self._reach(a, a + q, a, -1)
                found.append(np.stack((a - left, q, a + q + right), axis=1))
            level += 1
        if not found:
            return np.zeros((0, 3), np.int64)
        return np.unique(np.concatenate(found), axis=0)

    def runs(self) -> np.ndarray:
        """Rows of (start, period, end) in order, each with its smallest period and as wide as it gets."""
        rows = self._squares()
        size = rows[:, 2] - rows[:, 0]
        rows = rows[(size >= self.exponent * rows[:, 1]) & (size >= self.least)]
        return rows[[self._smallest(*row) and self._exact(*row) for row in rows.tolist()]] if len(rows) else rows

    def _smallest(self, start: int, period: int, end: int) -> bool:
        """False if a divisor of the period is a period too; others cannot be in so long a run."""
        for p in prime_divisors(period):
            part = np.array([period // p])
            if self._same(np.array([start]), start + part, period - part)[0]:
                return False
        return True

    def _exact(self, start: int, period: int, end: int) -> bool:
        """Word by word; a collision of fingerprints must not pass for a result."""
        if not np.array_equal(self.words[start : end - period], self.words[start + period : end]):
            raise ArithmeticError(f"fingerprints of different words agree at {start}, period {period}")
        return True


def find_runs(texts: list[np.ndarray], exponent: int = EXPONENT, least: int = LEAST) -> list[np.ndarray]:
    """(start, period, end) of all runs of each text; a text is an array of word numbers from 0."""
    out = [np.zeros((0, 3), np.int64)] * len(texts)
    kinds: dict[int, list[int]] = {}
    for i, t in enumerate(texts):
        if len(t) >= max(exponent, least):
            kinds.setdefault(len(t).bit_length(), []).append(i)
    for own in kinds.values():
        sizes = np.array([len(texts[i]) + 1 for i in own])
        base = np.cumsum(sizes) - sizes
        joined = np.concatenate([np.append(texts[i], -1 - k) for k, i in enumerate(own)])
        found = Catchers(joined, int(sizes.max()) - 1, exponent, least).runs()
        of = np.searchsorted(base, found[:, 0], "right") - 1
        bounds = split_at(of)
        for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True):
            out[own[of[a]]] = found[a:b] - base[of[a]] * np.array([1, 0, 1])
    return out


def collapsed(runs: np.ndarray, n: int) -> np.ndarray:
    """Which of n words go: those behind the first period of a run."""
    return covered(runs[:, 0] + runs[:, 1], runs[:, 2], n)


def _documents(batch: pa.RecordBatch, rewrite: Rewrite | None) -> Iterator[tuple[list[bytes], np.ndarray]]:
    """Words and runs of each document."""
    for piece in slices(batch):
        words = [words_of(t) for t in octets(piece)]
        if rewrite:
            for i, doc in enumerate(piece.column("doc_id").to_pylist()):
                source = rewrite(doc, len(words[i])) if words[i] else None
                if source is not None:
                    words[i] = [words[i][j] for j in source.tolist()]
        flat = pa.array([w for own in words for w in own], pa.large_binary()).dictionary_encode()
        numbers = flat.indices.to_numpy(zero_copy_only=False).astype(np.int64)
        texts = np.split(numbers, np.cumsum([len(w) for w in words])[:-1])
        yield from zip(words, find_runs(texts), strict=True)


def _digest(runs: np.ndarray, words: list[bytes]) -> tuple:
    kept = words
    best = (None,) * 4
    lines = ""
    if len(runs):
        gone = collapsed(runs, len(words)).tolist()
        kept = [w for w, g in zip(words, gone, strict=True) if not g]
        rows = [(start, end - start, period) for start, period, end in runs.tolist()]
        start, length, period = min(rows, key=lambda r: (-r[1], r[0], r[2]))
        best = (start, length, period, 1000 * length // period)
        lines = "".join(f"{s},{n},{p}\n" for s, n, p in rows)  # by start, then period, as found
    return (
        len(runs),
        *best,
        hashlib.sha256(lines.encode()).hexdigest(),
        hashlib.sha256(b" ".join(kept)).hexdigest(),
    )


def _digest_rows(rewrite: Rewrite | None):
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            done = [_digest(runs, words) for words, runs in _documents(batch, rewrite)]
            kinds = [pa.int64()] * 5 + [pa.string()] * 2
            columns = [pa.array([r[i] for r in done], kind) for i, kind in enumerate(kinds)]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), *columns], names=[f.split()[0] for f in DIGESTS.split(", ")]
            )

    return rows


def _ids_and_texts(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")


def digests(docs: DataFrame, rewrite: Rewrite | None = None) -> DataFrame:
    """Number of runs, the longest one, and digests of all runs and of the collapsed text of each document."""
    return _ids_and_texts(docs).mapInArrow(_digest_rows(rewrite), DIGESTS)


def runs(docs: DataFrame) -> DataFrame:
    """doc_id, start, length and period of every run."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column("doc_id").to_pylist()
            found = [own for _, own in _documents(batch, None)]
            of = np.repeat(np.arange(len(ids)), [len(f) for f in found])
            start, period, end = np.concatenate([np.zeros((0, 3), np.int64), *found]).T
            columns = [pa.array([ids[i] for i in of.tolist()], pa.int64()), pa.array(start), pa.array(end - start), pa.array(period)]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "start", "length", "period"])

    return _ids_and_texts(docs).mapInArrow(rows, "doc_id long, start long, length long, period long")


def collapse(docs: DataFrame) -> DataFrame:
    """doc_id and the text with every run cut to its first period; words are joined by one space."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = []
            for words, own in _documents(batch, None):
                gone = collapsed(own, len(words)).tolist()
                texts.append(b" ".join(w for w, g in zip(words, gone, strict=True) if not g).decode())
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(texts, pa.large_string())], names=["doc_id", "text"])

    return _ids_and_texts(docs).mapInArrow(rows, "doc_id long, text string")
