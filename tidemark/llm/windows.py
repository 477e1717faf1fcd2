"""Windows of a sequence that repeat, found in three rounds of names that get longer.

Every window is told from its own content which *anchor* inside it stands for it. Windows in a row that
share an anchor form a run. The rounds:

1. The anchor's *core*, a range that every such window holds, is named. If it occurs nowhere else (the fate
   of most), neither does any window of the run.
2. For the rest, the whole range that the run's windows cover is named, in families by core. If that is
   shared, all windows of the run are.
3. Where a family has several names, repeats end inside: the windows of one run of each name, and of all
   runs that share nothing whole, are named one by one.

Each round is exact for what it settles, so the result does not depend on how anchors are chosen.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from typing import NamedTuple

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import keyed_texts, split_at, stored
from tidemark.llm.occurrences import EXACT, FILTER, OPEN, SHARED, Fingerprints, buckets_for, covered, places, shared_places


class Part(NamedTuple):
    """Runs of a few texts, in order of text and place; positions count in the texts put together."""

    prints: Fingerprints
    doc: np.ndarray  # text of each run
    shift: np.ndarray  # from a position here to one in the text
    start: np.ndarray  # windows of each run: first, and last + 1
    end: np.ndarray
    core_start: np.ndarray
    core_end: np.ndarray
    anchor: np.ndarray
    salt: np.ndarray


class Anchored(NamedTuple):
    """What stands for each window: its position, core, and a number that no other anchor has."""

    anchor: np.ndarray
    core_start: np.ndarray
    core_end: np.ndarray
    tag: np.ndarray
    salt: np.ndarray


Texts = list[str | None]
Parts = Callable[[Texts], Iterator[Part]]


def pieces(sizes: list[int], length: int, limit: int) -> Iterator[list[tuple[int, int, int]]]:
    """Groups of (text, begin, end) with about ``limit`` units; long texts come in pieces that overlap by a window."""
    group, units = [], 0
    for doc, n in enumerate(sizes):
        for begin in range(0, n - length + 1, limit):
            end = min(n, begin + limit + length - 1)
            group.append((doc, begin, end))
            units += end - begin
            if units >= limit:
                yield group
                group, units = [], 0
    if group:
        yield group


def part_of(
    group: list[tuple[int, int, int]], prints: Fingerprints, length: int, anchored: Callable[[np.ndarray], Anchored]
) -> Part:
    """Runs of one group; ``anchored`` gets the first units of all windows that lie inside a piece."""
    doc, begin, end = np.array(group).T
    sizes = end - begin
    base = np.cumsum(sizes) - sizes
    windows = sizes - length + 1
    piece = np.repeat(np.arange(len(group)), windows)
    at = np.arange(len(piece)) - (np.cumsum(windows) - windows - base)[piece]
    a = anchored(at)
    bounds = split_at(a.tag)
    head, last = bounds[:-1], bounds[1:] - 1
    return Part(
        prints, doc[piece[head]], (begin - base)[piece[head]], at[head], at[last] + 1,
        a.core_start[head], a.core_end[head], a.anchor[head], a.salt[head],
    )


def _numbered(parts: Iterator[Part], docs: int) -> Iterator[tuple[Part, np.ndarray]]:
    """Each part, and the number of each run in its text."""
    seen = np.zeros(docs, np.int64)
    for p in parts:
        yield p, seen[p.doc] + np.arange(len(p.doc)) - np.searchsorted(p.doc, p.doc)
        seen += np.bincount(p.doc, minlength=docs)


def _selected(rows: list[dict], parts: Parts, column: str, state: int) -> Iterator[tuple[Part, np.ndarray, np.ndarray]]:
    """Each part, its runs that are in a state, and their numbers."""
    chosen = [places(row[column], state) + (i << 32) for i, row in enumerate(rows)]
    chosen = np.concatenate(chosen) if chosen else np.zeros(0, np.int64)
    for p, number in _numbered(parts([row["text"] if row[column] else None for row in rows]), len(rows)):
        runs = np.flatnonzero(np.isin((p.doc << 32) + number, chosen))
        if len(runs):
            yield p, runs, number[runs]


def _joined(found: list[tuple]) -> tuple[np.ndarray, ...]:
    if not found:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), *(np.zeros(0, np.uint64) for _ in range(3))
    return tuple(np.concatenate([f[i] for f in found]) for i in range(5))


def core_names(parts: Parts):
    def names(rows: list[dict]):
        found = []
        for p, number in _numbered(parts([row["text"] for row in rows]), len(rows)):
            core = p.prints.half(0, p.core_start, p.core_end, p.salt)
            found.append((p.doc, number, core, core, np.zeros_like(core)))
        return _joined(found)

    return names


def context_names(parts: Parts, length: int):
    def names(rows: list[dict]):
        found = []
        for p, r, number in _selected(rows, parts, "cores", SHARED):
            core = p.prints.half(0, p.core_start[r], p.core_end[r], p.salt[r])
            salt = p.salt[r] ^ (p.anchor[r] - p.start[r]).astype(np.uint64)
            found.append((p.doc[r], number, core, *p.prints.of(p.start[r], p.end[r] - 1 + length, salt)))
        return _joined(found)

    return names


def window_names(parts: Parts, length: int):
    def names(rows: list[dict]):
        found = []
        for p, r, _ in _selected(rows, parts, "contexts", OPEN):
            sizes = p.end[r] - p.start[r]
            start = np.repeat(p.start[r] - np.cumsum(sizes) + sizes, sizes) + np.arange(sizes.sum())
            hi, lo = p.prints.of(start, start + length)
            found.append((np.repeat(p.doc[r], sizes), start + np.repeat(p.shift[r], sizes), hi, hi, lo))
        return _joined(found)

    return names


def repeated(rows: list[dict], parts: Parts, length: int, sizes: list[int]) -> list[np.ndarray]:
    """For each row (with contexts and windows) which of its units lie in a repeated window."""
    base = np.concatenate(([0], np.cumsum(sizes))).astype(np.int64)
    starts = [places(row["windows"]) + base[i] for i, row in enumerate(rows)]
    ends = [x + length for x in starts]
    for p, r, _ in _selected(rows, parts, "contexts", SHARED):
        home = p.shift[r] + base[p.doc[r]]
        starts.append(p.start[r] + home)
        ends.append(p.end[r] - 1 + length + home)
    gone = covered(np.concatenate(starts), np.concatenate(ends), int(base[-1])) if starts else np.zeros(0, bool)
    return np.split(gone, base[1:-1])


def find(docs: DataFrame, parts: Parts, length: int, *, smaller: bool) -> DataFrame:
    """doc_id, text_key, text, cores, contexts and windows of every document that may lose something.

    A document that only holds counterparts of what others lose is among them.
    """
    own = ["doc_id", "text_key"]
    texts = keyed_texts(docs).where("doc_id is not null")
    buckets = buckets_for(texts)
    cores = shared_places(texts, core_names(parts), buckets, smaller=False, width=FILTER)
    suspects = stored(texts.join(cores.withColumnRenamed("hits", "cores"), own), "suspects")
    contexts = shared_places(
        suspects, context_names(parts, length), buckets, smaller=smaller, width=EXACT, families=True
    )
    contexts = stored(contexts.withColumnRenamed("hits", "contexts"), "contexts")
    halfway = suspects.join(contexts, own, "left")
    windows = shared_places(halfway, window_names(parts, length), buckets, smaller=smaller, width=EXACT)
    windows = stored(windows.withColumnRenamed("hits", "windows"), "windows")
    return halfway.join(windows, own, "left").where(F.col("contexts").isNotNull() | F.col("windows").isNotNull())
