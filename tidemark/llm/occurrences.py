"""Which names of a document occur elsewhere: one Spark round of naming and sorting.

A *name* is a 128-bit fingerprint of something at a position of a document. Each task sends its names by
value, packed: a row holds all names of one slice of documents that fall into one bucket, so a name costs
its bytes and little more. A bucket is sorted in one task, and only positions whose name is shared travel
back to their documents, packed likewise by groups of documents.

Before anything is sent, each slice compares its own names: of those that repeat inside it one travels
(or those of the smallest document, if order matters) and the others are settled on the spot. A name that a third of
all documents hold is thus a few bytes for each slice.

Names may come in families (names of longer ranges around one core). If a family has several names, one place of
each is marked *open*: the next, finer round must look at it, so that what is shared in part only finds
its counterpart. A family never meets in one bucket, however many names it has: names are sent by name, with a
mark if their slice saw others of the family, and a slice sends just the lowest and the highest name of a
family by family, with every place that it sends. A name that no slice marks is alone in each slice that has
it, so all these send it by family, where it meets another slice's lowest or highest one if there are others.

Buckets are as many as the texts have bytes (``BUCKET`` each), so none grows with the corpus.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import binaries, longs, slices, split_at

FILTER, EXACT = 6, 10  # bytes of a name that travel, besides those that the bucket implies
SLICE = 4 << 20
BUCKET = 16 << 20  # bytes of text for each bucket

BY_NAME, BY_FAMILY = 0, 1
PACKED = "kind int, bucket int, names binary, docs binary, keys binary, counts binary, places binary"
FOUND = "part int, docs binary, keys binary, counts binary, places binary"
HITS = "doc_id long, text_key int, hits binary"

#: What is known of a place; hits hold a place times four plus these.
SHARED, OPEN = 1, 2

#: For rows given as dictionaries: the row, place, family and both halves of each name, by row and place.
NamesOf = Callable[[list[dict]], tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]]

# --- fingerprints of any range of a sequence --------------------------------------------------------

_BASES = (0x9E3779B97F4A7C15, 0xD1342543DE82EF95)


class _Powers:
    """Powers of an odd base and of its inverse modulo 2^64."""

    def __init__(self, base: int):
        self.pair = (base, pow(base, -1, 1 << 64))
        self.grown = [np.ones(1, np.uint64), np.ones(1, np.uint64)]

    def upto(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        while len(self.grown[0]) < n:
            for i, g in enumerate(self.grown):
                step = np.uint64(pow(self.pair[i], len(g), 1 << 64))
                self.grown[i] = np.concatenate((g, g * step))
        return self.grown[0][:n], self.grown[1][:n]


_POWERS = [_Powers(b) for b in _BASES]


def mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(29))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(32))


class Fingerprints:
    """Polynomial fingerprints of ranges, in constant time each."""

    def __init__(self, values: tuple[np.ndarray, np.ndarray]):
        n = len(values[0])
        self.sums, self.powers = [], []
        for v, p in zip(values, _POWERS, strict=True):
            up, down = p.upto(n + 1)
            total = np.zeros(n + 1, np.uint64)
            np.cumsum(v * down[:n], out=total[1:])
            self.sums.append(total)
            self.powers.append(up)

    def half(self, which: int, start: np.ndarray, end: np.ndarray, salt=0) -> np.ndarray:
        total = self.sums[which]
        lengths = (end - start).astype(np.uint64) * np.uint64(0xA24BAED4963EE407) + np.uint64(salt)
        return mixed((total[end] - total[start]) * self.powers[which][start] + lengths)

    def of(self, start: np.ndarray, end: np.ndarray, salt=0) -> tuple[np.ndarray, np.ndarray]:
        return self.half(0, start, end, salt), self.half(1, start, end, salt)


def smallest(keys: np.ndarray, width: int) -> np.ndarray:
    """Minimum of each ``width`` consecutive keys."""
    span = 1
    while span * 2 <= width:
        keys = np.minimum(keys[:-span], keys[span:])
        span *= 2
    return np.minimum(keys[: len(keys) - (width - span)], keys[width - span :]) if width > span else keys


# --- the round ------------------------------------------------------------------------------------


def _settled(hi, lo, doc, smaller: bool) -> tuple[np.ndarray, np.ndarray]:
    """Of one slice: names that must travel, and places that are known to be shared already."""
    order = np.argsort(hi, kind="stable")
    bounds = split_at(np.stack((hi[order], lo[order]), axis=1))
    sizes = np.diff(bounds)
    known, travels = np.zeros(len(hi), bool), np.zeros(len(hi), bool)
    if smaller:
        least = np.repeat(np.minimum.reduceat(doc[order], bounds[:-1]), sizes)
        known[order] = doc[order] > least
        return ~known, known
    known[order] = np.repeat(sizes > 1, sizes)
    travels[order[bounds[:-1]]] = True
    return travels, known


def _rows(kind, bucket, names, doc, place, ids, keys) -> tuple:
    """One packed row; entries are sorted by document and place."""
    bounds = split_at(doc)
    of = doc[bounds[:-1]]
    return (
        kind,
        bucket,
        None if names is None else names.tobytes(),
        ids[of].astype("<i8").tobytes(),
        keys[of].astype("<i4").tobytes(),
        np.diff(bounds).astype("<i4").tobytes(),
        zlib.compress(np.diff(place, prepend=0).astype("<i4").tobytes(), 1),
    )


def _octets(values: np.ndarray) -> np.ndarray:
    return values.astype("<u8").view(np.uint8).reshape(-1, 8)


def _bucket_of(h: np.ndarray, buckets: int) -> np.ndarray:
    return (((h >> np.uint64(32)) * np.uint64(buckets)) >> np.uint64(32)).astype(np.int64)


def _kin(family, hi) -> tuple[np.ndarray, np.ndarray]:
    """Which entries of a slice have a family with other names too, and all entries with a family's lowest or highest name."""
    order = np.lexsort((hi, family))
    names = split_at(np.stack((family[order], hi[order]), axis=1))
    first = names[:-1]
    kinds = split_at(family[order][first])  # names of each family
    several = np.zeros(len(family), bool)
    several[order] = np.repeat(np.repeat(np.diff(kinds) > 1, np.diff(kinds)), np.diff(names))
    outer = np.zeros(len(first), bool)
    outer[kinds[:-1]] = outer[kinds[1:] - 1] = True
    return several, np.sort(order[np.repeat(outer, np.diff(names))])


def _pack(names_of: NamesOf, buckets: int, width: int, smaller: bool, families: bool):
    def dealt(kind: int, h, names, doc, place, ids, keys) -> Iterator[tuple]:
        bucket = _bucket_of(h, buckets)
        bucket = bucket.astype(np.uint16) if buckets <= 1 << 16 else bucket
        order = np.argsort(bucket, kind="stable")  # documents and places keep their order
        bounds = split_at(bucket[order])
        for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True):
            own = order[a:b]
            yield _rows(kind, int(bucket[own[0]]), names[own], doc[own], place[own], ids, keys)

    def one(batch: pa.RecordBatch) -> Iterator[tuple]:
        ids, keys = longs(batch, "doc_id"), longs(batch, "text_key")
        doc, place, family, hi, lo = names_of(batch.to_pylist())
        if not len(doc):
            return
        travels, known = _settled(hi, lo, ids[doc] if smaller else doc, smaller)
        if known.any():
            yield _rows(BY_NAME, int(ids[0]) % buckets, None, doc[known], place[known], ids, keys)
        sent = np.flatnonzero(travels)
        family, hi, lo, doc, place = (x[sent] for x in (family, hi, lo, doc, place))
        marked = np.zeros(len(doc), bool)
        if families:
            marked, ends = _kin(family, hi)
            names = np.hstack([_octets(family[ends])[:, :FILTER], _octets(hi[ends])[:, :FILTER]])
            yield from dealt(BY_FAMILY, family[ends], names, doc[ends], place[ends], ids, keys)
        names = np.hstack([_octets(hi), _octets(lo)])[:, :width] if width > 8 else _octets(hi)[:, :width]
        yield from dealt(BY_NAME, hi, names, doc, place * 2 + marked, ids, keys)

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in slices(whole, SLICE):
                done = list(one(batch))
                yield pa.RecordBatch.from_arrays(
                    [pa.array([r[i] for r in done], pa.int32()) for i in (0, 1)] + [binaries([r[i] for r in done]) for i in range(2, 7)],
                    names=["kind", "bucket", "names", "docs", "keys", "counts", "places"],
                )

    return rows


def _chosen(doc, order, bounds, smaller: bool) -> np.ndarray:
    """Of sorted entries those that stand for their name: the first, or all of the smallest document."""
    if smaller:
        own = doc[order]
        return own == np.repeat(np.minimum.reduceat(own, bounds[:-1]), np.diff(bounds))
    chosen = np.zeros(len(order), bool)
    chosen[bounds[:-1]] = True
    return chosen


def _judged(hi, lo, doc, marked, smaller: bool) -> np.ndarray:
    """SHARED and OPEN of each entry of a bucket of names."""
    order = np.lexsort((lo, hi)) if lo.any() else np.argsort(hi, kind="stable")
    bounds = split_at(np.stack((hi[order], lo[order]), axis=1))
    sizes = np.diff(bounds)
    chosen = _chosen(doc, order, bounds, smaller)
    shared = ~chosen if smaller else np.repeat(sizes > 1, sizes)
    kin = np.repeat(np.logical_or.reduceat(marked[order], bounds[:-1]), sizes)
    out = np.zeros(len(order), np.uint8)
    out[order] = shared * np.uint8(SHARED) + (chosen & kin) * np.uint8(OPEN)
    return out


def _opened(family, name, doc, smaller: bool) -> np.ndarray:
    """OPEN of each entry of a bucket of families: one place of each name, if the family has several."""
    order = np.lexsort((name, family))
    bounds = split_at(np.stack((family[order], name[order]), axis=1))
    kinds = split_at(family[order][bounds[:-1]])
    several = np.repeat(np.repeat(np.diff(kinds) > 1, np.diff(kinds)), np.diff(bounds))
    out = np.zeros(len(order), np.uint8)
    out[order] = (_chosen(doc, order, bounds, smaller) & several) * np.uint8(OPEN)
    return out


def _unpacked(table: pa.Table) -> Iterator[tuple]:
    for name, d, k, c, p in zip(
        *(table.column(n).to_pylist() for n in ("names", "docs", "keys", "counts", "places")), strict=True
    ):
        place = np.cumsum(np.frombuffer(zlib.decompress(p), "<i4"), dtype=np.int64)
        yield name, (np.frombuffer(d, "<i8"), np.frombuffer(k, "<i4"), np.frombuffer(c, "<i4"), place)


def _wide(raw: np.ndarray, sizes: tuple[int, int]) -> tuple[np.ndarray, np.ndarray]:
    """Two numbers from the bytes of each name."""
    wide = np.zeros((len(raw), 16), np.uint8)
    wide[:, : sizes[0]] = raw[:, : sizes[0]]
    wide[:, 8 : 8 + sizes[1]] = raw[:, sizes[0] :]
    first, second = np.ascontiguousarray(wide.view("<u8").T)
    return first, second


def _compare(buckets: int, width: int, smaller: bool):
    """Sort one bucket; gives the places whose names others share, packed by groups of documents."""

    def compare(table: pa.Table) -> pa.Table:
        by_family = table.column("kind")[0].as_py() == BY_FAMILY
        out, rows, names = [], [], []
        for name, row in _unpacked(table):
            if name is None:
                out.append((*row[:3], row[3] * 4 + SHARED))
            else:
                rows.append(row)
                names.append(np.frombuffer(name, np.uint8))
        if names:
            ids, keys, counts, place = (np.concatenate([r[i] for r in rows]) for i in range(4))
            raw = np.concatenate(names).reshape(len(place), -1)
            del names, rows
            doc = np.repeat(ids, counts)
            if by_family:
                state = _opened(*_wide(raw, (FILTER, FILTER)), doc, smaller)
            else:
                low = min(width, 8)
                state = _judged(*_wide(raw, (low, width - low)), doc, (place & 1).astype(bool), smaller)
                place = place >> 1
            some = state > 0
            segment = np.repeat(np.arange(len(counts)), counts)
            left = np.bincount(segment[some], minlength=len(counts))
            out.append((ids[left > 0], keys[left > 0], left[left > 0], place[some] * 4 + state[some]))
        if not out:
            return _found([])
        ids, keys, counts, place = (np.concatenate([o[i] for o in out]) for i in range(4))
        part = (mixed(ids.view(np.uint64)) % np.uint64(buckets)).astype(np.int64)
        order = np.argsort(part, kind="stable")
        start = (np.cumsum(counts) - counts)[order]
        ids, keys, counts, part = ids[order], keys[order], counts[order], part[order]
        ends = np.cumsum(counts)
        place = place[np.repeat(start - ends + counts, counts) + np.arange(len(place))]
        bounds, at = split_at(part), np.concatenate(([0], ends))
        return _found(
            [
                (int(part[a]), *(x.tobytes() for x in (ids[a:b].astype("<i8"), keys[a:b].astype("<i4"), counts[a:b].astype("<i4"))), place[at[a] : at[b]].astype("<i4").tobytes())
                for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True)
            ]
        )

    return compare


def _found(rows: list[tuple]) -> pa.Table:
    columns = [pa.array([r[0] for r in rows], pa.int32())] + [binaries([r[i] for r in rows]) for i in range(1, 5)]
    return pa.table(dict(zip(("part", "docs", "keys", "counts", "places"), columns, strict=True)))


def _gather(table: pa.Table) -> pa.Table:
    """All hits of a group of documents, one row for each document."""
    kinds = {"docs": "<i8", "keys": "<i4", "counts": "<i4", "places": "<i4"}
    ids, keys, counts, place = (np.frombuffer(b"".join(table.column(c).to_pylist()), t) for c, t in kinds.items())
    of = np.repeat(np.arange(len(counts)), counts)
    order = np.lexsort((keys, ids))
    rank = np.zeros(len(ids), np.int64)
    bounds = split_at(np.stack((ids[order], keys[order]), axis=1))
    rank[order] = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))
    place = place[np.argsort(rank[of], kind="stable")]
    ends = np.concatenate(([0], np.cumsum(np.bincount(rank[of], minlength=len(bounds) - 1)))).tolist()
    data, first = place.astype("<i4").tobytes(), order[bounds[:-1]]
    parts = [data[4 * a : 4 * b] for a, b in zip(ends, ends[1:], strict=False)]
    return pa.table({"doc_id": pa.array(ids[first]), "text_key": pa.array(keys[first]), "hits": binaries(parts)})


def buckets_for(texts: DataFrame) -> int:
    """So many that each has the names of about ``BUCKET`` bytes of text."""
    return 1 + int(texts.agg(F.sum(F.octet_length("text"))).first()[0] or 0) // BUCKET


def shared_places(
    frame: DataFrame, names_of: NamesOf, buckets: int, *, smaller: bool, width: int, families: bool = False
) -> DataFrame:
    """doc_id, text_key and hits (packed places), for documents that share any name.

    ``smaller``: SHARED means under a smaller ``doc_id``, else at any other place. ``frame`` has doc_id
    (no nulls), text_key, text, and whatever else ``names_of`` reads.
    """
    packed = frame.mapInArrow(_pack(names_of, buckets, width, smaller, families), PACKED)
    found = packed.groupBy("kind", "bucket").applyInArrow(_compare(buckets, width, smaller), FOUND)
    return found.groupBy("part").applyInArrow(_gather, HITS)


def places(hits: bytes | None, state: int = SHARED) -> np.ndarray:
    """Sorted distinct places in a state."""
    found = np.frombuffer(hits or b"", "<i4")
    return np.unique(found[found & state > 0] >> 2).astype(np.int64)


def covered(starts: np.ndarray, ends: np.ndarray, n: int) -> np.ndarray:
    """Which of n units some range covers."""
    depth = np.zeros(n + 1, np.int64)
    np.add.at(depth, starts, 1)
    np.add.at(depth, ends, -1)
    return np.cumsum(depth[:n]) > 0
