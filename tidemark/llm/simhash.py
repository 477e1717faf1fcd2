"""SimHash fingerprints, linked at a few differing bits by Golay-code keys, and their components.

Method: 64 bits are four segments of 16. With at most three errors one segment has none; the other 48 bits
are two halves of 24, one of which has at most one error. A key is thus (exact segment, index of a Golay
codeword of the half's first 23 bits). The code is perfect with radius 3: a word at distance 3 from its
codeword has five more at distance 4, any other word has one codeword. As keys serve all codewords within
distance 4, six or one; two words one bit apart always share the codeword nearest to either.
So linked fingerprints share a key; those that share one are verified by counting bits.

* Only distinct fingerprints are keyed: copies never meet in a bucket.
* A bucket gives a spanning forest of its links, never all pairs. A bucket of more than ``BUCKET`` distinct
  fingerprints is split into blocks, and each pair of blocks is a task of its own.
* Components come from stars over tables in the shared folder.

Null texts are empty; a text without words has fingerprint zero, linked like any other. Rows with a null
``doc_id`` link others but have no id to give; a component of nulls only has a null id. Repeated rows get
equal results; an empty table gives an empty result. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass
from itertools import combinations, repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from xxhash import xxh64_intdigest

from tidemark.llm.common import keyed_texts, longs, octets, split_at, stored, unused
from tidemark.llm.components import connected

SHINGLE = 3
SEED = 42
ERRORS = 3  # the key scheme is complete for three
BUCKET = 50_000

# --- fingerprints ---------------------------------------------------------------------------------


def shingle_hashes(text: bytes, shingle: int) -> np.ndarray:
    """Hashes of the shingles of a lower-cased text; fewer words than that are one shingle."""
    words = text.lower().split()
    if len(words) <= shingle:
        words = [b" ".join(words)] if words else []
        return np.array([xxh64_intdigest(w, SEED) for w in words], np.uint64)
    parts = map(b" ".join, zip(*(words[i:] for i in range(shingle)), strict=False))
    return np.fromiter(map(xxh64_intdigest, parts, repeat(SEED)), np.uint64)


def majority(hashes: np.ndarray) -> int:
    """A bit is set if it is in over half of the hashes."""
    ones = np.zeros(64, np.int64)
    for at in range(0, len(hashes), 4096):
        block = hashes[at : at + 4096]
        ones += np.unpackbits(block.astype(">u8").view(np.uint8)).reshape(-1, 64).sum(axis=0, dtype=np.uint16)
    return int.from_bytes(np.packbits(ones * 2 > len(hashes)).tobytes(), "big")


def fingerprint(text: bytes, shingle: int = SHINGLE) -> int:
    return majority(shingle_hashes(text, shingle))


def _fingerprint_rows(shingle: int):
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = np.array([fingerprint(t, shingle) for t in octets(batch)], np.uint64).view(np.int64)
            columns = [*batch.columns[:-1], pa.array(found)]
            yield pa.RecordBatch.from_arrays(columns, names=[*batch.schema.names[:-1], "fp"])

    return rows


def fingerprints(docs: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """doc_id, text_key and fp (the 64 bits as a long)."""
    return keyed_texts(docs).mapInArrow(_fingerprint_rows(shingle), "doc_id long, text_key int, fp long")


# --- Golay keys -----------------------------------------------------------------------------------

WORD, MESSAGE = 23, 12
_GENERATOR = 0b101011100011  # fixed value: x^11+x^9+x^7+x^6+x^5+x+1 divides x^23+1


def _remainders() -> np.ndarray:
    """Syndrome of each single bit: the power of x modulo the generator."""
    out, value = [], 1
    for _ in range(WORD):
        out.append(value)
        value <<= 1
        if value >> 11:
            value ^= _GENERATOR
    return np.array(out, np.int64)


def _error_patterns() -> tuple[np.ndarray, np.ndarray]:
    """For each syndrome the error patterns of at most four bits, first the nearest; and their count."""
    bit = _remainders()
    patterns = np.zeros((2048, 6), np.int64)
    count = np.zeros(2048, np.int64)
    count[0] = 1
    for weight in range(1, 5):
        for places in combinations(range(WORD), weight):
            syndrome = int(np.bitwise_xor.reduce(bit[list(places)]))
            patterns[syndrome, count[syndrome]] = sum(1 << p for p in places)
            count[syndrome] += 1
    return patterns, count


def _syndromes() -> tuple[np.ndarray, np.ndarray]:
    """Of the low 12 and the high 11 bits of a word."""
    bit = _remainders()
    tables = []
    for start, size in ((0, 12), (12, 11)):
        table = np.zeros(1 << size, np.int64)
        for i in range(size):
            table[1 << i : 2 << i] = table[: 1 << i] ^ bit[start + i]
        tables.append(table)
    return tables[0], tables[1]


class Golay:
    """Built once per worker, from the generator."""

    _own = None

    def __init__(self):
        self.patterns, self.count = _error_patterns()
        self.low, self.high = _syndromes()

    @classmethod
    def get(cls) -> Golay:
        cls._own = cls._own or cls()
        return cls._own

    def indices(self, words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(n, 6) indices of codewords within distance four, and which of them are there."""
        syndrome = self.low[words & 0xFFF] ^ self.high[words >> 12]
        codewords = words[:, None] ^ self.patterns[syndrome]
        return codewords >> 11, np.arange(6) < self.count[syndrome][:, None]


@dataclass(frozen=True)
class Scheme:
    """``words`` of 64 bits in a fingerprint, its keys, and the differing bits that still link."""

    words: int
    errors: int
    keys: Callable[[np.ndarray], tuple[np.ndarray, np.ndarray]]

    @property
    def columns(self) -> list[str]:
        return [f"f{i}" for i in range(self.words)]


def exact_keys(fps: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Place of a fingerprint in ``fps`` (n, 1) and one of its keys, for all keys; complete for three errors."""
    golay, places, found = Golay.get(), [], []
    parts = [(fps[:, 0] >> np.uint64(16 * i)).astype(np.int64) & 0xFFFF for i in range(4)]
    for exact in range(4):
        a, b, c = (parts[i] for i in range(4) if i != exact)
        bits = (a << 32) | (b << 16) | c
        for half in range(2):
            index, there = golay.indices((bits >> (25 if half else 1)) & 0x7FFFFF)
            place, which = np.nonzero(there)
            case = exact * 2 + half
            found.append((case << 28) | (parts[exact][place] << 12) | index[place, which])
            places.append(place)
    return np.concatenate(places), np.concatenate(found)


EXACT = Scheme(1, ERRORS, exact_keys)


def _key_rows(scheme: Scheme):
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            nodes = longs(batch, "node")
            every = np.stack([longs(batch, c) for c in scheme.columns], axis=1).view(np.uint64)
            for at in range(0, len(every), 1024):
                fps = every[at : at + 1024]
                place, key = scheme.keys(fps)
                words = fps[place].view(np.int64)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(key), pa.array(nodes[at + place])] + [pa.array(words[:, i]) for i in range(scheme.words)],
                    names=["key", "node", *scheme.columns],
                )

    return rows


# --- buckets --------------------------------------------------------------------------------------


class Forest:
    """Links that join what was apart."""

    def __init__(self, nodes: np.ndarray, fps: np.ndarray, errors: int):
        self.nodes, self.fps, self.errors, self.root = nodes, fps, errors, np.arange(len(fps))
        self.u: list[int] = []
        self.v: list[int] = []

    def _find(self, i: int) -> int:
        root = self.root
        while root[i] != i:
            root[i] = root[root[i]]
            i = root[i]
        return i

    def link(self, left: np.ndarray, right: np.ndarray) -> None:
        differ = np.bitwise_count(self.fps[left, 0] ^ self.fps[right, 0]).astype(np.int64)
        for i in range(1, self.fps.shape[1]):
            differ += np.bitwise_count(self.fps[left, i] ^ self.fps[right, i])
        near = differ <= self.errors
        left, right = left[near], right[near]
        apart = self.root[left] != self.root[right]
        for i, j in zip(left[apart].tolist(), right[apart].tolist(), strict=True):
            a, b = self._find(i), self._find(j)
            if a != b:
                self.root[max(a, b)] = min(a, b)
                self.u.append(i)
                self.v.append(j)
        if apart.any():
            while (self.root[self.root] != self.root).any():
                self.root = self.root[self.root]

    def finish(self, start: int, end: int) -> None:
        """Compare every row outside the largest tree of [start, end) with all rows not in its own."""
        own = self.root[start:end]
        largest = np.bincount(own - own.min()).argmax() + own.min()
        for i in np.flatnonzero(own != largest) + start:
            others = np.flatnonzero(self.root[start:end] != self.root[i]) + start
            self.link(np.full(len(others), i), others)

    def edges(self) -> tuple[np.ndarray, np.ndarray]:
        return self.nodes[self.u], self.nodes[self.v]


LAGS = 16


def _bucket_forest(bounds: np.ndarray, nodes: np.ndarray, fps: np.ndarray, errors: int) -> tuple[np.ndarray, np.ndarray]:
    """Rows of each bucket are compared at growing distance, all buckets at once, then large ones singly.

    After a few distances the members of a family of copies are one tree, and need no more comparisons
    among themselves.
    """
    forest = Forest(nodes, fps, errors)
    sizes = np.diff(bounds)
    after = np.repeat(bounds[1:], sizes) - np.arange(bounds[-1]) - 1  # rows of its bucket behind each row
    left = np.flatnonzero(after)
    for lag in range(1, LAGS + 1):
        if not len(left):
            break
        forest.link(left, left + lag)
        left = left[after[left] > lag]
    for i in np.flatnonzero(sizes > LAGS + 1):
        forest.finish(int(bounds[i]), int(bounds[i + 1]))
    return forest.edges()


def _batch(u: np.ndarray, v: np.ndarray | None, key: np.ndarray | None, fps: np.ndarray) -> pa.RecordBatch:
    n, nothing = len(u), pa.nulls(len(u), pa.int64())
    words = [pa.array(fps[:, i].view(np.int64)) if key is not None else nothing for i in range(fps.shape[1])]
    return pa.RecordBatch.from_arrays(
        [pa.array(u, pa.int64()), nothing if v is None else pa.array(v, pa.int64()), nothing if key is None else pa.array(key), *words],
        names=["u", "v", "key", *(f"f{i}" for i in range(len(words)))],
    )


def _buckets(scheme: Scheme, limit: int):
    """Rows sorted by key. Gives edges, and the rows of buckets above the limit (with their key)."""

    def whole_buckets(rows: np.ndarray) -> Iterator[pa.RecordBatch]:
        bounds = split_at(rows[:, 0])
        sizes = np.diff(bounds)
        if not len(sizes):
            return
        late = np.repeat(sizes > limit, sizes)
        if late.any():
            yield passed_on(rows[late])
            rows = rows[~late]
            bounds = split_at(rows[:, 0])
        if len(rows):
            fps = np.ascontiguousarray(rows[:, 2:]).view(np.uint64)
            yield _batch(*_bucket_forest(bounds, rows[:, 1], fps, scheme.errors), None, fps[:0])

    def passed_on(rows: np.ndarray) -> pa.RecordBatch:
        return _batch(rows[:, 1], None, rows[:, 0], np.ascontiguousarray(rows[:, 2:]).view(np.uint64))

    def buckets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = np.zeros((0, 2 + scheme.words), np.int64)
        large = None  # key of a bucket that is being passed on
        for batch in batches:
            rows = np.concatenate((rows, np.stack([longs(batch, c) for c in ("key", "node", *scheme.columns)], axis=1)))
            if large is not None:
                n = int(np.searchsorted(rows[:, 0], large, "right"))
                yield passed_on(rows[:n])
                rows = rows[n:]
            if not len(rows):
                continue
            large = None
            whole = int(np.searchsorted(rows[:, 0], rows[-1, 0], "left"))  # the last bucket may go on
            yield from whole_buckets(rows[:whole])
            rows = rows[whole:]
            if len(rows) > limit:
                large = rows[-1, 0]
                yield passed_on(rows)
                rows = rows[:0]
        yield from whole_buckets(rows)

    return buckets


def _block_pair(scheme: Scheme):
    """Two blocks of a large bucket (or one with itself)."""

    def compare(table: pa.Table) -> pa.Table:
        nodes, at = np.unique(table.column("u").to_numpy(), return_index=True)
        fps = np.stack([table.column(c).to_numpy() for c in scheme.columns], axis=1)[at].view(np.uint64)
        u, v = _bucket_forest(np.array([0, len(nodes)]), nodes, fps, scheme.errors)
        return pa.table({"u": pa.array(u), "v": pa.array(v)})

    return compare


def _split_large(late: DataFrame, scheme: Scheme, limit: int) -> DataFrame:
    """Edges of large buckets: blocks of about limit / 2 rows, each pair of blocks a group."""
    sizes = late.groupBy("key").agg(F.ceil(F.count("*") * 2 / limit).cast("long").alias("blocks"))
    own = late.join(sizes, "key").withColumn("own", F.pmod(F.xxhash64("u"), F.col("blocks")))
    dealt = own.withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1))).select(
        "key", "u", *scheme.columns, F.least("own", "other").alias("a"), F.greatest("own", "other").alias("b")
    )
    return dealt.groupBy("key", "a", "b").applyInArrow(_block_pair(scheme), "u long, v long")


def links(distinct: DataFrame, scheme: Scheme, limit: int = BUCKET) -> DataFrame:
    """u and v: enough links between the fingerprints (node, f0, f1, ...) to join each component."""
    words = "".join(f", {c} long" for c in scheme.columns)
    keyed = distinct.select("node", *scheme.columns).mapInArrow(_key_rows(scheme), f"key long, node long{words}")
    ordered = keyed.repartition("key").sortWithinPartitions("key", "node")
    found = stored(ordered.mapInArrow(_buckets(scheme, limit), f"u long, v long, key long{words}"), "simhash-links")
    near = found.where("v is not null").select("u", "v")
    late = found.where("key is not null").drop("v")
    if late.isEmpty():
        return near
    return near.unionByName(_split_large(late, scheme, limit))


def near_duplicates(docs: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """doc_id, text_key, fp and component_id of each row."""
    marked = stored(fingerprints(docs, shingle), "simhash")
    distinct = stored(marked.groupBy("fp").agg(F.min("doc_id").alias("least_doc")), "simhash-distinct")
    roots = connected(links(distinct.select(F.col("fp").alias("node"), F.col("fp").alias("f0")), EXACT))
    rooted = distinct.join(roots, distinct["fp"] == roots["node"], "left").select(
        "fp", "least_doc", F.coalesce("root", "fp").alias("root")
    )
    named = rooted.groupBy("root").agg(F.min("least_doc").alias("component_id"))
    by_fp = rooted.join(named, "root").select("fp", "component_id")
    return marked.join(by_fp, "fp")


def components(docs: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """doc_id, fingerprint in hexadecimal digits, and component_id of each row."""
    return near_duplicates(docs, shingle).select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"
    )


# --- one document of each component ---------------------------------------------------------------


def drop_copies(docs: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """The documents, all columns, of which one (the smallest id) stays of each component of linked fingerprints.

    Rows with a null ``doc_id`` stay. Rows that repeat id and text stay or go together.
    """
    own, key = unused(docs, "id_"), unused(docs, "key_")
    later = near_duplicates(docs, shingle).where("doc_id <> component_id")
    lost = later.select(F.col("doc_id").alias(own), F.col("text_key").alias(key)).distinct()
    here = (docs["doc_id"] == lost[own]) & (F.hash(docs["text"]) == lost[key])
    return docs.join(lost, here, "left_anti")
