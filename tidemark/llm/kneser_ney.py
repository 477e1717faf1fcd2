"""Interpolated modified Kneser-Ney language model: counted in Spark, kept as sorted hash arrays, mapped by workers.

Counting. Words become 64-bit hashes. Each task adds up the grams of its training texts and sends them by gram, so
a frequent word never meets in one task. A bucket adds up what it got and thereby has the final counts of its
grams. For the order below it sends on how many different words stood before each shorter gram (the
continuation count), and what it saw of each gram as a context: the sum of the counts behind it and how
many words follow once, twice, or more often. Texts have order - 1 start marks before them and one end behind,
which is a token.

Storing. A bucket writes its grams as two arrays below the shared folder: hashes in order, and their numbers. Buckets
are as many as the texts have bytes, so a bucket has about the same size in any corpus. Only counts of counts, one
row per bucket, reach the driver; discounts follow from them.

Scoring. Workers map the arrays (they read them where the shared folder is no mounted one). The grams of a stretch
of about ``STRETCH`` tokens are looked up in order of their hashes, one array after the other, so each is read from
front to back and let go. The probability of a word is

    p(w | context) = max(count - discount, 0) / sum + (mass of the discounts / sum) * p(w | shorter context),

ending with the continuation counts of words and, below these, 1 / (words known + 1) for any word. It adds up to one
over the known words and one that stands for all others. A context never seen leaves the shorter one as it is.

Null and empty texts are one end. Repeated rows count each. Without training texts every word has probability 1. A
null ``doc_id`` is kept. Rows are scored one by one, so very long texts make long stretches and nothing else.
"""

from __future__ import annotations

import io
import uuid
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce
from urllib.parse import urlparse

import numpy as np
import pyarrow as pa
import pyarrow.fs
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from xxhash import xxh3_64_intdigest

from tidemark.llm.common import octets, slices, split_at, stored
from tidemark.llm.occurrences import mixed
from tidemark.session import scratch_path

ORDER = 2
BUCKET = 24 << 20  # bytes of text for each bucket of grams
HELD = 1_500_000  # different grams that a task holds before it sends them
STRETCH = 1_000_000  # tokens scored together

# Marks hold a blank, which no word does.
START, END = (np.uint64(xxh3_64_intdigest(m)) for m in (b" start", b" end"))
_STEP = np.uint64(0x9E3779B97F4A7C15)

GRAMS, CONTEXTS, WORDS, TOTALS = range(4)
MESSAGE = "level int, kind int, bucket int, data binary"
SUMS = 5  # of a gram as a context: sum, and followers seen once, twice, three times or more


# --- texts to hashes ------------------------------------------------------------------------------


def tokens(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words of all texts, each text closed by the end, and the number of tokens of each."""
    words = [t.lower().split() for t in texts]  # bytes: A-Z and ASCII white space only
    flat = pa.array([w for own in words for w in own], pa.large_binary()).dictionary_encode()
    known = np.array([xxh3_64_intdigest(w) for w in flat.dictionary.to_pylist()], np.uint64)
    sizes = np.array([len(w) for w in words], np.int64)
    out = np.full(int(sizes.sum()) + len(texts), END, np.uint64)
    inside = np.ones(len(out), bool)
    inside[np.cumsum(sizes + 1) - 1] = False
    if len(known):
        out[inside] = known[flat.indices.to_numpy(zero_copy_only=False)]
    return out, sizes + 1


def histories(words: np.ndarray, sizes: np.ndarray, order: int) -> list[np.ndarray]:
    """For each token the word that stands 0, 1, ... order - 1 places before it; start marks before a text."""
    place = np.arange(len(words)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    out = [words]
    for back in range(1, order):
        earlier = np.full(len(words), START, np.uint64)
        earlier[back:] = np.where(place[back:] >= back, words[:-back], START)
        out.append(earlier)
    return out


def gram_hash(columns: list[np.ndarray]) -> np.ndarray:
    """Of the words from left to right; the hash of a longer gram extends that of its context."""
    return reduce(lambda h, w: mixed(h * _STEP + w), columns[1:], mixed(columns[0]))


def bucket_of(h: np.ndarray, buckets: int) -> np.ndarray:
    """Grows with the hash, so a bucket is a range of hashes."""
    return (((h >> np.uint64(32)) * np.uint64(buckets)) >> np.uint64(32)).astype(np.int64)


# --- packed messages ------------------------------------------------------------------------------


def _narrow(values: np.ndarray) -> np.ndarray:
    return values.astype(np.min_scalar_type(int(values.max()) if len(values) else 0))


def _planes(ascending: np.ndarray) -> np.ndarray:
    """Distances byte by byte, which compresses well."""
    steps = np.diff(ascending, prepend=np.uint64(0)).astype("<u8")
    return np.ascontiguousarray(steps.view(np.uint8).reshape(-1, 8).T)


def _from_planes(planes: np.ndarray) -> np.ndarray:
    return np.cumsum(np.ascontiguousarray(planes.T).view("<u8").ravel(), dtype=np.uint64)


def packed(columns: list[np.ndarray], values: list[np.ndarray]) -> bytes:
    """Rows of hashes with numbers. Several columns share one sorted list of hashes and hold places in it."""
    order = np.lexsort(columns[::-1])
    columns, values = [c[order] for c in columns], [v[order] for v in values]
    if len(columns) == 1:
        arrays = [_planes(columns[0])]
    else:
        known, at = np.unique(np.concatenate(columns), return_inverse=True)
        first, *others = np.split(at, len(columns))
        arrays = [_planes(known), _narrow(np.diff(first, prepend=0)), *map(_narrow, others)]
    out = io.BytesIO()
    for array in [*arrays, *map(_narrow, values)]:
        np.save(out, array, allow_pickle=False)
    return zstandard.compress(out.getvalue(), 1)


def unpacked(data: bytes, width: int, numbers: int) -> list[np.ndarray]:
    """Columns, then numbers."""
    source = io.BytesIO(zstandard.decompress(data))
    known = _from_planes(np.load(source))
    columns = [known]
    if width > 1:
        first = np.cumsum(np.load(source), dtype=np.int64)
        columns = [known[first], *(known[np.load(source)] for _ in range(width - 1))]
    return columns + [np.load(source).astype(np.int64) for _ in range(numbers)]


def _summed(h: np.ndarray, values: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, list[np.ndarray]]:
    """Distinct hashes, a row that holds each, and sums of the numbers."""
    order = np.argsort(h, kind="stable")
    bounds = split_at(h[order])[:-1]
    return h[order[bounds]], order[bounds], [np.add.reduceat(v[order], bounds) if len(bounds) else v for v in values]


def _messages(level: int, kind: int, h: np.ndarray, columns: list, values: list, buckets: int) -> Iterator[tuple]:
    to = bucket_of(h, buckets)
    order = np.argsort(to, kind="stable")
    bounds = split_at(to[order])
    for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True):
        own = order[a:b]
        yield level, kind, int(to[own[0]]), packed([c[own] for c in columns], [v[own] for v in values])


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.int32()] * 3 + [pa.binary()]
    return pa.RecordBatch.from_arrays(
        [pa.array([r[i] for r in rows], k) for i, k in enumerate(kinds)], names=["level", "kind", "bucket", "data"]
    )


# --- counting -------------------------------------------------------------------------------------


def _count(order: int, buckets: int):
    """Grams of the texts of a task, added up before they are sent."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[list[np.ndarray]] = []

        def added() -> list[np.ndarray]:
            h, count, *columns = (np.concatenate(x) for x in zip(*held, strict=True))
            h, row, (count,) = _summed(h, [count])
            return [h, count, *(c[row] for c in columns)]

        for batch in batches:
            for piece in slices(batch):
                columns = histories(*tokens(octets(piece)), order)[::-1]
                h, row, (count,) = _summed(gram_hash(columns), [np.ones(len(columns[0]), np.int64)])
                held.append([h, count, *(c[row] for c in columns)])
                if sum(len(x[0]) for x in held) > HELD:
                    held[:] = [added()]
                    if len(held[0][0]) > HELD // 2:
                        h, count, *columns = held.pop()
                        yield _batch(list(_messages(order, GRAMS, h, columns, [count], buckets)))
        if held:
            h, count, *columns = added()
            yield _batch(list(_messages(order, GRAMS, h, columns, [count], buckets)))

    return rows


def _gathered(rows: list[dict], kind: int, width: int, numbers: int) -> list[np.ndarray]:
    found = [unpacked(r["data"], width, numbers) for r in rows if r["kind"] == kind]
    kinds = [np.uint64] * width + [np.int64] * numbers
    return [np.concatenate([np.zeros(0, k), *(f[i] for f in found)]).astype(k) for i, k in enumerate(kinds)]


def _merge(level: int, order: int, buckets: int, path: str):
    """Final counts of one bucket of a level: written as arrays, and what the level below needs of them."""

    def merge(table: pa.Table) -> pa.Table:
        rows = table.to_pylist()
        bucket = rows[0]["bucket"]
        *columns, count = _gathered(rows, GRAMS, level, 1)
        h, row, (count,) = _summed(gram_hash(columns), [count])
        columns = [c[row] for c in columns]
        out = []
        if level > 1:
            before, size = columns[:-1], [(count == n).astype(np.int64) for n in (1, 2)]
            size = [count, *size, (count > 2).astype(np.int64)]
            key, _, sums = _summed(gram_hash(before), size)
            out += _messages(level - 1, CONTEXTS, key, [key], sums, buckets)
            after = columns[1:]
            key, first, (different,) = _summed(gram_hash(after), [np.ones(len(h), np.int64)])
            out += _messages(level - 1, GRAMS, key, [c[first] for c in after], [different], buckets)
        if level == order:
            word, _, (seen,) = _summed(columns[-1], [count])
            out += _messages(1, WORDS, mixed(word), [word], [seen], buckets)
        totals = [*(int((count == n).sum()) for n in (1, 2, 3, 4)), int(count.sum()), int((count > 2).sum()), 0, 0]
        numbers = [count]
        if level < order:
            keys, *sums = _gathered(rows, CONTEXTS, 1, 4)
            numbers = [count, *(np.zeros(len(h), np.int64) for _ in sums)]
            if level == 1:
                words, seen = _gathered(rows, WORDS, 1, 1)
                keys, sums = np.concatenate((keys, mixed(words))), [np.append(s, np.zeros(len(words), np.int64)) for s in sums]
                sums.append(np.append(np.zeros(len(keys) - len(words), np.int64), seen))
                numbers.append(np.zeros(len(h), np.int64))
                totals[6:] = int(seen.sum()), len(np.unique(words))
            joined = [np.concatenate((numbers[0], np.zeros(len(keys), np.int64)))]
            joined += [np.concatenate((n, s)) for n, s in zip(numbers[1:], sums, strict=True)]
            h, _, numbers = _summed(np.concatenate((h, keys)), joined)
        _write(f"{path}/{level}-{bucket}-hashes.npy", h)
        _write(f"{path}/{level}-{bucket}-numbers.npy", _narrow(np.stack(numbers, axis=1).ravel()).reshape(-1, len(numbers)))
        out.append((level, TOTALS, bucket, np.array(totals, "<i8").tobytes()))
        return pa.Table.from_batches([_batch(out)])

    return merge


# --- arrays in the shared folder ------------------------------------------------------------------


def _write(uri: str, array: np.ndarray) -> None:
    """Whole or not at all, so a task that runs twice does no harm."""
    store, path = pyarrow.fs.FileSystem.from_uri(uri)
    store.create_dir(path.rsplit("/", 1)[0], recursive=True)
    part = f"{path}.{uuid.uuid4().hex}"
    with store.open_output_stream(part) as out:
        np.lib.format.write_array(out, array, allow_pickle=False)
    store.move(part, path)


def _mapped(uri: str) -> np.ndarray:
    place = urlparse(uri)
    if place.scheme in ("", "file"):
        return np.load(place.path, mmap_mode="r")
    store, path = pyarrow.fs.FileSystem.from_uri(uri)
    with store.open_input_file(path) as source:
        return np.load(io.BytesIO(source.read()))


@dataclass(frozen=True)
class Model:
    """Where the arrays are, and the few numbers that hold for all."""

    path: str
    order: int
    buckets: int
    discounts: tuple[tuple[float, float, float], ...]  # by level, for counts of one, two, and more
    totals: tuple[int, int, int, int]  # continuation counts of all words: sum, words with one, two, more
    tokens: int
    words: int

    def numbers(self, level: int, h: np.ndarray) -> np.ndarray:
        """Rows of numbers of ascending hashes; zeros for grams that are not there."""
        width = 1 if level == self.order else SUMS + (level == 1)
        out = np.zeros((len(h), width), np.int64)
        of = bucket_of(h, self.buckets)
        bounds = split_at(of)
        for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True):
            known = _mapped(f"{self.path}/{level}-{of[a]}-hashes.npy")
            if len(known):
                at = np.minimum(np.searchsorted(known, h[a:b]), len(known) - 1)
                hit = np.flatnonzero(known[at] == h[a:b])
                out[a + hit] = _mapped(f"{self.path}/{level}-{of[a]}-numbers.npy")[at[hit]]
        return out

    def discounted(self, level: int, count: np.ndarray) -> np.ndarray:
        return np.maximum(count - np.array((0.0, *self.discounts[level - 1]))[np.minimum(count, 3)], 0.0)

    def mass(self, level: int, once, twice, more):
        """What the discounts of a context's followers leave for the shorter context."""
        d = self.discounts[level - 1]
        return d[0] * once + d[1] * twice + d[2] * more

    def log10s(self, words: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """log10 probability of each token of texts put together, and how often training has it."""
        history = histories(words, sizes, self.order)
        h, at = np.unique(mixed(words), return_inverse=True)
        known = self.numbers(1, h)
        total, *kinds = self.totals
        floor = 1.0 / (self.words + 1)
        if total:
            p = (self.discounted(1, known[:, 0]) + self.mass(1, *kinds) * floor) / total
        else:
            p = np.full(len(h), floor)
        p = p[at]
        for level in range(2, self.order + 1):
            columns = history[:level][::-1]
            h, back = np.unique(gram_hash(columns[:-1]), return_inverse=True)
            _, sums, once, twice, more = self.numbers(level - 1, h)[:, :SUMS].T
            rest = np.where(sums > 0, self.mass(level, once, twice, more) / np.maximum(sums, 1), 1.0)[back]
            sums = np.maximum(sums, 1)[back]
            h, place = np.unique(gram_hash(columns), return_inverse=True)
            p = self.discounted(level, self.numbers(level, h)[:, 0])[place] / sums + rest * p
        return np.log10(p), known[:, -1][at] if self.order > 1 else known[:, 0][at]


def discounts_of(counts: list[int]) -> tuple[float, float, float]:
    """Of counts one, two and more, from how many grams occur 1 to 4 times; fixed ones where these give none."""
    n1, n2, n3, n4 = counts
    if min(counts) > 0:
        y = n1 / (n1 + 2 * n2)
        found = (1 - 2 * y * n2 / n1, 2 - 3 * y * n3 / n2, 3 - 4 * y * n4 / n3)
        if all(0 <= d <= i for i, d in enumerate(found, 1)):
            return found
    return 0.5, 1.0, 1.5


def _added(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Totals of all buckets of a task."""
    total = np.zeros(8, np.int64)
    for batch in batches:
        for data in batch.column("data").to_pylist():
            total += np.frombuffer(data, "<i8")
    yield pa.RecordBatch.from_arrays([pa.array([total.tolist()], pa.list_(pa.int64()))], names=["totals"])


def train(docs: DataFrame, order: int = ORDER) -> Model:
    """Learn from the texts of all rows."""
    if order < 2:
        raise ValueError("a model of contexts has at least order 2")
    spark = docs.sparkSession
    texts = docs.select("text")
    octet_sum = texts.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    buckets = 1 + int(octet_sum) // BUCKET
    path = scratch_path(spark, "language-model")
    sent = texts.mapInArrow(_count(order, buckets), MESSAGE)
    totals, found = [], []
    for level in range(order, 0, -1):
        # A row for each bucket, so that every bucket has its arrays, and a missing one is a failure.
        every = spark.range(buckets).selectExpr(
            f"{level} AS level", f"{TOTALS} AS kind", "CAST(id AS INT) AS bucket", "CAST(NULL AS BINARY) AS data"
        )
        # As many tasks as buckets, so that a task's share does not grow with the corpus.
        grouped = sent.unionAll(every).repartition(buckets, "bucket").groupBy("bucket")
        merged = stored(grouped.applyInArrow(_merge(level, order, buckets, path), MESSAGE), f"grams-{level}")
        found.append(merged)
        own = merged.where(F.col("kind") == TOTALS).select("data").mapInArrow(_added, "totals array<long>").collect()
        totals.insert(0, np.sum([r.totals for r in own], axis=0).tolist())
        if level > 1:
            below = [m.where((F.col("level") == level - 1) & (F.col("kind") != TOTALS)) for m in found]
            sent = reduce(DataFrame.unionAll, below)
    first = totals[0]
    return Model(
        path, order, buckets, tuple(discounts_of(t[:4]) for t in totals),
        (first[4], first[0], first[1], first[5]), first[6], first[7],
    )


# --- scoring --------------------------------------------------------------------------------------

SCORED = "doc_id long, flag boolean, n_tokens long, n_known long, base_score double, score double"


def _score(model: Model):
    def scored(held: list) -> pa.RecordBatch:
        ids, flags = (pa.concat_arrays([h[i] for h in held]) for i in (0, 1))
        words, sizes = (np.concatenate([h[i] for h in held]) for i in (2, 3))
        logs, seen = model.log10s(words, sizes)
        base = np.log10((seen + 1) / (model.tokens + model.words + 1))
        starts = np.cumsum(sizes) - sizes
        sums = [np.add.reduceat(x, starts) for x in ((seen > 0).astype(np.int64), base, logs)]
        return pa.RecordBatch.from_arrays(
            [ids, flags, pa.array(sizes), *map(pa.array, sums)],
            names=[f.split()[0] for f in SCORED.split(", ")],
        )

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in batches:
            for piece in slices(batch):
                held.append((piece.column("doc_id"), piece.column("flag"), *tokens(octets(piece))))
                size += len(held[-1][2])
                if size >= STRETCH:
                    yield scored(held)
                    held, size = [], 0
        if held:
            yield scored(held)

    return rows


def score(docs: DataFrame, model: Model, flag: Column | None = None) -> DataFrame:
    """doc_id, flag (any boolean of the row), n_tokens, n_known, base_score, score and perplexity."""
    flag = F.lit(None) if flag is None else flag
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), flag.cast("boolean").alias("flag"), "text")
    found = texts.mapInArrow(_score(model), SCORED)
    return found.withColumn("perplexity", F.pow(F.lit(10.0), -F.col("score") / F.col("n_tokens")))


def held_out_scores(docs: DataFrame, held_out: Column, order: int = ORDER) -> DataFrame:
    """Scores of all rows by a model of those that are not held out."""
    model = train(docs.where(~held_out), order)
    found = score(docs, model, held_out)
    return found.select(
        "doc_id", F.col("flag").alias("held_out"), "n_tokens", "n_known", F.lit(model.tokens).cast("long").alias("train_tokens"),
        "base_score", "score", "perplexity",
    )
