"""Score documents for quality: ridge regression on random Fourier features, calibrated isotonically.

Method: statistics of each text (letter classes, words, lines, repetition) are standardised and mapped to
random Fourier features, which approximate a Gaussian kernel. Each partition sums its own normal
equations; the sums are added up in a tree, and the ridge system (a few hundred unknowns) is solved on the
driver. Ridge scores of the labelled rows, counted on a fixed grid, are fitted by pool-adjacent-violators
and read with linear interpolation.

What reaches the driver has a fixed size: one row of means, one matrix, one grid. All labelled rows take
part; there is no sample.

Null or empty text has the statistics of no words and is scored like any other. Rows with a null label or
no document are not learnt from; a document labelled more than once counts as good if any label says so;
with no labels at all every score is 0.5. Repeated rows get equal scores. An empty table gives an empty
result. Only ``doc_id`` and ``text`` are read, and only ``text`` enters a score.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import octets, stored

FEATURES = 256
WIDTH = 3.0  # of the Gaussian kernel, in standard deviations
RIDGE = 1e-3  # of the number of rows
GRID = 2000  # steps of a ridge score between -0.5 and 1.5
FAN_IN = 16  # matrices added up in one task
THRESHOLD = 0.3
FOLDS = 5

_CLASSES = {
    "upper": b"ABCDEFGHIJKLMNOPQRSTUVWXYZ",
    "lower": b"abcdefghijklmnopqrstuvwxyz",
    "digit": b"0123456789",
    "space": b" ",
    "newline": b"\n",
    "stop": b".",
    "comma": b",",
    "bang": b"!?",
    "bar": b"|",
    "symbol": b"#$%&*+=@^_~<>{}[]\\/",
    "quote": b"'\"`-:;()",
    "other": bytes(set(range(128)) - set(map(ord, "\n .,!?|#$%&*+=@^_~<>{}[]\\/'\"`-:;()")) - set(b"0123456789") - set(range(65, 91)) - set(range(97, 123))),
    "wide": bytes(range(128, 256)),
}
_CLASS_OF = np.zeros(256, np.int64)
for _i, _members in enumerate(_CLASSES.values()):
    _CLASS_OF[list(_members)] = _i
N_STATISTICS = len(_CLASSES) + 12
_HALF = re.compile(rb"[.!?\n|]+")


def statistics(text: bytes) -> np.ndarray:
    """Shares under a square root, so that small ones still differ, and logarithms of sizes."""
    n = len(text)
    by_byte = np.bincount(np.frombuffer(text, np.uint8), minlength=256)
    shares = np.bincount(_CLASS_OF, weights=by_byte, minlength=len(_CLASSES)) / max(1, n)
    words = text.split()
    lines = [x for x in text.split(b"\n") if x]
    sentences = [x.strip() for x in _HALF.split(text) if len(x) > 3]
    n_words, n_lines, n_sentences = max(1, len(words)), max(1, len(lines)), max(1, len(sentences))
    lengths = np.array([len(w) for w in words] or [0])
    kinds = len(set(words))
    p = by_byte[by_byte > 0] / max(1, n)
    return np.concatenate(
        (
            np.sqrt(shares),
            [
                np.log1p(n),
                np.log1p(len(words)),
                lengths.mean(),
                lengths.std(),
                kinds / n_words,
                np.log1p(kinds) / np.log1p(n_words),
                len(set(lines)) / n_lines,
                len(set(sentences)) / n_sentences,
                np.log1p(n / n_lines),
                np.log1p(n_words / n_sentences),
                sum(w.isupper() for w in words) / n_words,
                float(-(p * np.log(p)).sum()),
            ],
        )
    )


def _statistics_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        found = [statistics(t) for t in octets(batch)]
        flat = np.concatenate(found) if found else np.zeros(0)
        yield pa.RecordBatch.from_arrays(
            [
                batch.column("doc_id"),
                pa.ListArray.from_arrays(pa.array(np.arange(0, len(flat) + 1, N_STATISTICS, dtype=np.int32)), pa.array(flat)),
            ],
            names=["doc_id", "stats"],
        )


def text_statistics(docs: DataFrame) -> DataFrame:
    """doc_id and stats of each row."""
    return docs.selectExpr("cast(doc_id as long) doc_id", "text").mapInArrow(
        _statistics_rows, "doc_id long, stats array<double>"
    )


def _matrix(batch: pa.RecordBatch, name: str = "stats") -> np.ndarray:
    return batch.column(name).flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, -1)


@dataclass(frozen=True)
class FourierMap:
    """Standardised statistics to features whose inner products approximate a Gaussian kernel."""

    mean: np.ndarray
    scale: np.ndarray
    features: int = FEATURES
    width: float = WIDTH

    def __call__(self, stats: np.ndarray) -> np.ndarray:
        draw = np.random.default_rng(0)
        frequencies = draw.standard_normal((len(self.mean), self.features)) / self.width
        phases = draw.uniform(0, 2 * np.pi, self.features)
        z = np.clip((stats - self.mean) / self.scale, -6, 6)
        waves = np.sqrt(2 / self.features) * np.cos(z @ frequencies + phases)
        return np.hstack((waves, np.ones((len(z), 1))))


def _partial_sums(features: FourierMap):
    """One row a partition: the sums of x·x' and x·y, as one matrix."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((features.features + 2, features.features + 2))
        for batch in batches:
            if batch.num_rows:
                x = np.hstack((features(_matrix(batch)), batch.column("label").to_numpy()[:, None]))
                total += x.T @ x
        if total.any():
            yield pa.RecordBatch.from_arrays(
                [pa.array([TaskContext.get().partitionId()]), pa.array([total.tobytes()], pa.binary())],
                names=["part", "sums"],
            )

    return rows


def _add(table: pa.Table) -> pa.Table:
    total = sum(np.frombuffer(x.as_py()) for x in table.column("sums"))
    return pa.table({"part": table.column("part")[:1].cast(pa.int64()), "sums": pa.array([total.tobytes()], pa.binary())})


def normal_equations(labelled: DataFrame, features: FourierMap, parts: int) -> np.ndarray | None:
    """Sums over all labelled rows; no task adds more than FAN_IN matrices."""
    sums = labelled.repartition(parts, "doc_id").mapInArrow(_partial_sums(features), "part long, sums binary")
    while parts > 1:
        sums = sums.groupBy(F.floor(F.col("part") / FAN_IN).alias("g")).applyInArrow(_add, "part long, sums binary")
        sums = sums.withColumn("part", F.floor(F.col("part") / FAN_IN))
        parts = -(-parts // FAN_IN)
    found = sums.collect()  # one row
    return np.frombuffer(found[0].sums).reshape(features.features + 2, -1) if found else None


def solve(sums: np.ndarray) -> np.ndarray:
    gram, target = sums[:-1, :-1], sums[:-1, -1]
    rows = gram[-1, -1]
    penalty = np.eye(len(gram)) * RIDGE * rows / len(gram)
    penalty[-1, -1] = 0  # the constant is free
    return np.linalg.solve(gram + penalty, target)


def isotonic(counts: np.ndarray, good: np.ndarray) -> np.ndarray:
    """Non-decreasing means that fit good/counts best, for each grid step; steps without rows are NaN."""
    blocks: list[list[float]] = []  # mean, weight, steps
    for n, g in zip(counts, good, strict=True):
        if n:
            blocks.append([g / n, n, 1])
            while len(blocks) > 1 and blocks[-2][0] >= blocks[-1][0]:
                m, w, k = blocks.pop()
                blocks[-1] = [(blocks[-1][0] * blocks[-1][1] + m * w) / (blocks[-1][1] + w), blocks[-1][1] + w, blocks[-1][2] + k]
    fitted = np.full(len(counts), np.nan)
    fitted[counts > 0] = np.repeat([b[0] for b in blocks], [b[2] for b in blocks])
    return fitted


@dataclass(frozen=True)
class Model:
    features: FourierMap
    weights: np.ndarray
    knots: np.ndarray
    levels: np.ndarray

    def ridge(self, stats: np.ndarray) -> np.ndarray:
        return self.features(stats) @ self.weights

    def score(self, stats: np.ndarray) -> np.ndarray:
        return np.clip(np.interp(self.ridge(stats), self.knots, self.levels), 0.0, 1.0)


def _step(scores: np.ndarray) -> np.ndarray:
    return np.clip(np.rint((scores + 0.5) / 2 * GRID), 0, GRID).astype(np.int64)


def fit(stats: DataFrame, labels: DataFrame) -> Model:
    """Learn from ``stats`` (text_statistics) and ``labels`` (doc_id, quality)."""
    known = (
        labels.where("quality is not null and doc_id is not null")
        .groupBy(F.col("doc_id").cast("long").alias("doc_id"))
        .agg(F.max("quality").cast("double").alias("label"))
    )
    labelled = stored(stats.join(known, "doc_id").select("doc_id", "stats", "label"), "quality-rows")
    moments = labelled.agg(
        F.array(*(F.avg(F.col("stats")[i]) for i in range(N_STATISTICS))).alias("mean"),
        F.array(*(F.stddev_pop(F.col("stats")[i]) for i in range(N_STATISTICS))).alias("scale"),
        F.count("*").alias("n"),
    ).first()
    if not moments.n:
        features = FourierMap(np.zeros(N_STATISTICS), np.ones(N_STATISTICS))
        return Model(features, np.zeros(FEATURES + 1), np.zeros(1), np.full(1, 0.5))
    scale = np.array(moments.scale)
    features = FourierMap(np.array(moments.mean), np.where(scale > 1e-9, scale, 1.0))
    parts = int(stats.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    weights = solve(normal_equations(labelled, features, parts))
    draft = Model(features, weights, np.zeros(1), np.zeros(1))

    def steps(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros((GRID + 1, 2))
        for batch in batches:
            if batch.num_rows:
                step = _step(draft.ridge(_matrix(batch)))
                counts[:, 0] += np.bincount(step, minlength=GRID + 1)
                counts[:, 1] += np.bincount(step, weights=batch.column("label").to_numpy(), minlength=GRID + 1)
        at = np.flatnonzero(counts[:, 0])
        yield pa.RecordBatch.from_arrays(
            [pa.array(at), pa.array(counts[at, 0]), pa.array(counts[at, 1])], names=["step", "n", "good"]
        )

    grid = np.zeros((GRID + 1, 2))
    counted = labelled.mapInArrow(steps, "step long, n double, good double").groupBy("step")
    for row in counted.agg(F.sum("n").alias("n"), F.sum("good").alias("good")).collect():  # GRID + 1 rows at most
        grid[row.step] = row.n, row.good
    fitted = isotonic(grid[:, 0], grid[:, 1])
    at = np.flatnonzero(~np.isnan(fitted))
    return Model(features, weights, at / GRID * 2 - 0.5, fitted[at])


def score(stats: DataFrame, model: Model) -> DataFrame:
    """doc_id and score of each row of ``text_statistics``."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = model.score(_matrix(batch)) if batch.num_rows else np.zeros(0)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(found)], names=["doc_id", "score"])

    return stats.mapInArrow(rows, "doc_id long, score double")


def held_out():
    return F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % FOLDS == 0, F.lit(False))


def rated(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score and predicted of each document; labels of held-out ones are never read."""
    stats = stored(text_statistics(docs), "quality-stats")
    model = fit(stats, labels.where(~held_out()).select("doc_id", "quality"))
    return score(stats, model).select(
        "doc_id",
        held_out().alias("held_out"),
        "score",
        (F.col("score") >= THRESHOLD).cast("int").alias("predicted"),
    )


def good_documents(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """The documents, all columns, whose score reaches the threshold."""
    model = fit(text_statistics(docs), labels.where(~held_out()).select("doc_id", "quality"))

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                found = model.score(np.array([statistics(t) for t in octets(batch)]))
                yield batch.filter(pa.array(found >= threshold))

    return docs.mapInArrow(rows, docs.schema)
