import math
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from helpers import SMALL, by_id, documents

from tidemark.llm import quality
from tidemark.llm.common import table

BIGGER = "/root/testdata/sf0.01"


def held_out(doc_id):
    return zlib.crc32(str(doc_id).encode()) % 5 == 0


def test_held_out_accuracy(spark):
    got = by_id(quality.rated(table(spark, BIGGER, "documents"), table(spark, BIGGER, "labels")))
    assert all(r.held_out == held_out(i) and 0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for i, r in got.items())
    labels = {r.doc_id: r.quality for r in table(spark, BIGGER, "labels").collect()}
    unseen = [(got[i].predicted, y) for i, y in labels.items() if held_out(i)]
    assert len(unseen) > 50 and np.mean([p == y for p, y in unseen]) > 0.95
    assert all(p == 1 for p, y in unseen if y == 1)  # clean documents stay


def plain_statistics(text):
    """What the module's docstring lists, counted one by one."""
    data = (text or "").encode()
    n, seen = max(1, len(data)), Counter(data)
    words, lines = data.split(), [x for x in data.split(b"\n") if x]
    sentences, start = [], 0
    for m in re.finditer(rb"[.!?\n|]+|$", data):
        if m.start() - start > 3:
            sentences.append(data[start : m.start()].strip())
        start = m.end()
    sizes = [len(w) for w in words] or [0]
    kinds, mean = len(set(words)), sum(sizes) / len(sizes)
    out = [math.sqrt(sum(seen[b] for b in members) / n) for members in quality._CLASSES.values()]
    out += [math.log1p(len(data)), math.log1p(len(words)), mean, math.sqrt(sum((x - mean) ** 2 for x in sizes) / len(sizes))]
    out += [kinds / max(1, len(words)), math.log1p(kinds) / math.log1p(max(1, len(words)))]
    out += [len(set(lines)) / max(1, len(lines)), len(set(sentences)) / max(1, len(sentences))]
    out += [math.log1p(len(data) / max(1, len(lines))), math.log1p(max(1, len(words)) / max(1, len(sentences)))]
    out += [sum(w.isupper() for w in words) / max(1, len(words))]
    return [*out, -sum(c / n * math.log(c / n) for c in seen.values())]


def plain_scores(texts, labels):
    """The same model by other means: least squares with a row for each penalty, and the min-max form of isotonic means."""
    stats = {i: np.array(plain_statistics(t)) for i, t in texts.items()}
    learnt = sorted(i for i in labels if i in texts and not held_out(i))
    rows = np.array([stats[i] for i in learnt])
    mean, spread = rows.mean(axis=0), rows.std(axis=0)
    draw = np.random.default_rng(0)
    waves, phases = draw.standard_normal((rows.shape[1], 256)) / 3.0, draw.uniform(0, 2 * np.pi, 256)

    def features(x):
        z = np.clip((x - mean) / np.where(spread > 1e-9, spread, 1.0), -6, 6)
        return np.append(math.sqrt(2 / 256) * np.cos(z @ waves + phases), 1.0)

    x, y = np.array([features(r) for r in rows]), np.array([float(labels[i]) for i in learnt])
    penalty = math.sqrt(1e-3 * len(x) / x.shape[1]) * np.eye(x.shape[1])[:-1]  # the constant is free
    weights = np.linalg.lstsq(np.vstack((x, penalty)), np.append(y, np.zeros(len(penalty))), rcond=None)[0]
    step = np.clip(np.rint((x @ weights + 0.5) * 1000), 0, 2000) / 1000 - 0.5
    knots = sorted(set(step))
    total = np.cumsum([0, *(int((step == k).sum()) for k in knots)])
    good = np.cumsum([0, *(y[step == k].sum() for k in knots)])
    n = len(knots)
    means = np.full((n, n), np.inf)
    for a in range(n):
        means[a, a:] = (good[a + 1 :] - good[a]) / (total[a + 1 :] - total[a])
    least = np.minimum.accumulate(means[:, ::-1], axis=1)[:, ::-1]  # over all ends from b on
    levels = [max(least[a, i] for a in range(i + 1)) for i in range(n)]
    return {i: float(np.interp(features(s) @ weights, knots, levels)) for i, s in stats.items()}


def test_query_against_other_means(spark):
    """Scores end to end; a ridge score at a rounding edge may fall on the next step of the grid."""
    docs, labels = table(spark, SMALL, "documents"), table(spark, SMALL, "labels")
    texts = {r.doc_id: r.text for r in docs.collect()}
    want = plain_scores(texts, {r.doc_id: r.quality for r in labels.collect()})
    got = {i: r.score for i, r in by_id(quality.rated(docs, labels)).items()}
    assert set(got) == set(want)
    differ = [i for i in got if abs(got[i] - want[i]) > 1e-6]
    assert len(differ) <= 2 and all(abs(got[i] - want[i]) < 0.1 for i in differ)


def test_held_out_labels_are_never_read(spark):
    docs, labels = table(spark, SMALL, "documents"), table(spark, SMALL, "labels")
    lied = labels.selectExpr("doc_id", "if(crc32(cast(doc_id as string)) % 5 = 0, 1 - quality, quality) quality")
    first, second = (by_id(quality.rated(docs, x)) for x in (labels, lied))
    assert {i: r.score for i, r in first.items()} == pytest.approx({i: r.score for i, r in second.items()}, abs=1e-6)


def test_sums_do_not_depend_on_the_number_of_partitions(spark):
    draw = np.random.default_rng(0)
    features = quality.FourierMap(np.zeros(quality.N_STATISTICS), np.ones(quality.N_STATISTICS), 8)
    stats = draw.normal(size=(60, quality.N_STATISTICS))
    rows = [(i, x.tolist(), float(i % 2)) for i, x in enumerate(stats)]
    frame = spark.createDataFrame(rows, "doc_id long, stats array<double>, label double")
    x = np.hstack((features(stats), np.arange(60)[:, None] % 2))
    for parts in (1, 3, 40):
        assert np.allclose(quality.normal_equations(frame, features, parts), x.T @ x)


def test_features_approximate_the_kernel():
    draw = np.random.default_rng(1)
    stats = draw.normal(size=(40, quality.N_STATISTICS))
    features = quality.FourierMap(np.zeros(quality.N_STATISTICS), np.ones(quality.N_STATISTICS), 8192, 8.0)
    z = features(stats)[:, :-1]
    kernel = np.exp(-((stats[:, None] - stats[None]) ** 2).sum(axis=2) / (2 * 8.0**2))
    assert np.abs(z @ z.T - kernel).max() < 0.06


def test_isotonic_is_the_best_monotone_fit():
    counts, good = np.array([2, 0, 1, 4, 1, 2.0]), np.array([1, 0, 0, 3, 0, 2.0])
    fitted = quality.isotonic(counts, good)
    assert np.isnan(fitted[1])
    assert fitted[[0, 2, 3, 4, 5]].tolist() == pytest.approx([1 / 3, 1 / 3, 0.6, 0.6, 1.0])


def test_edges(spark):
    docs = documents(spark, [None, "", "word " * 100_000, "a | b | c", "a b", "a b"], [0, 1, 2, 3, 3, None])
    labels = spark.createDataFrame([(0, 1), (1, None), (2, 0), (2, 1), (None, 1), (99, 0)], "doc_id long, quality int")
    rows = quality.rated(docs, labels).collect()
    assert len(rows) == 6 and all(0 <= r.score <= 1 for r in rows)
    no_labels = labels.where("false")
    assert {r.score for r in quality.rated(docs, no_labels).collect()} == {0.5}
    assert quality.good_documents(docs, no_labels).count() == 6
    none = documents(spark, [])
    assert quality.rated(none, labels).count() == 0
    assert quality.good_documents(none, labels).schema.names == none.schema.names
