"""The model against counts in dictionaries, and the query over its whole table."""

import math
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from helpers import SMALL, by_id, documents
from pyspark.sql import functions as F

from tidemark.llm import kneser_ney
from tidemark.llm.suite import QUERIES


class Brute:
    """Interpolated modified Kneser-Ney as in the textbook, over lists of words."""

    def __init__(self, texts, order):
        self.order = order
        count = Counter()
        self.seen = Counter()
        for words in texts:
            line = ["<s>"] * (order - 1) + words + ["</s>"]
            count.update(tuple(line[i : i + order]) for i in range(len(words) + 1))
            self.seen.update(words + ["</s>"])
        self.counts = {order: count}
        for k in range(order - 1, 0, -1):
            self.counts[k] = Counter(g[1:] for g in self.counts[k + 1])
        self.discounts, self.follow = {}, {}
        for k, own in self.counts.items():
            kinds = Counter(own.values())
            n = [kinds[i] for i in (1, 2, 3, 4)]
            d = (0.5, 1.0, 1.5)
            if min(n):
                y = n[0] / (n[0] + 2 * n[1])
                found = tuple(i - (i + 1) * y * n[i] / n[i - 1] for i in (1, 2, 3))
                d = found if all(0 <= x <= i for i, x in enumerate(found, 1)) else d
            self.discounts[k] = (0.0, *d)
            follow = defaultdict(lambda: [0, 0, 0, 0])
            for g, c in own.items():
                follow[g[:-1]][0] += c
                follow[g[:-1]][min(c, 3)] += 1
            self.follow[k] = follow

    def p(self, gram):
        k = len(gram)
        if k == 0:
            return 1 / (len(self.seen) + 1)
        d = self.discounts[k]
        total, *kinds = self.follow[k].get(gram[:-1], [0, 0, 0, 0])
        if not total:
            return self.p(gram[1:])
        c = self.counts[k][gram]
        mass = sum(x * n for x, n in zip(d[1:], kinds, strict=True))
        return max(c - d[min(c, 3)], 0) / total + mass / total * self.p(gram[1:])

    def score(self, words):
        line = ["<s>"] * (self.order - 1) + words + ["</s>"]
        return sum(math.log10(self.p(tuple(line[i : i + self.order]))) for i in range(len(words) + 1))

    def base(self, words):
        n, v = sum(self.seen.values()), len(self.seen)
        return sum(math.log10((self.seen[w] + 1) / (n + v + 1)) for w in [*words, "</s>"])


def words_of(text):
    return (text or "").encode().lower().decode().split(None) if (text or "").isascii() else [
        w.decode() for w in (text or "").encode().lower().split()
    ]


def close(a, b):
    return math.isclose(a, b, rel_tol=1e-9, abs_tol=1e-9)


TEXTS = [
    "the cat sat on the mat", "The CAT sat on a hat", "a dog sat on the log and the dog sat", "", None, "one", "the the the the",
    "on the mat the cat sat on the mat", "naïve Ünïcode É", "a b c d e f g a b c d a b c a b", "the cat sat on the mat",
]


@pytest.mark.parametrize("order", [2, 3, 4])
def test_scores_against_dictionaries(spark, order, monkeypatch):
    monkeypatch.setattr(kneser_ney, "BUCKET", 60)  # several buckets
    docs = documents(spark, TEXTS)
    learnt = [words_of(t) for i, t in enumerate(TEXTS) if i % 3]
    brute = Brute(learnt, order)
    rows = by_id(kneser_ney.held_out_scores(docs, F.col("doc_id") % 3 == 0, order))
    assert len(rows) == len(TEXTS)
    for i, text in enumerate(TEXTS):
        words = words_of(text)
        row = rows[i]
        assert row.held_out == (i % 3 == 0) and row.n_tokens == len(words) + 1
        assert row.n_known == sum(brute.seen[w] > 0 for w in [*words, "</s>"])
        assert row.train_tokens == sum(brute.seen.values())
        assert close(row.base_score, brute.base(words)) and close(row.score, brute.score(words))
        assert close(row.perplexity, 10 ** (-row.score / row.n_tokens))


@pytest.mark.parametrize("order", [2, 3])
def test_probabilities_add_up_to_one(spark, order):
    texts = [t for t in TEXTS if t]
    model = kneser_ney.train(documents(spark, texts), order)
    known = sorted({w for t in texts for w in words_of(t)})
    for context in (["the"], ["cat", "sat"], ["never", "seen"], []):
        lines = [" ".join([*context, w]).encode() for w in [*known, "zzz"]]
        logs, _ = model.log10s(*kneser_ney.tokens(lines))
        last = np.arange(1, len(lines) + 1) * (len(context) + 2) - 2
        end, _ = model.log10s(*kneser_ney.tokens([" ".join(context).encode()]))
        assert close((10 ** logs[last]).sum() + 10 ** end[-1], 1.0)


def test_query_against_dictionaries(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text").collect()
    held = {r.doc_id: zlib.crc32(str(r.doc_id).encode()) % 7 == 2 for r in docs}
    brute = Brute([words_of(r.text) for r in docs if not held[r.doc_id]], kneser_ney.ORDER)
    rows = by_id(QUERIES["op12_kneser_ney"](spark, SMALL))
    assert set(rows) == set(held)
    for r in docs:
        words, row = words_of(r.text), rows[r.doc_id]
        assert row.held_out == held[r.doc_id]
        assert (row.n_tokens, row.train_tokens) == (len(words) + 1, sum(brute.seen.values()))
        assert row.n_known == sum(brute.seen[w] > 0 for w in [*words, "</s>"])
        assert close(row.base_score, brute.base(words)) and close(row.score, brute.score(words))
    unseen = [r for r in rows.values() if r.held_out]
    assert sum(r.score for r in unseen) > sum(r.base_score for r in unseen)


def test_a_held_out_text_is_better_predicted_in_order(spark):
    model = kneser_ney.train(documents(spark, ["a b c d e f g h"] * 40 + ["h g a d"] * 5))
    rows = by_id(kneser_ney.score(documents(spark, ["a b c d e", "e c a d b"]), model))
    assert rows[0].score > rows[1].score + 3


def test_edge_cases(spark):
    nothing = kneser_ney.held_out_scores(documents(spark, []), F.lit(False))
    assert nothing.count() == 0
    unlearnt = kneser_ney.held_out_scores(documents(spark, ["a b", None]), F.lit(True)).collect()
    assert [(r.score, r.base_score, r.n_known, r.train_tokens) for r in unlearnt] == [(0.0, 0.0, 0, 0)] * 2
    rows = kneser_ney.held_out_scores(documents(spark, ["x y", "x y", "w " * 50_000], [None, None, 3]), F.lit(False)).collect()
    assert len(rows) == 3 and len({r.score for r in rows if r.doc_id is None}) == 1
    with pytest.raises(ValueError):
        kneser_ney.train(documents(spark, ["a"]), 1)


def test_packed_messages():
    rng = np.random.default_rng(3)
    words = rng.integers(0, 1 << 63, 50, dtype=np.uint64) * np.uint64(2)
    columns = [words[rng.integers(0, 50, 400)] for _ in range(3)]
    numbers = rng.integers(1, 70_000, 400)
    back = kneser_ney.unpacked(kneser_ney.packed(columns, [numbers]), 3, 1)
    assert sorted(zip(*(c.tolist() for c in back), strict=True)) == sorted(zip(*(c.tolist() for c in [*columns, numbers]), strict=True))
    one = kneser_ney.unpacked(kneser_ney.packed([words], [np.arange(50)]), 1, 1)
    assert dict(zip(one[0].tolist(), one[1].tolist(), strict=True)) == dict(zip(words.tolist(), range(50), strict=True))


def test_few_held_grams_are_sent_early(spark, monkeypatch):
    monkeypatch.setattr(kneser_ney, "HELD", 5)
    texts = [f"w{i % 13} w{i % 7} w{i % 3}" for i in range(60)]
    row = kneser_ney.score(documents(spark, ["w1 w2 w0"]), kneser_ney.train(documents(spark, texts).repartition(2))).first()
    assert close(row.score, Brute([t.split() for t in texts], 2).score(["w1", "w2", "w0"]))
