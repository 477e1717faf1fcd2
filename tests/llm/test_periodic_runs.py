"""Runs against a search of every period, and the digests of the registered query."""

import hashlib
import zlib

import numpy as np
import pytest
from helpers import SMALL, by_id, documents, sha
from hypothesis import given, settings
from hypothesis import strategies as st

from tidemark.llm import periodic_runs
from tidemark.llm.suite import QUERIES, rewritten


def brute(words, exponent=4, least=6):
    """All runs: for each period the widest stretches of words that agree that far apart."""
    found, n = {}, len(words)
    for q in range(1, n // exponent + 1):
        i = 0
        while i + q < n:
            if words[i] != words[i + q]:
                i += 1
                continue
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            if j + q - i >= max(least, exponent * q):
                found.setdefault((i, j + q), q)  # the smallest period comes first
            i = j + 1
    return sorted((a, q, b) for (a, b), q in found.items())


def numbers(words):
    order = {w: i for i, w in enumerate(dict.fromkeys(words))}
    return np.array([order[w] for w in words], np.int64)


def found(words):
    return [tuple(r) for r in periodic_runs.find_runs([numbers(words)])[0].tolist()]


@settings(max_examples=300, deadline=None)
@given(st.lists(st.sampled_from("ab"), max_size=90))
def test_runs_of_two_words(words):
    assert found(words) == brute(words)


@settings(max_examples=200, deadline=None)
@given(
    st.lists(
        st.tuples(st.lists(st.sampled_from("abc"), min_size=1, max_size=9), st.integers(1, 9)), max_size=6
    )
)
def test_planted_powers(parts):
    words = [w for root, times in parts for w in root * times]
    assert found(words) == brute(words)


def test_texts_of_a_slice_do_not_touch():
    texts = [list("abab"), list("abababab"), list("ab"), list("aaaaaa"), [], list("a" * 40), list("xyz" * 30)]
    rows = periodic_runs.find_runs([numbers(t) for t in texts])
    assert [[tuple(x) for x in r.tolist()] for r in rows] == [brute(t) for t in texts]


def test_long_periods():
    root = list(range(5000))
    words = [-1, *root, *root, *root, *root, 3, 1, 4]
    assert found(words) == [(1, 5000, 20001)]


def expected(doc, text):
    words = (text or "").encode().split()
    n, h = len(words), zlib.crc32(str(doc).encode())
    g = h // 10
    if h % 10 == 0 and n:
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
    runs = brute(words)
    gone = {i for a, q, b in runs for i in range(a + q, b)}
    kept = b" ".join(w for i, w in enumerate(words) if i not in gone)
    best = (None,) * 4
    if runs:
        a, q, b = min(runs, key=lambda r: (r[0] - r[2], r[0], r[1]))
        best = (a, b - a, q, 1000 * (b - a) // q)
    lines = "".join(f"{a},{b - a},{q}\n" for a, q, b in runs)
    return (len(runs), *best, sha(lines), hashlib.sha256(kept).hexdigest())


@pytest.fixture(scope="module")
def sample(spark):
    return spark.read.parquet(f"{SMALL}/documents.parquet")


def test_query_against_brute_force(spark, sample):
    got = by_id(QUERIES["op13_periodic_runs"](spark, SMALL))
    texts = {r.doc_id: r.text for r in sample.collect()}
    assert set(got) == set(texts)
    for doc, row in got.items():
        assert tuple(row)[1:] == expected(doc, texts[doc])
    assert sum(r.n_runs > 0 for r in got.values()) > 10


def test_edge_cases(spark):
    texts = [None, "", " \t\n", "a " * 6, "a a a a a", "x b c b c b c b c y", "é é é é é é É", "w " * 30_000 + "end", "w " * 6]
    ids = [1, 2, 3, 4, 5, 6, 7, 8, 4]
    got = periodic_runs.digests(documents(spark, texts, ids)).collect()
    for row, (doc, text) in zip(sorted(got, key=lambda r: (r.doc_id, r.n_runs)), sorted(zip(ids, texts, strict=True), key=lambda x: x[0]), strict=True):
        words = (text or "").split()
        assert row.n_runs == (len(brute(words)) if len(words) < 100 else 1)
    rows = {(r.doc_id, r.start, r.length, r.period) for r in periodic_runs.runs(documents(spark, texts, ids)).collect()}
    assert rows == {(4, 0, 6, 1), (6, 1, 8, 2), (7, 0, 6, 1), (8, 0, 30_000, 1)}
    kept = {r.doc_id: r.text for r in periodic_runs.collapse(documents(spark, texts, ids)).collect()}
    assert kept[6] == "x b c y" and kept[8] == "w end" and kept[1] == "" and kept[5] == "a a a a a"
    assert periodic_runs.digests(documents(spark, [])).count() == 0
    unnamed = periodic_runs.digests(documents(spark, ["a " * 8], [None]), rewritten).first()
    assert unnamed.doc_id is None and unnamed.n_runs == 1


def test_words_behind_a_run_are_kept():
    runs = np.array([(0, 1, 6), (4, 2, 12)])
    assert periodic_runs.collapsed(runs, 14).tolist() == [False] + [True] * 11 + [False, False]
