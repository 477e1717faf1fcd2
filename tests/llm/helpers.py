"""Small tables and brute-force versions that the operators are held against."""

from __future__ import annotations

import hashlib
from collections import defaultdict

DOCS = "doc_id long, text string, lang string, source string, n_chars long, id_ string, keep_ long"

SMALL = "/root/testdata/sf0.001"


def documents(spark, texts, ids=None):
    """A documents table with columns whose names the operators use themselves."""
    ids = range(len(texts)) if ids is None else ids
    rows = [(i, t, "en", None, None if t is None else len(t), f"x{i}", 7) for i, t in zip(ids, texts, strict=True)]
    return spark.createDataFrame(rows, DOCS)


def sha(data) -> str:
    return hashlib.sha256(data.encode() if isinstance(data, str) else data).hexdigest()


def by_id(frame):
    """Rows of a result by doc_id; repeated rows must be equal."""
    out = {}
    for row in frame.collect():
        assert out.setdefault(row.doc_id, row) == row
    return out


def covered(units, length, is_repeated):
    """Which units lie in a window that repeats."""
    gone = [False] * len(units)
    for i in range(len(units) - length + 1):
        if is_repeated(units[i : i + length]):
            gone[i : i + length] = [True] * length
    return gone


def window_counts(sequences, length):
    """How often each window starts, and under which smallest id."""
    count, least = defaultdict(int), {}
    for key, units in sequences:
        for i in range(len(units) - length + 1):
            window = units[i : i + length]
            count[window] += 1
            least[window] = min(least.get(window, key), key)
    return count, least
