import random
import re

import numpy as np
import pytest
import xxhash
from helpers import by_id, documents

from tidemark.llm import simhash
from tidemark.llm.components import connected


def plain_fingerprint(text):
    low = "".join(c.lower() if c < "\x80" else c for c in text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", low)
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def roots_of(fps, errors):
    """Smallest index of each one's component, over all pairs."""
    words = np.array(fps, np.uint64).reshape(len(fps), -1)
    differ = sum(np.bitwise_count(w[:, None] ^ w[None]).astype(int) for w in words.T)
    near, labels = differ <= errors, np.arange(len(fps))
    while True:
        new = np.where(near, labels[None], len(fps)).min(axis=1)
        if (new == labels).all():
            return labels.tolist()
        labels = new


@pytest.fixture(scope="module")
def texts():
    draw = random.Random(1)
    words = [f"w{i}" for i in range(50)]
    base = draw.choices(words, k=400)
    out = [None, "", " \n", "One", "one", "one two", "ONE TWO", "one two three", "É é x", "tick tock " * 3000]
    for _ in range(60):
        copy = list(base)
        for _ in range(draw.randint(0, 4)):
            copy[draw.randrange(400)] = draw.choice(words)
        out.append(" ".join(copy))
    return out + [" ".join(draw.choices(words, k=draw.randint(1, 40))) for _ in range(60)]


def test_components(spark, texts):
    fps = [plain_fingerprint(t) for t in texts]
    roots = roots_of(fps, 3)
    got = by_id(simhash.components(documents(spark, texts).repartition(3)))
    assert [got[i].fingerprint for i in range(len(texts))] == [f"{x:016x}" for x in fps]
    assert [got[i].component_id for i in range(len(texts))] == roots
    assert 1 < len(set(roots)) < len(set(fps))


def test_hash_is_that_of_spark(spark):
    got = spark.range(1).selectExpr("xxhash64('a b ü')").first()[0]
    assert got & (2**64 - 1) == xxhash.xxh64_intdigest("a b ü".encode(), 42)


def test_codewords():
    golay = simhash.Golay.get()
    words = np.random.default_rng(0).integers(0, 1 << 23, 20_000)
    index, there = golay.indices(words)
    assert set(there.sum(axis=1).tolist()) == {1, 6}
    syndrome = golay.low[words & 0xFFF] ^ golay.high[words >> 12]
    codewords = words[:, None] ^ golay.patterns[syndrome]
    again = golay.low[codewords & 0xFFF] ^ golay.high[codewords >> 12]
    assert not again[there].any()
    distance = np.bitwise_count(words[:, None] ^ codewords)
    assert (distance[:, 0] <= 3).all() and (distance[there] <= 4).all()


def test_up_to_three_errors_always_share_a_key():
    draw = np.random.default_rng(2)
    fps = draw.integers(0, 1 << 64, (3000, 1), np.uint64)
    other = fps.copy()
    for row in range(len(fps)):
        for bit in draw.choice(64, draw.integers(0, 4), replace=False):
            other[row] ^= np.uint64(1) << np.uint64(bit)
    mine, theirs = (set(zip(*map(np.ndarray.tolist, simhash.exact_keys(x)), strict=True)) for x in (fps, other))
    assert {place for place, _ in mine & theirs} == set(range(len(fps)))


@pytest.mark.parametrize("limit", [4, 40, 50_000])
def test_large_buckets_are_split(spark, limit):
    """A family whose members share all keys, next to strangers, whatever a task may hold."""
    draw = np.random.default_rng(4)
    family = [1 << int(b) | 1 << int(c) for b, c in draw.integers(0, 12, (150, 2))]
    fps = sorted({*family, *(int(x) for x in draw.integers(0, 1 << 62, 100)), 7 << 40})
    rows = [(f, f) for f in fps]
    edges = simhash.links(spark.createDataFrame(rows, "node long, f0 long"), simhash.EXACT, limit)
    roots = {r.node: r.root for r in connected(edges).collect()}
    want = roots_of(fps, 3)
    assert {f: roots.get(f, f) for f in fps} == {f: fps[w] for f, w in zip(fps, want, strict=True)}


def test_components_of_edges(spark):
    chain = [(i, i + 1) for i in range(0, 60)]
    hub = [(1000, i) for i in range(1001, 1200)]
    edges = spark.createDataFrame([*chain, *hub, (5, 5), (2001, 2000), (2000, 2001)], "u long, v long")
    roots = {r.node: r.root for r in connected(edges).collect()}
    assert roots == {**dict.fromkeys(range(61), 0), **dict.fromkeys(range(1000, 1200), 1000), 2000: 2000, 2001: 2000}
    assert connected(spark.createDataFrame([], "u long, v long")).collect() == []


def test_one_of_each_component_stays(spark, texts):
    docs = documents(spark, [*texts, texts[12], texts[30]])
    kept = simhash.drop_copies(docs)
    assert kept.schema.names == docs.schema.names
    roots = roots_of([plain_fingerprint(t) for t in texts], 3)
    assert sorted(r.doc_id for r in kept.collect()) == sorted(set(roots))


def test_null_ids_repeated_rows_and_no_rows(spark):
    docs = documents(spark, ["a b c d", "a b c d", "a b c d", "a b c d"], [None, 9, 9, 4])
    rows = simhash.components(docs).collect()
    assert sorted((r.doc_id or -1, r.component_id) for r in rows) == [(-1, 4), (4, 4), (9, 4), (9, 4)]
    assert sorted((r.doc_id or -1) for r in simhash.drop_copies(docs).collect()) == [-1, 4]
    assert simhash.components(documents(spark, [])).count() == 0
    assert simhash.drop_copies(documents(spark, [])).count() == 0
