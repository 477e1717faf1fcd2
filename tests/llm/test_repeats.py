"""Repeated bytes (op4) and repeated words (op9) against brute force."""

import random

import numpy as np
import pytest
from helpers import SMALL, by_id, covered, documents, sha, window_counts

from tidemark.llm import occurrences, recompression, suffix_array
from tidemark.llm.common import table


def brute_bytes(texts, length):
    data = [(t or "").encode() for t in texts]
    count, _ = window_counts(enumerate(data), length)
    out = []
    for d in data:
        gone = covered(d, length, lambda w: count[w] > 1)
        spans = sum(g and not before for g, before in zip(gone, [False, *gone], strict=False))
        out.append((len(d), sum(gone), spans, sha(bytes(b for b, g in zip(d, gone, strict=True) if not g))))
    return out


def brute_words(texts, length):
    words = [tuple((t or "").encode().split()) for t in texts]
    _, least = window_counts(enumerate(words), length)
    out = []
    for i, w in enumerate(words):
        gone = covered(w, length, lambda x, i=i: least[x] < i)
        out.append((len(w), sum(gone), sha(b" ".join(x for x, g in zip(w, gone, strict=True) if not g))))
    return out


def check_bytes(spark, texts, parts=5):
    got = by_id(suffix_array.digests(documents(spark, texts).repartition(parts)))
    assert len(got) == len(texts)
    for i, want in enumerate(brute_bytes(texts, 200)):
        assert (got[i].n_bytes, got[i].n_removed, got[i].n_spans, got[i].kept_sha256) == want, i


def check_words(spark, texts, parts=5):
    got = by_id(recompression.digests(documents(spark, texts).repartition(parts)))
    assert len(got) == len(texts)
    for i, want in enumerate(brute_words(texts, 13)):
        assert (got[i].n_words, got[i].n_removed, got[i].kept_sha256) == want, i


@pytest.fixture(scope="module")
def texts():
    """Copies, copies with edits, passages inside others, runs, periods, short and long texts."""
    draw = random.Random(5)
    word = lambda: "".join(draw.choices("abcdeé", k=draw.randint(1, 5)))
    prose = lambda n: " ".join(word() for _ in range(n))
    passage, base = prose(60), prose(300)
    out = [None, "", " ", "short", "a" * 199, "a" * 200, "b" * 201, "b" * 200, "ab" * 300, "ba" * 140, base, base]
    for _ in range(30):
        words = base.split()
        for _ in range(draw.randint(1, 6)):
            words[draw.randrange(len(words))] = word()
        out.append(" ".join(words))
    for _ in range(20):
        at = draw.randint(0, 30)
        out.append(f"{prose(at)} {passage[: draw.randint(150, 400)]} {prose(30)}")
    out += ["w " * 40, "w " * 12, "w " * 13, "x w " * 30, "w x " * 9, prose(2000), "z" * 3000 + base[:500], "q\n" * 500]
    draw.shuffle(out)
    return out


@pytest.fixture(params=[16 << 20, 1500])
def buckets(request, monkeypatch):
    """One bucket for all, and many."""
    monkeypatch.setattr(occurrences, "BUCKET", request.param)


def test_bytes(spark, texts, buckets):
    check_bytes(spark, texts)


def test_words(spark, texts, buckets):
    check_words(spark, texts)


def test_a_passage_in_many_surroundings(spark, buckets):
    """Its parts are shared by all, by some, or by two only, and in differing order of ids."""
    draw = random.Random(6)
    passage = [f"p{i}" for i in range(60)]
    texts = []
    for i in range(120):
        a, b = sorted(draw.sample(range(61), 2))
        body = passage if i % 3 == 0 else passage[a:b] if i % 3 == 1 else passage[i % 7 * 6 :]
        texts.append(" ".join([f"x{draw.randrange(30)}" for _ in range(i % 4)] + body + [f"y{i}-{j}" for j in range(i % 5)]))
    draw.shuffle(texts)
    for parts in (1, 9, 120):
        check_words(spark, texts, parts)
        check_bytes(spark, texts, parts)


def test_a_hot_family_is_spread(spark):
    """One core in very many surroundings: each name of the family goes its own way."""

    def names(rows):
        doc = np.arange(len(rows))
        hi = occurrences.mixed(np.array([row["doc_id"] for row in rows], np.uint64))
        return doc, np.zeros(len(rows), np.int64), np.full(len(rows), 77 << 32, np.uint64), hi, occurrences.mixed(hi)

    frame = spark.range(6000).selectExpr("id doc_id", "0 text_key", "repeat('x', 700) text").repartition(3)
    sent = frame.mapInArrow(occurrences._pack(names, 16, occurrences.EXACT, False, True), occurrences.PACKED)
    entries = {}
    for row in sent.select("kind", "bucket", "counts").collect():
        key = row.kind, row.bucket
        entries[key] = entries.get(key, 0) + sum(np.frombuffer(row.counts, "<i4").tolist())
    by_name = [n for (kind, _), n in entries.items() if kind == occurrences.BY_NAME]
    assert len(by_name) == 16 and max(by_name) < 2 * 6000 / 16
    assert sum(n for (kind, _), n in entries.items() if kind == occurrences.BY_FAMILY) <= 2 * 2 * 3
    found = occurrences.shared_places(frame, names, 16, smaller=False, width=occurrences.EXACT, families=True)
    hits = [h for row in found.collect() for h in occurrences.places(row.hits, occurrences.OPEN).tolist()]
    assert len(hits) == 6000 and set(hits) == {0}


def test_one_slice_and_tiny_slices(spark, texts, monkeypatch):
    check_bytes(spark, texts, 1)
    check_words(spark, texts, 1)
    check_words(spark, texts, 60)


def test_a_passage_twice_in_equal_surroundings_of_one_document(spark):
    """Every place of the passage is looked at, not the first alone, if another slice holds it in other surroundings."""
    spread = lambda c, n: " ".join(f"{c}{i}" for i in range(n))
    passage, around = spread("p", 15), (spread("c", 20), spread("d", 20))
    twice = " ".join([around[0], passage, around[1]] * 2)
    texts = [f"{spread('a', 20)} {passage} {spread('b', 20)}", twice, f"{twice} {spread('e', 9)} {twice}"]
    setting = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(setting)
    spark.conf.set(setting, 1)  # each document is a slice
    try:
        check_words(spark, texts)
    finally:
        spark.conf.set(setting, before)


def test_long_texts_come_in_pieces(texts, monkeypatch):
    """Windows that are handled apart, or with other texts, get the same anchors."""

    def anchors(parts):
        return {
            (int(p.doc[r]), w + int(p.shift[r])): int(p.anchor[r] + p.shift[r])
            for p in parts
            for r in range(len(p.doc))
            for w in range(p.start[r], p.end[r])
        }

    for module, length in ((suffix_array, 200), (recompression, 13)):
        sizes = [len((t or "").encode() if length == 200 else (t or "").encode().split()) for t in texts]
        whole = list(module.parts()(texts))
        monkeypatch.setattr(module, "PART", 150)
        split = list(module.parts()(texts))
        assert len(split) > len(whole) and anchors(split) == anchors(whole)
        assert len(anchors(whole)) == sum(max(0, n - length + 1) for n in sizes)


def test_sample_table(spark):
    rows = sorted((r.doc_id, r.text) for r in table(spark, SMALL, "documents").select("doc_id", "text").collect())
    got = by_id(suffix_array.digests(table(spark, SMALL, "documents")))
    for (i, _), want in zip(rows, brute_bytes([t for _, t in rows], 200), strict=True):
        assert (got[i].n_bytes, got[i].n_removed, got[i].n_spans, got[i].kept_sha256) == want


def test_spans_and_texts(spark):
    a, b = "".join(chr(97 + i * i % 26) + str(i) for i in range(90)), "tail " * 3
    found = by_id(suffix_array.repeated_spans(documents(spark, [a, "xy" + a + b, "z"])))
    assert {i: r.spans for i, r in found.items()} == {0: [[0, len(a)]], 1: [[2, 2 + len(a)]]}
    words = " ".join(f"w{i}" for i in range(15))
    kept = by_id(recompression.drop_repeats(documents(spark, [words, f"own {words} end"])))
    assert {i: r.text for i, r in kept.items()} == {1: "own end"}


def test_null_ids_repeated_rows_and_no_rows(spark):
    text = " ".join(f"word{i}" for i in range(60))
    got = suffix_array.digests(documents(spark, [text, text, text], [None, 3, 3])).collect()
    assert sorted((r.doc_id or -1, r.n_removed) for r in got) == [(-1, 0), (3, len(text)), (3, len(text))]
    got = recompression.digests(documents(spark, [text, text, text, text], [None, 3, 3, 4])).collect()
    assert sorted((r.doc_id or -1, r.n_removed) for r in got) == [(-1, 0), (3, 0), (3, 0), (4, 60)]
    assert suffix_array.digests(documents(spark, [])).count() == 0
    assert recompression.digests(documents(spark, [])).count() == 0
