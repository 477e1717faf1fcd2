"""Alignments against a walk over bytes, and the registered query against brute force over its whole table."""

from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from helpers import SMALL, by_id, documents, sha
from hypothesis import given, settings
from hypothesis import strategies as st
from sentencepiece import SentencePieceProcessor
from tokenizers import Tokenizer

from tidemark.llm import alignment
from tidemark.llm.suite import QUERIES

A, B = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def coders():
    a = Tokenizer.from_file(A)
    a.encode_special_tokens = True
    return a, SentencePieceProcessor(model_file=B)


def tokens(coders, text):
    """(id, bytes) of both sides, each by its own library."""
    a, b = coders
    letters = {v: k for k, v in alignment._byte_letters().items()}
    back = {v: k for k, v in letters.items()}
    left = a.encode(" " + text, add_special_tokens=False)
    left = [(i, bytes(back[c] for c in t)) for i, t in zip(left.ids, left.tokens, strict=True)]
    right = [(i, b.id_to_piece(i)) for i in b.encode(text)]
    right = [(i, bytes([int(p[3:5], 16)]) if b.is_byte(i) else p.replace("▁", " ").encode()) for i, p in right]
    return left, right


def spans(side):
    out, at = [], 0
    for i, t in side:
        out.append((i, at, at + len(t)))
        at += len(t)
    return out


def brute(coders, text):
    """n_a, n_b, groups as text, links as id pairs."""
    if not text:
        return 0, 0, [], []
    left, right = tokens(coders, text)
    whole = (" " + text).encode()
    if b"".join(t for _, t in left) != whole or b"".join(t for _, t in right) != whole:
        return 0, 0, [], []
    left, right = spans(left), spans(right)
    ends = sorted({e for *_, e in left} & {e for *_, e in right})
    groups, start = [], 0
    for end in ends:
        parts = [",".join(str(i) for i, s, e in side if start <= s and e <= end) for side in (left, right)]
        groups.append("|".join(parts))
        start = end
    links, j = [], 0
    for i, s, e in left:
        while j and right[j - 1][2] > s:
            j -= 1
        while j < len(right) and right[j][1] < e:
            if right[j][2] > s:
                links.append((i, right[j][0]))
            j += 1
    return len(left), len(right), groups, links


def expected(coders, texts):
    """Rows by id."""
    found = {doc: brute(coders, text) for doc, text in texts.items()}
    count = Counter(link for *_, links in found.values() for link in links)
    top = {}
    for (_, b), n in count.items():
        top[b] = max(top.get(b, 0), n)
    return {
        doc: (
            n_a, n_b, len(groups), len(links), sum(count[x] == top[x[1]] for x in links), sum(count[x] for x in links),
            sha(";".join(groups)) if groups else "",
        )
        for doc, (n_a, n_b, groups, links) in found.items()
    }


def test_query_against_brute_force(spark, coders):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()}
    short = {d: t for d, t in texts.items() if len(t or "") < 20_000}
    sample = spark.createDataFrame(list(short.items()), "doc_id long, text string")
    got = by_id(alignment.digests(sample, A, B))
    assert {d: tuple(r)[1:] for d, r in got.items()} == expected(coders, short)
    whole = by_id(QUERIES["op11_cross_tokenizer_alignment"](spark, SMALL))
    assert set(whole) == set(texts)
    assert all(whole[d][i] == got[d][i] for d in short for i in ("n_a", "n_b", "n_groups", "n_links", "groups_sha256"))


ODD = [
    None, "", " ", "  two  blanks ", "x", "▁ already a mark", "<|endoftext|> <s></s> <unk> <0x41>", "naïve — 東京タワー 🙂🙃", "\x00\x01 nul",
    "tab\tand\nlines\r\n\n", "a" * 300, "don't we'll they'RE", "é combining", "​﻿", "1234567890 " * 9, "word", "word",
]


def test_edge_cases(spark, coders):
    ids = [*range(len(ODD) - 1), 15]  # a repeated row
    got = alignment.digests(documents(spark, ODD, ids), A, B).collect()
    assert len(got) == len(ODD)
    want = expected(coders, dict(enumerate(ODD)))
    want = {**want, 15: want[15]}
    for row in got:
        assert tuple(row)[1:] == want[row.doc_id]
    assert want[5][0] == 0 and want[7][0] > 0  # a mark in the text does not come back as itself
    assert alignment.digests(documents(spark, []), A, B).count() == 0
    assert alignment.digests(documents(spark, ["a b"], [None]), A, B).first().doc_id is None


@settings(max_examples=150, deadline=None)
@given(st.lists(st.integers(1, 4), min_size=1, max_size=80), st.lists(st.integers(1, 4), min_size=1, max_size=80), st.integers(1, 9))
def test_pieces_of_the_merge(a, b, steps):
    a, b = np.cumsum(a), np.cumsum(b)
    end = max(a[-1], b[-1])
    a, b = (np.append(x, end) if x[-1] < end else x for x in (a, b))
    merged = alignment.Merged(a, b, steps)
    common = np.intersect1d(a, b)
    assert merged.group_a.tolist() == np.searchsorted(common, a).tolist()
    assert merged.group_b.tolist() == np.searchsorted(common, b).tolist()
    begin_a, begin_b = np.concatenate(([0], a[:-1])), np.concatenate(([0], b[:-1]))
    links = {(i, j) for i in range(len(a)) for j in range(len(b)) if begin_a[i] < b[j] and begin_b[j] < a[i]}
    found = list(zip(merged.link_a.tolist(), merged.link_b.tolist(), strict=True))
    assert len(found) == len(links) and set(found) == links


def test_pieces_have_equal_work():
    a, b = np.arange(1, 100_001), np.array([3, 99_000, 100_000])
    i, j = alignment.diagonals(a, b, 64)
    assert set(np.diff(i + j).tolist()) == {64}


def test_long_texts_are_cut_without_a_trace(spark, coders):
    text = " ".join(f"word{i % 97} and the {i} others, don't  you see" for i in range(300))
    a, b = alignment.sides(A, B)
    assert a.cuts and b.cuts and len(alignment.stretches(" " + text, 100)) > 50
    whole, cut = (alignment.Aligned([text.encode()], a, b, n) for n in (1 << 30, 100))
    assert whole.ids_a.tolist() == cut.ids_a.tolist() and whole.ids_b.tolist() == cut.ids_b.tolist()
    assert whole.ids_b.tolist() == coders[1].encode(text)


def test_merges_by_rank_are_those_of_the_library():
    """Every character between letters, digits, blanks and marks: where a text is cut depends on nothing else."""
    coder = alignment.ByteLevel(A)
    assert coder.ranked
    around = ("a{}b 1{}2", " {} !{}?", "{0}{0} x's{0}'ll\n{0}\n ")
    for low in range(0, 0x110000, 1 << 14):
        letters = [chr(c) for c in range(low, low + (1 << 14)) if not 0xD800 <= c < 0xE000]
        texts = ["|".join(t.replace("{0}", c).replace("{}", c) for t in around) for c in letters]
        assert coder.encode(texts) == coder.by_library(texts)


def test_very_long_words_go_through_the_library(monkeypatch):
    coder = alignment.ByteLevel(A)
    texts = [" " + "ab" * 3000, " short one", "x" + " " * 5000 + "y", " " + "é1" * 2000]
    asked = []
    by_library = coder.by_library
    monkeypatch.setattr(coder, "by_library", lambda t: asked.extend(t) or by_library(t))
    assert coder.encode(texts) == by_library(texts) and len(asked) == 3


def test_other_files_go_through_the_library(tmp_path):
    import json

    spec = json.load(open(A))
    spec["model"]["merges"][5], spec["model"]["merges"][900] = spec["model"]["merges"][900], spec["model"]["merges"][5]
    (tmp_path / "odd.json").write_text(json.dumps(spec))
    coder = alignment.ByteLevel(str(tmp_path / "odd.json"))
    assert coder.ranked is None and coder.encode([" some words"]) == coder.by_library([" some words"])


def test_groups_and_counts(spark, coders):
    texts = {1: "tokenization of words", 2: None, 3: "wordless words"}
    rows = alignment.groups(documents(spark, list(texts.values()), list(texts)), A, B).collect()
    for doc, text in texts.items():
        own = sorted((r for r in rows if r.doc_id == doc), key=lambda r: r.group)
        joined = [f"{','.join(map(str, r.a_ids))}|{','.join(map(str, r.b_ids))}" for r in own]
        assert joined == brute(coders, text)[2]
        assert [r.start for r in own] == [0, *[r.end for r in own][:-1]][: len(own)]
        assert not own or own[-1].end == len(text) + 1
    links = Counter(x for t in texts.values() for x in brute(coders, t)[3])
    counted = alignment.pair_counts(documents(spark, list(texts.values()), list(texts)), A, B).collect()
    assert {(r.a_id, r.b_id): r.links for r in counted} == links
