import random

import pytest
from helpers import documents

from tidemark.llm import decontaminate as d


def semi_global(pattern, text):
    """Distance of the pattern to the nearest substring, and its first end."""
    row = list(range(len(pattern) + 1))
    best = (row[-1], 0)
    for j, c in enumerate(text, 1):
        new = [0]
        for i, p in enumerate(pattern, 1):
            new.append(min(row[i - 1] + (p != c), row[i] + 1, new[i - 1] + 1))
        row = new
        if row[-1] < best[0]:
            best = (row[-1], j)
    return best


def edited(draw, text, edits):
    letters = list(text)
    for _ in range(edits):
        at = draw.randrange(len(letters))
        letters[at : at + draw.randint(0, 1)] = draw.choice(["", "x", "yz"[:1]])
    return "".join(letters)


def test_myers_against_a_table():
    draw = random.Random(0)
    for _ in range(300):
        pattern = "".join(draw.choices("abc", k=draw.randint(1, 80)))
        text = "".join(draw.choices("abc", k=draw.randint(0, 120)))
        limit = draw.randint(0, len(pattern))
        want = semi_global(pattern, text)
        got = d.myers(pattern, text, limit)
        if want[0] > limit or want[1] == 0:
            assert got is None or got[0] == want[0]
        else:
            assert got == want


def items(spark, rows):
    return spark.createDataFrame(rows, "item_id long, text string, extra int")


@pytest.mark.parametrize("block", [d.BLOCK, 300])
def test_against_brute_force(spark, monkeypatch, block):
    monkeypatch.setattr(d, "BLOCK", block)
    draw = random.Random(4)
    word = lambda: "".join(draw.choices("abcdefgh", k=draw.randint(2, 8)))
    prose = lambda n: " ".join(word() for _ in range(n))
    tests = [prose(draw.randint(10, 30)) for _ in range(12)]
    texts = []
    for i in range(60):
        item = draw.choice(tests)
        edits = draw.randint(0, 14)
        middle = edited(draw, item.upper() if i % 7 == 0 else item.replace(" ", "\n", 3), edits)
        texts.append(f"{prose(draw.randint(0, 40))} {middle} {prose(draw.randint(0, 20))}")
    rows = [(i, t, 0) for i, t in enumerate(tests)]
    found = d.find_leaks(documents(spark, texts), items(spark, rows)).collect()
    got = {(r.doc_id, r.item_id): r for r in found}
    assert len(got) == len(found)
    want = {}
    for i, text in enumerate(texts):
        for j, item in enumerate(tests):
            distance, end = semi_global(item, d.comparable(text))
            if distance <= d.budget(len(item)):
                want[i, j] = distance, end
    assert {k: (r.distance, r.end) for k, r in got.items()} == want and len(want) > 20
    for (i, j), r in got.items():
        part = d.comparable(texts[i])[r.begin : r.end]
        assert semi_global(tests[j], part)[0] == r.distance


def test_cleaning(spark):
    item = "the quick brown fox jumps over the lazy dog near the river bank"
    texts = [f"before {item} after", item.upper() * 2, "something else", None, "", item[:30], f"x {item[:-1]}"]
    docs = documents(spark, [*texts, item], [*range(len(texts)), None])
    bench = items(spark, [(1, item, 0), (1, item, 0), (2, None, 0), (3, "", 0)])
    kept = d.clean_documents(docs, bench)
    assert kept.schema.names == docs.schema.names
    assert sorted(r.doc_id for r in kept.collect()) == [2, 3, 4, 5]
    assert d.find_leaks(docs, bench).where("doc_id = 1").count() == 1


def test_empty_tables(spark):
    docs, bench = documents(spark, ["some text"]), items(spark, [(1, "some text", 0)])
    assert d.find_leaks(docs.where("false"), bench).count() == 0
    assert d.find_leaks(docs, bench.where("false")).count() == 0
    assert d.clean_documents(docs, bench.where("false")).count() == 1
    assert d.clean_documents(docs.where("false"), bench).count() == 0


def test_long_text_and_repeated_rows(spark):
    item = "a passage of the benchmark that is long enough"
    text = "filler " * 50_000 + item + " filler" * 10
    rows = d.find_leaks(documents(spark, [text, text], [1, 1]), items(spark, [(1, item, 0)])).collect()
    assert [(r.doc_id, r.begin, r.end) for r in rows] == [(1, 350_000, 350_000 + len(item))]


def test_blank_and_very_short_items(spark):
    texts = ["a cat sat", "concatenate", "cat", "Concatenate a CAT.", "cat5 scat", "\u732b\u306f\u732b", "e\u0301cat", "two  words"]
    bench = items(spark, [(1, " ", 0), (2, "\n\t", 0), (3, "\u2003", 0), (4, "cat", 0), (5, "\u732b", 0), (6, "-", 0)])
    rows = d.find_leaks(documents(spark, texts), bench).collect()
    assert sorted((r.doc_id, r.item_id, r.begin, r.end) for r in rows) == [
        (0, 4, 2, 5), (2, 4, 0, 3), (3, 4, 14, 17), (5, 5, 0, 1)
    ]
    assert sorted(r.doc_id for r in d.clean_documents(documents(spark, texts), bench).collect()) == [1, 4, 6, 7]
    assert d.budget(d.SHORT) == 1 and d.budget(d.SHORT - 1) == 0


def test_items_of_one_text_are_broadcast_once(spark, monkeypatch):
    """A benchmark of which most rows hold one text keeps to the bound of a block, and gives all its ids."""
    monkeypatch.setattr(d, "BLOCK", 200)
    item = "one passage that a third of the benchmark holds"
    other = "another passage that stands there only once"
    rows = [(i, item if i % 2 else f"{item[:3]}\n{item[4:]}".upper(), 0) for i in range(60)] + [(99, other, 0), (None, item, 0)]
    bench = items(spark, rows)
    blocks = list(d._blocks(d._items(bench)))
    assert sum(len(block) for block in blocks) == 2 and all(sum(len(t) for _, t in block) <= 200 for block in blocks)
    found = d.find_leaks(documents(spark, [f"x {item} y", f"{other} {item}", "none"]), bench).collect()
    ids = [None, *range(60)]
    assert {(r.doc_id, r.item_id) for r in found} == {(i, j) for i in (0, 1) for j in ids} | {(1, 99)}
    assert len(found) == 2 * len(ids) + 1
