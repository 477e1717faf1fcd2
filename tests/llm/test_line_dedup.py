import random
import zlib

import numpy as np
from helpers import by_id, documents, sha

from tidemark.llm import line_dedup

WHITE = " \t\n\v\f\r"


def brute(texts):
    """(kept text, lines, dropped) of each document."""
    keys = [
        ["".join(c.lower() if c < "\x80" else c for c in line.strip(WHITE)) for line in (t or "").split("\n")]
        for t in texts
    ]
    holder = {}
    for i, found in enumerate(keys):
        for k in found:
            holder.setdefault(k, i)
    out = []
    for i, t in enumerate(texts):
        lines = (t or "").split("\n")
        kept = [x for x, k in zip(lines, keys[i], strict=True) if len(k) < 10 or holder[k] == i]
        out.append(("\n".join(kept), len(lines), len(lines) - len(kept)))
    return out


def check(spark, texts):
    got = by_id(line_dedup.line_digests(documents(spark, texts)))
    for i, (text, lines, dropped) in enumerate(brute(texts)):
        assert (got[i].n_lines, got[i].n_dropped, got[i].kept_sha256) == (lines, dropped, sha(text)), i
    assert len(got) == len(texts)


def test_edges(spark):
    same = "A line that repeats"
    check(
        spark,
        [
            None,
            "",
            "\n\n",
            f"{same}\nown line here\n{same}",
            f"\t {same.upper()}\v\nshort\nanother own line",
            "short\nshort",
            "ÄÖÜäöüßéèà\nÄÖÜäöüßéèà",
            "äöüäöüßéèà",
            "éééééééééé",
            "éééééééééé\nééééééééé",
            f"{same}\n" * 5000 + "x" * 200_000,
            same,
        ],
    )


def test_random_lines_over_many_partitions(spark):
    draw = random.Random(3)
    pool = [f"line number {i} of the pool" for i in range(60)] + ["hot line of everyone"] * 30
    texts = ["\n".join(draw.choices(pool, k=draw.randint(0, 12))) for _ in range(400)]
    docs = documents(spark, texts).repartition(13)
    got = by_id(line_dedup.line_digests(docs))
    for i, (text, lines, dropped) in enumerate(brute(texts)):
        assert (got[i].n_lines, got[i].n_dropped, got[i].kept_sha256) == (lines, dropped, sha(text))


def test_bitmaps(spark):
    texts = ["the first line\nthe second line", "the second line\nthe third line"]
    rows = by_id(line_dedup.keep_bitmaps(documents(spark, texts)))
    bits = {i: np.unpackbits(np.frombuffer(zlib.decompress(r.keep), np.uint8), count=r.n_lines).tolist() for i, r in rows.items()}
    assert bits == {0: [1, 1], 1: [0, 1]}


def test_texts_keep_all_columns(spark):
    texts = ["a line of some length\nb", "a line of some length\nc", None]
    docs = documents(spark, texts)
    kept = line_dedup.drop_lines(docs)
    assert kept.schema.names == docs.schema.names
    assert {r.doc_id: (r.text, r.id_, r.keep_) for r in kept.collect()} == {
        0: ("a line of some length\nb", "x0", 7),
        1: ("c", "x1", 7),
        2: (None, "x2", 7),
    }


def test_null_ids_repeated_rows_and_no_rows(spark):
    line = "a line that everyone has"
    got = line_dedup.line_digests(documents(spark, [line, line, line, line, line], [None, 4, 4, 5, None])).collect()
    assert sorted((r.doc_id or -1, r.n_dropped) for r in got) == [(-1, 0), (-1, 0), (4, 0), (4, 0), (5, 1)]
    assert line_dedup.line_digests(documents(spark, [])).collect() == []
