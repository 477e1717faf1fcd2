"""Find benchmark items inside documents, up to a number of edits.

Method: an item of m characters may differ by k edits (``ERROR_RATE`` of m). It is cut into k + 1 pieces;
at least one of them stands unchanged in any such passage. An automaton of all pieces finds exact hits in
the whole text of each document, hits that imply overlapping places are merged, and Myers' bit-parallel
distance verifies each place. Documents are not shuffled.

Texts are compared with letters in lower case and any white space as a space. Distances are the smallest
over all places of a document; ties go to the first end. Only the distinct texts of the items go through the
driver, in blocks of about ``BLOCK`` characters (or one text), so that what is broadcast has a bound; each block is one
pass over the documents. Item ids are joined to the hits in Spark.

Null, empty and blank items match nothing. Items shorter than ``SHORT`` characters, which allow no edits, match
whole words only: not where a letter of theirs would stand beside another letter of the document (scripts that put
no spaces between words are exempt). Null and empty documents hold nothing. Repeated rows of either
table give equal rows, which are returned once. An empty table on either side gives an empty result.
"""

from __future__ import annotations

import re
import unicodedata
from collections import defaultdict
from collections.abc import Iterator
from functools import reduce

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from xxhash import xxh3_128_digest

from tidemark.llm.common import stored

ERROR_RATE = 0.06
BLOCK = 4_000_000  # characters of benchmark text in one pass
SHORT = 17  # the fewest characters that allow an edit
LEAKS = "doc_id long, item_id long, distance int, begin int, end int"
HITS = "doc_id long, key binary, distance int, begin int, end int"

_SPACES = dict.fromkeys(map(ord, "\t\n\v\f\r\x85\xa0\u2028\u2029\u3000"), " ")


def comparable(text: str) -> str:
    """Lower case and plain spaces, at unchanged positions."""
    text = text.translate(_SPACES)
    low = text.lower()
    return low if len(low) == len(text) else "".join(c.lower() if len(c.lower()) == 1 else c for c in text)


_UNSPACED = re.compile("[\u0e00-\u0eff\u1000-\u109f\u1780-\u17ff\u3040-\u30ff\u3400-\u9fff\uf900-\ufaff\U00020000-\U0003ffff]")


def _lettered(c: str) -> bool:
    """Letters, marks and digits of scripts that put spaces between words."""
    return unicodedata.category(c)[0] in "LMN" and not _UNSPACED.match(c)


def whole_words(text: str, begin: int, end: int) -> bool:
    """Whether text[begin:end] neither starts nor ends inside a word."""
    inside = [at for at in (begin, end) if 0 < at < len(text) and _lettered(text[at - 1]) and _lettered(text[at])]
    return not inside


def budget(length: int, rate: float = ERROR_RATE) -> int:
    return int(length * rate)


def pieces(item: str, errors: int) -> list[tuple[int, str]]:
    """errors + 1 pieces of nearly equal length, with their offsets."""
    bounds = [i * len(item) // (errors + 1) for i in range(errors + 2)]
    return [(a, item[a:b]) for a, b in zip(bounds, bounds[1:], strict=False)]


def myers(pattern: str, text: str, limit: int) -> tuple[int, int] | None:
    """Smallest distance of the pattern to any substring, and that substring's first end."""
    m = len(pattern)
    masks: dict[str, int] = defaultdict(int)
    for i, c in enumerate(pattern):
        masks[c] |= 1 << i
    full, high = (1 << m) - 1, 1 << (m - 1)
    up, down, distance = full, 0, m
    best = None
    for j, c in enumerate(text):
        equal = masks.get(c, 0)
        vertical = equal | down
        equal |= (((equal & up) + up) ^ up) | equal
        plus = down | (~(equal | up) & full)
        minus = up & equal
        if plus & high:
            distance += 1
        elif minus & high:
            distance -= 1
        plus, minus = (plus << 1) & full, (minus << 1) & full
        up, down = minus | (~(vertical | plus) & full), plus & vertical
        if distance <= limit and (best is None or distance < best[0]):
            best = (distance, j + 1)
            if not distance:
                break
    return best


def place(item: str, text: str, low: int, high: int, errors: int) -> tuple[int, int, int] | None:
    """(distance, begin, end) of the best match inside text[low:high]."""
    found = myers(item, text[low:high], errors)
    if found is None:
        return None
    distance, end = found
    back = text[low : low + end][::-1][: len(item) + distance]
    reached = myers_anchored(item[::-1], back, distance)
    return distance, low + end - reached, low + end


def myers_anchored(pattern: str, text: str, distance: int) -> int:
    """Length of the shortest prefix of ``text`` at the given distance from the whole pattern."""
    width = distance
    row = {j: j for j in range(width + 1)}
    for i, c in enumerate(pattern, 1):
        new = {}
        for j in range(max(0, i - width), min(len(text), i + width) + 1):
            best = i if j == 0 else 1 << 30
            if j and j - 1 in row:
                best = row[j - 1] + (c != text[j - 1])
            if j in row:
                best = min(best, row[j] + 1)
            if j and j - 1 in new:
                best = min(best, new[j - 1] + 1)
            new[j] = best
        row = new
    return min(j for j, d in row.items() if d == distance)


class Matcher:
    """All items of one block, each with what names it."""

    def __init__(self, items: list[tuple[bytes, str]], rate: float):
        self.items = [(i, t, budget(len(t), rate)) for i, t in items]
        found = defaultdict(list)
        for n, (_, text, errors) in enumerate(self.items):
            for offset, piece in pieces(text, errors):
                found[piece].append((n, offset))
        self.automaton = ahocorasick.Automaton()
        for piece, owners in found.items():
            self.automaton.add_word(piece, (len(piece), owners))
        if found:
            self.automaton.make_automaton()

    def leaks(self, raw: str) -> list[tuple[bytes, int, int, int]]:
        """(key, distance, begin, end) of each item that the text holds."""
        if not raw or not self.items:
            return []
        text = comparable(raw)
        starts = defaultdict(set)
        for last, (length, owners) in self.automaton.iter(text):
            for n, offset in owners:
                starts[n].add(last + 1 - length - offset)
        out = []
        for n, at in starts.items():
            key, item, errors = self.items[n]
            if not errors and len(item) < SHORT:
                first = next((x for x in sorted(at) if whole_words(text, x, x + len(item))), None)
                if first is not None:
                    out.append((key, 0, first, first + len(item)))
                continue
            best, low, high = None, None, None
            for start in [*sorted(at), None]:
                a = None if start is None else max(0, start - errors)
                if high is not None and (a is None or a > high):
                    found = place(item, text, low, high, errors)
                    if found and (best is None or (found[0], found[2]) < (best[0], best[2])):
                        best = found
                    low = high = None
                if a is not None:
                    low = a if low is None else low
                    high = min(len(text), start + len(item) + errors)
            if best:
                out.append((key, *best))
        return out


def _comparable_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = [comparable(t or "") for t in batch.column("text").to_pylist()]
        keys = pa.array([xxh3_128_digest(t.encode("utf-8", "surrogatepass")) for t in texts], pa.binary())
        rows = pa.RecordBatch.from_arrays(
            [batch.column("item_id"), keys, pa.array(texts, pa.string())], names=["item_id", "key", "text"]
        )
        yield rows.filter(pa.array([bool(t.strip()) for t in texts], pa.bool_()))


def _items(benchmark: DataFrame) -> DataFrame:
    """item_id, key and comparable text of each item that is not blank; equal texts have one key."""
    rows = benchmark.selectExpr("cast(item_id as long) item_id", "text")
    return stored(rows.mapInArrow(_comparable_rows, "item_id long, key binary, text string"), "items")


def _blocks(items: DataFrame) -> Iterator[list[tuple[bytes, str]]]:
    """Distinct texts, about BLOCK characters or one text at a time."""
    texts = items.groupBy("key").agg(F.min("text").alias("text"))
    blocks = -(-(texts.agg(F.sum(F.length("text"))).first()[0] or 0) // BLOCK)
    for block in range(blocks):
        own = texts.where(F.pmod(F.xxhash64("key"), F.lit(blocks)) == block)
        yield [(bytes(r.key), r.text) for r in own.collect()]


def _search(items: list[tuple[bytes, str]], rate: float, docs: DataFrame) -> DataFrame:
    shared = docs.sparkSession.sparkContext.broadcast(items)

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        matcher = Matcher(shared.value, rate)
        for batch in batches:
            found = [
                (doc, *leak)
                for doc, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist(), strict=True)
                for leak in matcher.leaks(text or "")
            ]
            kinds = (pa.int64(), pa.binary(), pa.int32(), pa.int32(), pa.int32())
            yield pa.RecordBatch.from_arrays(
                [pa.array([x[i] for x in found], t) for i, t in enumerate(kinds)],
                names=["doc_id", "key", "distance", "begin", "end"],
            )

    return docs.mapInArrow(rows, HITS)


def _without(items: list[tuple[bytes, str]], rate: float, docs: DataFrame) -> DataFrame:
    shared = docs.sparkSession.sparkContext.broadcast(items)

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        matcher = Matcher(shared.value, rate)
        for batch in batches:
            yield batch.filter(pa.array([not matcher.leaks(t or "") for t in batch.column("text").to_pylist()], pa.bool_()))

    return docs.mapInArrow(rows, docs.schema)


def find_leaks(docs: DataFrame, benchmark: DataFrame, rate: float = ERROR_RATE) -> DataFrame:
    """doc_id, item_id, distance, and begin and end in characters, of each item found in a document."""
    texts = docs.selectExpr("cast(doc_id as long) doc_id", "text")
    items = _items(benchmark)
    found = [_search(block, rate, texts) for block in _blocks(items)]
    if not found:
        return docs.sparkSession.createDataFrame([], LEAKS)
    ids = items.select("item_id", "key").distinct()
    hits = reduce(DataFrame.unionByName, found).distinct()
    return hits.join(ids, "key").select("doc_id", "item_id", "distance", "begin", "end")


def clean_documents(docs: DataFrame, benchmark: DataFrame, rate: float = ERROR_RATE) -> DataFrame:
    """The documents, all columns, that hold no item."""
    return reduce(lambda left, block: _without(block, rate, left), _blocks(_items(benchmark)), docs)
