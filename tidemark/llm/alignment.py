"""Align the tokens of two tokenizers over the same bytes.

Method: merge-path partitioning. The byte offsets at which tokens of A and of B end are two sorted lists. Their
merge is a path over a grid; binary searches along its diagonals cut it into pieces of equal work, wherever
the texts begin and however unequal their tokens are. The pieces then walk at once, a step of all of them at a
time, and emit the overlaps: each step that does not stand at a common end is one link of an A and a B token.
The common ends that all pieces pass, counted along the path, number the groups, which stitches those
together that reach over the border of pieces.

Spark counts linked id pairs over the whole corpus. A slice of documents sends each of its pairs once, with how
often it has it, and gets the corpus-wide count back, so a pair that all documents hold is one row for a slice.

Both tokenizers must cut a text without loss: null and empty texts, and those whose joined token bytes are not a
blank and the text, have no tokens. Long texts are encoded in stretches cut at a blank between ASCII letters,
which neither tokenizer reaches over. Rows are independent except for the corpus-wide counts, to which
repeated rows contribute each. A null ``doc_id`` is kept; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import json
import os
import re
import zlib
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import octets, slices, split_at, stored

STEPS = 64  # of the merge in one piece
SLICE = 2 << 20
STRETCH = 1 << 18  # characters of a text encoded at once, if it has a place to cut
FAR = np.iinfo(np.int64).max

_CUT = re.compile(r"(?<=[A-Za-z]) (?=[A-Za-z])")


# --- the two tokenizers ---------------------------------------------------------------------------


def _byte_letters() -> dict[str, int]:
    """Byte-level vocabularies write printable Latin-1 characters as they are, other bytes from U+0100 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    other = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(other)}


#: Fixed value: how byte-level vocabularies cut a text before their merges.
_WORDS = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
_LONG = re.compile(r"\S{2048}|\s{2048}")


def _ranks(spec: dict, tokens: list[bytes]) -> dict[bytes, int] | None:
    """Merge ranks of a plain byte-level file, whose ids are in the order of its merges; else nothing."""
    kind, model = spec["pre_tokenizer"] or {}, spec["model"]
    plain = kind.get("type") == "ByteLevel" and kind.get("use_regex") and not kind.get("add_prefix_space")
    odd = ("dropout", "unk_token", "continuing_subword_prefix", "end_of_word_suffix", "fuse_unk", "byte_fallback", "ignore_merges")
    if not plain or spec["normalizer"] or spec["post_processor"] or any(model.get(o) for o in odd):
        return None
    made = [m if isinstance(m, str) else "".join(m) for m in model["merges"]]
    made = [m.replace(" ", "") for m in made]
    if any(model["vocab"].get(m) != 256 + i for i, m in enumerate(made)):
        return None
    return {tokens[i]: i for i in range(256 + len(made))}


class ByteLevel:
    """A byte-level BPE file; texts are given with a blank before them.

    A plain file's merges are run by rank, which is several times faster and gives the same ids (a test goes
    through every character). That takes time in the square of a word, so texts with very long ones, and other
    kinds of files, go through the file's own library.
    """

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.model = Tokenizer.from_file(path)
        self.model.encode_special_tokens = True
        spec = json.loads(self.model.to_str())
        letters = _byte_letters()
        entries = sorted(self.model.get_vocab().items(), key=lambda e: e[1])
        self.tokens = [b""] * (entries[-1][1] + 1)
        for entry, i in entries:
            self.tokens[i] = bytes(letters[c] for c in entry)
        ranks = _ranks(spec, self.tokens)
        self.ranked = None
        if ranks:
            from tiktoken import Encoding

            self.ranked = Encoding("by rank", pat_str=_WORDS, mergeable_ranks=ranks, special_tokens={}).encode_ordinary

    def by_library(self, texts: list[str]) -> list[list[int]]:
        return [e.ids for e in self.model.encode_batch_fast(texts, add_special_tokens=False)]

    def encode(self, texts: list[str]) -> list[list[int]]:
        if self.ranked is None:
            return self.by_library(texts)
        long = [i for i, t in enumerate(texts) if _LONG.search(t)]
        found = [None if t is None else self.ranked(t) for t in _without(texts, long)]
        for i, ids in zip(long, self.by_library([texts[i] for i in long]), strict=True):
            found[i] = ids
        return found


def _without(texts: list[str], places: list[int]) -> list[str | None]:
    out: list[str | None] = list(texts)
    for i in places:
        out[i] = None
    return out


class Pieces:
    """A SentencePiece model; it puts the blank before a text itself."""

    def __init__(self, path: str):
        from sentencepiece import SentencePieceProcessor

        self.model = SentencePieceProcessor(model_file=path)
        names = [self.model.id_to_piece(i) for i in range(self.model.get_piece_size())]
        self.tokens = [
            bytes([int(p[3:5], 16)]) if self.model.is_byte(i) else p.replace("▁", " ").encode()
            for i, p in enumerate(names)
        ]

    def encode(self, texts: list[str]) -> list[list[int]]:
        return self.model.encode([t[1:] for t in texts], num_threads=1)


class Side:
    """One tokenizer with tables of its tokens' bytes; texts may be cut, if no token holds a letter and a blank behind it."""

    def __init__(self, coder: ByteLevel | Pieces):
        self.encode = coder.encode
        self.bytes = pa.array(coder.tokens, pa.large_binary())
        self.size = np.array([len(t) for t in coder.tokens], np.int64)
        self.cuts = not any(re.search(rb"[A-Za-z] ", t) for t in coder.tokens)

    def __len__(self) -> int:
        return len(self.size)


@lru_cache(maxsize=4)
def sides(a_path: str, b_path: str) -> tuple[Side, Side]:
    return Side(ByteLevel(a_path)), Side(Pieces(b_path))


def stretches(text: str, limit: int) -> list[str]:
    """The text in parts of about ``limit`` characters, each but the first beginning with the blank it was cut at."""
    cuts, at = [0], limit
    while at < len(text):
        m = _CUT.search(text, max(at, 1))
        if not m:
            break
        cuts.append(m.start())
        at = m.start() + limit
    return [text[a:b] for a, b in zip(cuts, [*cuts[1:], len(text)], strict=True)]


def _ids(side: Side, parts: list[str], owner: np.ndarray, docs: int) -> tuple[np.ndarray, np.ndarray]:
    """Token ids of all documents, and how many each has."""
    found = side.encode(parts)
    sizes = np.array([len(f) for f in found], np.int64)
    ids = np.fromiter(chain.from_iterable(found), np.int64, int(sizes.sum()))
    return ids, np.bincount(owner, sizes, docs).astype(np.int64)


def _lossless(side: Side, ids: np.ndarray, counts: np.ndarray, texts: list[bytes]) -> np.ndarray:
    """Which documents' tokens join to a blank and the text."""
    joined = pc.take(side.bytes, pa.array(ids)).buffers()[2]
    joined = memoryview(joined or b"").cast("B")  # the buffer's own view has signed bytes
    ends = np.concatenate(([0], np.cumsum(side.size[ids])))[np.concatenate(([0], np.cumsum(counts)))].tolist()
    pairs = zip(texts, ends, ends[1:], strict=False)
    return np.array([bool(t) and joined[a : a + 1] == b" " and joined[a + 1 : b] == t for t, a, b in pairs], bool)


# --- the merge ------------------------------------------------------------------------------------


def diagonals(a: np.ndarray, b: np.ndarray, steps: int) -> tuple[np.ndarray, np.ndarray]:
    """Where the merge path crosses every ``steps``-th diagonal: taken of A, and of B; A goes first at equal ends."""
    d = np.arange(0, len(a) + len(b), steps)
    low, high = np.maximum(0, d - len(b)), np.minimum(d, len(a))
    while (low < high).any():
        i = (low + high) >> 1
        # Not yet enough of A, if its next end is due before the last of B that was taken.
        more = a[np.minimum(i, len(a) - 1)] <= b[np.clip(d - i - 1, 0, len(b) - 1)]
        more &= low < high
        low, high = np.where(more, i + 1, low), np.where(more | (low >= high), high, i)
    return low, d - low


class Merged:
    """Links and groups of two lists of ends that close with the same end."""

    def __init__(self, a: np.ndarray, b: np.ndarray, steps: int = STEPS):
        i, j = diagonals(a, b, steps)
        total = len(a) + len(b)
        left, right = np.append(a, FAR), np.append(b, FAR)
        takes = np.zeros((steps, len(i)), bool)  # from A, by step and piece
        for step in range(steps):
            from_a = left[i] <= right[j]
            takes[step] = from_a
            i, j = np.minimum(i + from_a, len(a)), np.minimum(j + ~from_a, len(b))  # the last piece may be short
        takes = takes.T.ravel()[:total]
        # Pieces put together again: what was taken before each step, whichever piece took it.
        i = np.cumsum(takes) - takes
        j = np.arange(total) - i
        # A step stands at a common end if it takes a B token that ends with the A token taken just before.
        common = np.zeros(total, bool)
        from_b = ~takes & (i > 0)
        common[from_b] = a[i[from_b] - 1] == b[j[from_b]]
        passed = np.cumsum(common) - common  # so a group that reaches over a border keeps its number
        self.group_a, self.group_b = passed[takes], passed[~takes]
        link = ~common
        self.link_a, self.link_b = i[link], j[link]


# --- a slice of documents -------------------------------------------------------------------------


class Aligned:
    """Tokens, links and groups of a few documents; those with a loss have none."""

    def __init__(self, octet: list[bytes], a: Side, b: Side, stretch: int = STRETCH):
        self.a, self.b = a, b
        own = [i for i, t in enumerate(octet) if t]
        limit = stretch if a.cuts and b.cuts else FAR
        parts = [stretches(" " + octet[i].decode("utf-8", "replace"), limit) for i in own]
        owner = np.repeat(np.array(own, np.int64), [len(p) for p in parts])
        parts = [p for ps in parts for p in ps]
        ids_a, n_a = _ids(a, parts, owner, len(octet))
        ids_b, n_b = _ids(b, parts, owner, len(octet))
        good = _lossless(a, ids_a, n_a, octet) & _lossless(b, ids_b, n_b, octet)
        self.ids_a, self.ids_b = ids_a[np.repeat(good, n_a)], ids_b[np.repeat(good, n_b)]
        self.n_a, self.n_b = n_a * good, n_b * good
        self.ends_a, self.ends_b = np.cumsum(a.size[self.ids_a]), np.cumsum(b.size[self.ids_b])
        self.merged = Merged(self.ends_a, self.ends_b)
        self.doc_a = np.repeat(np.arange(len(octet)), self.n_a)

    def groups(self) -> np.ndarray:
        """How many each document has."""
        first = split_at(self.merged.group_a)[:-1]
        return np.bincount(self.doc_a[first], minlength=len(self.n_a))

    def links(self) -> tuple[np.ndarray, np.ndarray]:
        """Document and id pair (as one number) of each link."""
        m = self.merged
        return self.doc_a[m.link_a], self.ids_a[m.link_a] * len(self.b) + self.ids_b[m.link_b]

    def digests(self) -> list[str]:
        """Hash of ``a1,a2|b1;a3|b2,b3`` of each document; empty where it has no tokens."""
        ga, gb = self.merged.group_a, self.merged.group_b
        last_a, last_b = np.append(ga[1:] != ga[:-1], [True] * bool(len(ga))), np.append(gb[1:] != gb[:-1], [True] * bool(len(gb)))
        words = np.empty(len(ga) + len(gb), np.int64)
        upto_a, upto_b = np.cumsum(np.bincount(ga)), np.cumsum(np.bincount(gb))  # tokens up to the end of each group
        before_b = np.concatenate(([0], upto_b))
        words[np.arange(len(ga)) + before_b[ga]] = self.ids_a * 2 + last_a
        words[np.arange(len(gb)) + upto_a[gb]] = 2 * len(self.a) + self.ids_b * 2 + last_b
        texts = pc.take(_numerals(len(self.a), len(self.b)), pa.array(words))
        ends = np.frombuffer(texts.buffers()[1], np.int64)[: len(words) + 1] if len(words) else np.zeros(1, np.int64)
        data = memoryview(texts.buffers()[2] or b"")
        bounds = ends[np.concatenate(([0], np.cumsum(self.n_a + self.n_b)))].tolist()
        return [hashlib.sha256(data[x : y - 1]).hexdigest() if y > x else "" for x, y in zip(bounds, bounds[1:], strict=False)]


@lru_cache(maxsize=4)
def _numerals(a: int, b: int) -> pa.Array:
    """Each id inside and at the end of its side of a group."""
    return pa.array([f"{i}{c}".encode() for n, ends in ((a, ",|"), (b, ",;")) for i in range(n) for c in ends], pa.large_binary())


# --- over the corpus ------------------------------------------------------------------------------

DOCUMENT = "struct<doc_id: long, n_a: long, n_b: long, n_groups: long, n_links: long, width: long, groups_sha256: string>"
PACKED = f"slice long, docs array<{DOCUMENT}>, pairs array<long>, times array<long>, which binary, often binary"


def _pack(a_path: str, b_path: str):
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 32
        for whole in batches:
            for batch in slices(whole, SLICE):
                found = Aligned(octets(batch), *sides(a_path, b_path))
                doc, pair = found.links()
                coded = pa.array(pair).dictionary_encode()
                pairs, place = coded.dictionary.to_numpy(), coded.indices.to_numpy().astype(np.int64)
                key, often = np.unique(doc * len(pairs) + place, return_counts=True) if len(doc) else (doc, doc)
                which = key % max(1, len(pairs))
                width = np.bincount(key // max(1, len(pairs)), minlength=batch.num_rows)
                links = np.bincount(doc, minlength=batch.num_rows)
                ids = batch.column("doc_id").to_pylist()
                columns = (ids, found.n_a, found.n_b, found.groups(), links, width, found.digests())
                names = ("doc_id", "n_a", "n_b", "n_groups", "n_links", "width", "groups_sha256")
                kinds = [pa.int64()] * 6 + [pa.string()]
                docs = pa.StructArray.from_arrays(
                    [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=list(names)
                )
                one = pa.array([0, batch.num_rows], pa.int32())
                span = pa.array([0, len(pairs)], pa.int32())
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([number], pa.int64()),
                        pa.ListArray.from_arrays(one, docs),
                        pa.ListArray.from_arrays(span, pa.array(pairs, pa.int64())),
                        pa.ListArray.from_arrays(span, pa.array(np.bincount(place, minlength=len(pairs)), pa.int64())),
                        pa.array([zlib.compress(which.astype("<i4").tobytes(), 1)], pa.binary()),
                        pa.array([zlib.compress(often.astype("<i4").tobytes(), 1)], pa.binary()),
                    ],
                    names=["slice", "docs", "pairs", "times", "which", "often"],
                )
                number += 1

    return rows


def _texts(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")


def _pairs(packed: DataFrame, b_ids: int) -> DataFrame:
    """pair, a_id, b_id, links, and whether that is the highest count of the B id.

    A B id has at most as many pairs as A has ids, which bounds the group that is ranked.
    """
    each = packed.select(F.explode(F.arrays_zip("pairs", "times")).alias("p"))
    counts = each.groupBy(F.col("p.pairs").alias("pair")).agg(F.sum("p.times").alias("links"))
    counts = counts.withColumn("a_id", F.floor(F.col("pair") / b_ids)).withColumn("b_id", F.col("pair") % b_ids)
    highest = F.max("links").over(Window.partitionBy("b_id"))
    return counts.withColumn("best", F.col("links") == highest)


def pair_counts(docs: DataFrame, a_path: str, b_path: str) -> DataFrame:
    """a_id, b_id, links of every linked id pair, and ``best`` for the most frequent ones of a B id."""
    packed = _texts(docs).mapInArrow(_pack(a_path, b_path), PACKED)
    return _pairs(packed, len(sides(a_path, b_path)[1])).select("a_id", "b_id", "links", "best")


RESULT = (
    "doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string"
)


def _summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Counts of the pairs of a slice, added up for each of its documents."""
    for batch in batches:
        for i in range(batch.num_rows):
            row = batch.slice(i, 1)
            docs = row.column("docs").flatten()
            which, often = (np.frombuffer(zlib.decompress(row.column(c)[0].as_py()), "<i4") for c in ("which", "often"))
            known = row.column("known").flatten()  # in the order of the slice's pairs
            links, best = (known.field(n).to_numpy(zero_copy_only=False).astype(np.int64) for n in ("links", "best"))
            width = docs.field("width").to_numpy()
            ends = np.concatenate(([0], np.cumsum(width)))
            sums = []
            for value in (best, links):
                total = np.concatenate(([0], np.cumsum(value[which] * often)))
                sums.append(pa.array(total[ends[1:]] - total[ends[:-1]], pa.int64()))
            plain = [docs.field(n) for n in ("doc_id", "n_a", "n_b", "n_groups", "n_links")]
            yield pa.RecordBatch.from_arrays(
                [*plain, *sums, docs.field("groups_sha256")], names=[f.split()[0] for f in RESULT.split(", ")]
            )


def digests(docs: DataFrame, a_path: str, b_path: str) -> DataFrame:
    """Numbers of tokens, groups and links of each document, and how frequent its links are in the corpus."""
    packed = stored(_texts(docs).mapInArrow(_pack(a_path, b_path), PACKED), "alignment")
    counts = _pairs(packed, len(sides(a_path, b_path)[1])).select("pair", "links", "best")
    asked = packed.select("slice", F.posexplode("pairs").alias("at", "pair"))
    known = asked.join(counts, "pair").groupBy("slice")
    known = known.agg(F.sort_array(F.collect_list(F.struct("at", "links", "best"))).alias("known"))
    joined = packed.select("slice", "docs", "which", "often").join(known, "slice", "left")
    nothing = F.array().cast("array<struct<at: int, links: long, best: boolean>>")
    return joined.select("docs", "which", "often", F.coalesce("known", nothing).alias("known")).mapInArrow(_summed, RESULT)


def groups(docs: DataFrame, a_path: str, b_path: str) -> DataFrame:
    """doc_id, group, byte range in a blank and the text, and the ids of both sides, of every group."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in slices(whole, SLICE):
                found = Aligned(octets(batch), *sides(a_path, b_path))
                m = found.merged
                cut_a, cut_b = split_at(m.group_a), split_at(m.group_b)
                doc = found.doc_a[cut_a[:-1]]
                end = found.ends_a[cut_a[1:] - 1]
                start = np.concatenate(([0], end))[:-1]
                first = np.searchsorted(doc, doc)  # group that opens the document
                ids = batch.column("doc_id").to_pylist()
                columns = [
                    pa.array([ids[i] for i in doc.tolist()], pa.int64()),
                    pa.array(np.arange(len(doc)) - first),
                    pa.array(start - start[first]),
                    pa.array(end - start[first]),
                    pa.ListArray.from_arrays(pa.array(cut_a, pa.int32()), pa.array(found.ids_a)),
                    pa.ListArray.from_arrays(pa.array(cut_b, pa.int32()), pa.array(found.ids_b)),
                ]
                yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "group", "start", "end", "a_ids", "b_ids"])

    shape = "doc_id long, group long, start long, end long, a_ids array<long>, b_ids array<long>"
    return _texts(docs).mapInArrow(rows, shape)
