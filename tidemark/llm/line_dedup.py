"""Drop lines that a document with a smaller id already holds.

Method: line hashes are range-partitioned and sorted by (hash, document, position); one pass over each
partition keeps the first document of every hash, and what comes back is one compressed bitmap of kept
lines for each document, not text.

* Hot lines: each task first compares the lines of its own batch. Only rows of the smallest document of
  a batch travel by hash; what the others lose is already certain and travels with their document. A line
  that a third of all documents hold is thus a row for each batch, not for each document.
* Hashes have 128 bits.
* Null or empty text is one empty line, which is never dropped (its key is too short). Rows whose
  ``doc_id`` is null take no part and keep all lines. Rows that repeat a ``doc_id`` count as one document
  (they never drop each other's lines). An empty table gives an empty result. Extra columns are ignored.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from xxhash import xxh3_128_digest

from tidemark.llm.common import binaries, keyed_texts, longs, octets, slices, unused

MIN_CODE_POINTS = 10

LINE_ROWS = "h1 long, h2 long, doc_id long, place long, n_lines int, dropped binary"


def line_keys(text: bytes) -> list[bytes]:
    """Lines with ASCII white space stripped at both ends and A-Z lower-cased."""
    return [line.strip() for line in text.lower().split(b"\n")]


def long_enough(key: bytes, least: int) -> bool:
    return len(key) >= least and (key.isascii() or len(key.decode("utf-8", "replace")) >= least)


def _line_rows(least: int):
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in slices(whole):
                yield from _one_batch(batch, least)

    return rows


def _one_batch(batch: pa.RecordBatch, least: int) -> Iterator[pa.RecordBatch]:
    ids, keys = longs(batch, "doc_id"), longs(batch, "text_key") & 0xFFFFFFFF
    digests, of, at, n_lines = [], [], [], np.zeros(len(ids), np.int32)
    for i, text in enumerate(octets(batch)):
        found = line_keys(text)
        n_lines[i] = len(found)
        kept = [j for j, k in enumerate(found) if long_enough(k, least)]
        digests.extend(xxh3_128_digest(found[j]) for j in kept)
        at.extend(kept)
        of.extend([i] * len(kept))
    h = np.frombuffer(b"".join(digests), ">u8").astype(np.uint64).view(np.int64).reshape(-1, 2)
    of, at = np.array(of, np.int64), np.array(at, np.int64)
    doc = ids[of]
    order = np.lexsort((doc, h[:, 1], h[:, 0]))
    h, of, at, doc = h[order], of[order], at[order], doc[order]
    first = np.ones(len(h), bool)
    first[1:] = (h[1:] != h[:-1]).any(axis=1)
    smallest = doc[first][np.cumsum(first) - 1] if len(h) else doc
    ships = doc == smallest
    lost: dict[int, list[int]] = {}
    for i, j in zip(of[~ships].tolist(), at[~ships].tolist(), strict=True):
        lost.setdefault(i, []).append(j)
    lines = int(ships.sum())
    # A row for each document carries its line count and certain losses; any range may take it.
    spread = np.frombuffer(
        b"".join(xxh3_128_digest(b"%d %d" % x) for x in zip(ids.tolist(), keys.tolist(), strict=True)), "<i8"
    ).reshape(-1, 2)
    nothing = pa.nulls(lines, pa.int32())
    yield pa.RecordBatch.from_arrays(
        [
            pa.array(np.concatenate((h[ships, 0], spread[:, 0]))),
            pa.array(np.concatenate((h[ships, 1], spread[:, 1]))),
            pa.array(np.concatenate((doc[ships], ids))),
            pa.array(np.concatenate(((at[ships] << 32) | keys[of[ships]], keys))),
            pa.concat_arrays([nothing, pa.array(n_lines)]),
            pa.concat_arrays(
                [
                    pa.nulls(lines, pa.binary()),
                    binaries([np.array(lost.get(i, []), "<i4").tobytes() for i in range(len(ids))]),
                ]
            ),
        ],
        names=["h1", "h2", "doc_id", "place", "n_lines", "dropped"],
    )


def _first_occurrences(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows come sorted by hash, document and position; every later document loses its line."""
    last, holder = None, None
    for batch in batches:
        n_lines = batch.column("n_lines")
        is_line = n_lines.is_null().to_numpy(zero_copy_only=False)
        h = np.stack((longs(batch, "h1"), longs(batch, "h2")), axis=1)[is_line]
        doc, place = longs(batch, "doc_id")[is_line], longs(batch, "place")[is_line]
        if len(h):
            first = np.ones(len(h), bool)
            first[1:] = (h[1:] != h[:-1]).any(axis=1)
            heads = doc[first]
            if last == (int(h[0, 0]), int(h[0, 1])):
                heads[0] = holder
            held = heads[np.cumsum(first) - 1]
            last, holder = (int(h[-1, 0]), int(h[-1, 1])), int(held[-1])
            lost = doc != held
            doc, place = doc[lost], place[lost]
        documents = batch.filter(pa.array(~is_line))
        at = (place >> 32).astype("<i4")
        yield pa.RecordBatch.from_arrays(
            [
                pa.concat_arrays([pa.array(doc), documents.column("doc_id").cast(pa.int64())]),
                pa.array(np.concatenate((place, longs(documents, "place"))).astype(np.uint32).view(np.int32)),
                pa.concat_arrays([pa.nulls(len(doc), pa.int32()), documents.column("n_lines")]),
                pa.concat_arrays(
                    [
                        pa.FixedSizeBinaryArray.from_buffers(pa.binary(4), len(at), [None, pa.py_buffer(at)]).cast(
                            pa.binary()
                        ),
                        documents.column("dropped").cast(pa.binary()),
                    ]
                ),
            ],
            names=["doc_id", "text_key", "n_lines", "dropped"],
        )


def _bitmaps(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        counts, maps = [], []
        for n, parts in zip(
            batch.column("n_lines").to_pylist(), batch.column("dropped").to_pylist(), strict=True
        ):
            keep = np.ones(n, bool)
            keep[np.frombuffer(b"".join(parts), "<i4")] = False
            counts.append(int(n - keep.sum()))
            maps.append(zlib.compress(np.packbits(keep).tobytes(), 1))
        yield pa.RecordBatch.from_arrays(
            [
                batch.column("doc_id"),
                batch.column("text_key"),
                batch.column("n_lines"),
                pa.array(counts, pa.int32()),
                binaries(maps),
            ],
            names=["doc_id", "text_key", "n_lines", "n_dropped", "keep"],
        )


def keep_bitmaps(docs: DataFrame, least: int = MIN_CODE_POINTS) -> DataFrame:
    """doc_id, text_key, n_lines, n_dropped and keep, the zlib-compressed bits of the lines that stay."""
    rows = keyed_texts(docs).where("doc_id is not null").mapInArrow(_line_rows(least), LINE_ROWS)
    ordered = rows.repartitionByRange("h1", "h2").sortWithinPartitions("h1", "h2", "doc_id", "place")
    lost = ordered.mapInArrow(
        _first_occurrences, "doc_id long, text_key int, n_lines int, dropped binary"
    )
    grouped = lost.groupBy("doc_id", "text_key").agg(
        F.max("n_lines").alias("n_lines"), F.collect_list("dropped").alias("dropped")
    )
    return grouped.mapInArrow(
        _bitmaps, "doc_id long, text_key int, n_lines int, n_dropped int, keep binary"
    )


def _kept(n: int, keep: bytes | None) -> np.ndarray:
    if keep is None:
        return np.ones(n, bool)
    return np.unpackbits(np.frombuffer(zlib.decompress(keep), np.uint8), count=n).astype(bool)


def _apply(text: bytes, keep: bytes | None) -> tuple[bytes, int, int]:
    lines = text.split(b"\n")
    stays = _kept(len(lines), keep)
    dropped = int(len(lines) - stays.sum())
    if dropped:
        text = b"\n".join(line for line, k in zip(lines, stays.tolist(), strict=True) if k)
    return text, len(lines), dropped


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        done = [_apply(t, k) for t, k in zip(octets(batch), batch.column("keep").to_pylist(), strict=True)]
        yield pa.RecordBatch.from_arrays(
            [
                batch.column("doc_id"),
                pa.array([x[1] for x in done], pa.int64()),
                pa.array([x[2] for x in done], pa.int64()),
                pa.array([hashlib.sha256(x[0]).hexdigest() for x in done], pa.string()),
            ],
            names=["doc_id", "n_lines", "n_dropped", "kept_sha256"],
        )


def _texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The bitmap is the last column."""
    for batch in batches:
        texts = batch.column("text").cast(pa.large_binary()).to_pylist()
        kept = [
            None if t is None else _apply(t, k)[0].decode("utf-8", "replace")
            for t, k in zip(texts, batch.column(batch.num_columns - 1).to_pylist(), strict=True)
        ]
        at = batch.schema.get_field_index("text")
        columns = [pa.array(kept, pa.string()) if i == at else c for i, c in enumerate(batch.columns[:-1])]
        yield pa.RecordBatch.from_arrays(columns, names=batch.schema.names[:-1])


def line_digests(docs: DataFrame, least: int = MIN_CODE_POINTS) -> DataFrame:
    """doc_id, n_lines, n_dropped and kept_sha256 of each document."""
    maps = keep_bitmaps(docs, least).select("doc_id", "text_key", "keep")
    return (
        keyed_texts(docs)
        .join(maps, ["doc_id", "text_key"], "left")
        .select("doc_id", "text", "keep")
        .mapInArrow(_digests, "doc_id long, n_lines long, n_dropped long, kept_sha256 string")
    )


def drop_lines(docs: DataFrame, least: int = MIN_CODE_POINTS) -> DataFrame:
    """The documents, all columns, with only the kept lines in ``text``; null texts stay null."""
    own, key, keep = (unused(docs, c) for c in ("id_", "key_", "keep_"))
    maps = keep_bitmaps(docs, least).where("n_dropped > 0")
    maps = maps.select(F.col("doc_id").alias(own), F.col("text_key").alias(key), F.col("keep").alias(keep))
    joined = docs.join(maps, (docs["doc_id"] == maps[own]) & (F.hash(docs["text"]) == maps[key]), "left")
    return joined.drop(own, key).mapInArrow(_texts, docs.schema)
