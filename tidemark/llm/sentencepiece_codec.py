"""SentencePiece encoding with byte spans of the original text, and decoding.

Method: a text is normalised by longest-prefix replacement through the model's compiled character map (a
double-array trie over UTF-8 bytes). Each byte of the normalised text remembers which source byte it came
from, so any piece, which is a range of the normalised text, projects to a range of the original.

The model's own merges then cut the normalised text into pieces. That is the only step left to the
library, run on a copy of the model whose normaliser does nothing; maps, projection and decoding are here.

Null texts are empty texts; both have no pieces. Rows are independent: repeated rows give equal results,
an empty table an empty result, and long texts cost time in proportion. The encoder reads ``doc_id`` and
``text`` only.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from functools import lru_cache
from itertools import groupby

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from sentencepiece import SentencePieceProcessor, sentencepiece_model_pb2

from tidemark.llm.common import octets

MARK = "▁"
MARK_BYTES = MARK.encode()

UNKNOWN, CONTROL, USER_DEFINED, BYTE = 2, 3, 4, 6  # fixed values of the model format


class CharacterMap:
    """The compiled map: a double-array trie of source byte strings, and their replacements."""

    def __init__(self, blob: bytes):
        size = int.from_bytes(blob[:4], "little")
        self.units = np.frombuffer(blob[4 : 4 + size], "<u4").tolist()
        self.targets = blob[4 + size :]

    def longest(self, text: bytes, at: int) -> tuple[int, bytes] | None:
        """Length of the longest source that starts at ``at``, and its replacement."""
        units, found = self.units, None
        node = (units[0] >> 10) << ((units[0] & 512) >> 6)
        for i in range(at, len(text)):
            node ^= text[i]
            unit = units[node]
            if unit & 0x800000FF != text[i]:
                break
            node ^= (unit >> 10) << ((unit & 512) >> 6)
            if unit & 256:
                found = (i + 1 - at, units[node] & 0x7FFFFFFF)
        if found is None:
            return None
        return found[0], self.targets[found[1] : self.targets.index(b"\0", found[1])]


def _character_length(lead: int) -> int:
    return 1 if lead < 0xC0 else 2 if lead < 0xE0 else 3 if lead < 0xF0 else 4


class Normalizer:
    def __init__(self, spec, symbols: list[bytes]):
        self.map = CharacterMap(spec.precompiled_charsmap) if spec.precompiled_charsmap else None
        self.symbols = re.compile(b"|".join(map(re.escape, sorted(symbols, key=len, reverse=True)))) if symbols else None
        self.dummy, self.squeeze = spec.add_dummy_prefix, spec.remove_extra_whitespaces
        self.escape = spec.escape_whitespaces
        self.plain = self.map is None and self.symbols is None and not self.squeeze and self.escape

    def _units(self, text: bytes) -> Iterator[tuple[int, int, bytes]]:
        """(start, end, replacement) of each longest prefix."""
        at = 0
        while at < len(text):
            if self.symbols and (m := self.symbols.match(text, at)):
                end, new = m.end(), m[0]
            elif self.map and (found := self.map.longest(text, at)):
                end, new = at + found[0], found[1]
            else:
                end = at + _character_length(text[at])
                new = text[at:end]
            yield at, end, new
            at = end

    def normalise(self, text: bytes) -> tuple[bytes, np.ndarray]:
        """The normalised text, and for each of its bytes and its end the source byte."""
        if not text:
            return b"", np.zeros(1, np.int64)
        if self.plain:
            return self._plain(text)
        out, origin = bytearray(), []
        space = MARK_BYTES if self.escape else b" "
        after_space, started, end = self.squeeze, False, 0
        for start, end, new in self._units(text):
            if not started:
                if self.squeeze and new == b" ":
                    continue
                started = True
                if self.dummy:
                    out += space
                    origin += [start] * len(space)
            if after_space:
                new = new.lstrip(b" ")
            if new:
                escaped = new.replace(b" ", space)
                out += escaped
                origin += [start] * len(escaped)
            if not self.squeeze:
                after_space = False
            elif new:
                after_space = new.endswith(b" ")
        if self.squeeze:
            while out.endswith(space):
                del out[-len(space) :]
                end = origin[-1]
                del origin[-len(space) :]
        return bytes(out), np.array([*origin, end], np.int64)

    def _plain(self, text: bytes) -> tuple[bytes, np.ndarray]:
        width = np.ones(len(text), np.int64)
        source = np.frombuffer(text, np.uint8)
        width[source == 0x20] = len(MARK_BYTES)
        # Like the loop above, all bytes of a character point at its first byte.
        head = np.arange(len(text))
        inside = (source & 0xC0) == 0x80
        head[inside] = 0
        origin = np.repeat(np.maximum.accumulate(head), width)
        prefix = np.zeros(len(MARK_BYTES) * self.dummy, np.int64)
        return (
            MARK_BYTES * self.dummy + text.replace(b" ", MARK_BYTES),
            np.concatenate((prefix, origin, [len(text)])),
        )


class Codec:
    """Normalise, segment, project and decode with one model."""

    def __init__(self, model: bytes):
        proto = sentencepiece_model_pb2.ModelProto.FromString(model)
        trainer, spec = proto.trainer_spec, proto.normalizer_spec
        self.types = [p.type for p in proto.pieces]
        self.surfaces = [p.piece.replace(MARK, " ") for p in proto.pieces]
        self.names = [str(i) for i in range(len(self.types))]
        self.widths = np.array(
            [1 if t == BYTE else len(p.piece.encode()) for p, t in zip(proto.pieces, self.types, strict=True)]
        )
        self.unknowns = np.array([t == UNKNOWN for t in self.types])
        self.surface_of = [
            b"" if t == CONTROL else (trainer.unk_surface if t == UNKNOWN else s).encode()
            for t, s in zip(self.types, self.surfaces, strict=True)
        ]
        self.bytes_of = {i: int(p.piece[1:-1], 16) for i, p in enumerate(proto.pieces) if p.type == BYTE}
        self.normalizer = Normalizer(spec, [p.piece.encode() for p in proto.pieces if p.type == USER_DEFINED])
        self.strips, self.squeezes = spec.add_dummy_prefix or spec.remove_extra_whitespaces, spec.remove_extra_whitespaces
        # The same pieces over text that is normalised already.
        spec.precompiled_charsmap, spec.add_dummy_prefix, spec.remove_extra_whitespaces = b"", False, False
        spec.escape_whitespaces = False
        self.segmenter = SentencePieceProcessor(model_proto=proto.SerializeToString())

    def _surface(self, ids: list[int]) -> bytes:
        if self.bytes_of.keys().isdisjoint(ids):
            return b"".join([self.surface_of[i] for i in ids])
        out = []
        for spelled, run in groupby(ids, self.bytes_of.__contains__):
            out += [_repaired(bytes([self.bytes_of[i] for i in run]))] if spelled else [self.surface_of[i] for i in run]
        return b"".join(out)

    def _pieces(self, text: bytes) -> tuple[list[int], np.ndarray]:
        """ids of a text, and the source bytes at which its pieces begin, with the end of the last."""
        normalised, origin = self.normalizer.normalise(text)
        whole = normalised.decode("utf-8", "replace")
        ids = self.segmenter.encode(whole, num_threads=1)
        numbers = np.array(ids, np.int64)
        lengths = self.widths[numbers]
        if (unknown := self.unknowns[numbers]).any():  # their length is that of the text they stand for
            pieces = self.segmenter.encode(whole, out_type=str, num_threads=1)
            lengths[unknown] = [len(pieces[i].encode()) for i in np.flatnonzero(unknown)]
        return ids, origin[np.concatenate(([0], np.cumsum(lengths)))]

    def encode(self, text: bytes) -> tuple[list[int], np.ndarray, np.ndarray]:
        """ids, and the first and last byte (exclusive) of each piece in the original text."""
        ids, bounds = self._pieces(text)
        return ids, bounds[:-1], bounds[1:]

    def decode(self, ids: list[int]) -> bytes:
        """Pieces in a row, without the space that normalisation puts first.

        A model that squeezes spaces drops one from each piece as long as nothing else has come.
        """
        if not self.squeezes:
            surface = self._surface(ids)
            return surface[1:] if self.strips and surface.startswith(b" ") else surface
        for n, i in enumerate(ids):
            first = b"" if i in self.bytes_of else self.surface_of[i].removeprefix(b" ")
            if first or i in self.bytes_of:
                return first + self._surface(ids[n + 1 :] if first else ids[n:])
        return b""

    def digest(self, text: bytes) -> tuple[int, str, bytes, int]:
        """Number of ids, their SHA-256, the decoded text, and the bytes that the pieces' spans cover."""
        ids, bounds = self._pieces(text)
        names = ",".join([self.names[i] for i in ids])
        return len(ids), hashlib.sha256(names.encode()).hexdigest(), self.decode(ids), int((bounds[1:] - bounds[:-1]).sum())


def _repaired(data: bytes) -> bytes:
    """Bytes of byte pieces; each that is no part of valid UTF-8 becomes U+FFFD."""
    try:
        data.decode()
        return data
    except UnicodeDecodeError:
        out, at = [], 0
        while at < len(data):
            for n in (4, 3, 2, 1):
                try:
                    if len(data[at : at + n].decode()) == 1:
                        out.append(data[at : at + n])
                        break
                except UnicodeDecodeError:
                    continue
            else:
                out.append("�".encode())
                n = 1
            at += n
        return b"".join(out)


@lru_cache(maxsize=2)
def codec(model: bytes) -> Codec:
    return Codec(model)


def read_model(path: str) -> bytes:
    with open(path, "rb") as file:
        return file.read()


def encode(docs: DataFrame, model: bytes) -> DataFrame:
    """doc_id, ids, begins and ends: the pieces of each text with their byte spans."""
    shared = docs.sparkSession.sparkContext.broadcast(model)  # the model's file, of fixed size

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = codec(shared.value)
        for batch in batches:
            done = [own.encode(t) for t in octets(batch)]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id")] + [pa.array([x[i] for x in done], pa.list_(t)) for i, t in enumerate((pa.int32(), pa.int64(), pa.int64()))],
                names=["doc_id", "ids", "begins", "ends"],
            )

    columns = docs.selectExpr("cast(doc_id as long) doc_id", "text")
    return columns.mapInArrow(rows, "doc_id long, ids array<int>, begins array<long>, ends array<long>")


def decode(encoded: DataFrame, model: bytes) -> DataFrame:
    """doc_id and text of each row of ids."""
    shared = encoded.sparkSession.sparkContext.broadcast(model)

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = codec(shared.value)
        for batch in batches:
            texts = [own.decode(x or []).decode() for x in batch.column("ids").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(texts, pa.string())], names=["doc_id", "text"])

    return encoded.select("doc_id", "ids").mapInArrow(rows, "doc_id long, text string")


def digests(docs: DataFrame, model: bytes) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256 and n_spanned of each text, ids not being returned."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = codec(shared.value)
        for batch in batches:
            done = [own.digest(t) for t in octets(batch)]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    pa.array([x[0] for x in done], pa.int64()),
                    pa.array([x[1] for x in done], pa.string()),
                    pa.array([hashlib.sha256(x[2]).hexdigest() for x in done], pa.string()),
                    pa.array([x[3] for x in done], pa.int64()),
                ],
                names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256", "n_spanned"],
            )

    columns = docs.selectExpr("cast(doc_id as long) doc_id", "text")
    return columns.mapInArrow(
        rows, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string, n_spanned long"
    )
