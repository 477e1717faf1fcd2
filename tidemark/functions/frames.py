"""Framed Avro payloads: header split, and column-at-a-time decode and encode.

A frame is one zero byte, a four-byte big-endian schema id and an Avro record body. Only flat
records of primitives and nullable primitives occur. Where Spark's Avro module is loaded, both directions
are its functions. Elsewhere they run as Arrow UDFs that walk the fields of a whole batch at once with
numpy, so no Python code runs per row.
"""

from __future__ import annotations

import json
from collections.abc import Mapping
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions import avro
from tidemark.schemas import SPARK_TYPES

HEADER_BYTES = 5
MAX_VARINT_BYTES = 10

ARROW_TYPES = {
    "string": pa.string(),
    "int": pa.int32(),
    "long": pa.int64(),
    "float": pa.float32(),
    "double": pa.float64(),
    "boolean": pa.bool_(),
}


class FieldSpec(NamedTuple):
    name: str
    kind: str
    null_branch: int | None  # position of "null" in the union; None for a required field


def flat_fields(schema_json: str) -> list[FieldSpec]:
    """Fields of a flat Avro record; anything nested is refused on the driver."""
    fields = []
    for field in json.loads(schema_json)["fields"]:
        kind, null_branch = field["type"], None
        if isinstance(kind, list):
            if len(kind) != 2 or "null" not in kind:
                raise ValueError(f"unsupported union in field {field['name']}: {kind}")
            null_branch = kind.index("null")
            kind = kind[1 - null_branch]
        if isinstance(kind, dict) and isinstance(kind.get("type"), str):
            kind = kind["type"]
        if kind not in SPARK_TYPES:
            raise ValueError(f"unsupported type in field {field['name']}: {kind}")
        fields.append(FieldSpec(field["name"], kind, null_branch))
    return fields


# --- header, native expressions ------------------------------------------------------------------


def frame_status(value: Column) -> Column:
    """``null_or_short``, ``bad_magic`` or ``framed``."""
    return (
        F.when(value.isNull() | (F.octet_length(value) < HEADER_BYTES), "null_or_short")
        .when(F.hex(F.substring(value, 1, 1)) != "00", "bad_magic")
        .otherwise("framed")
    )


def frame_schema_id(value: Column) -> Column:
    """Unsigned schema id of a well-formed frame, else null."""
    digits = F.conv(F.hex(F.substring(value, 2, 4)), 16, 10)
    return F.when(frame_status(value) == "framed", digits.cast("long"))


# --- decode --------------------------------------------------------------------------------------


def _read_varint(data, cursor, end, live):
    """Zig-zag integers at ``cursor``; advances it and clears ``live`` where input runs out."""
    raw = np.zeros(len(cursor), np.uint64)
    pending = np.flatnonzero(live)
    for step in range(MAX_VARINT_BYTES):
        if not len(pending):
            break
        short = cursor[pending] >= end[pending]
        live[pending[short]] = False
        pending = pending[~short]
        byte = data[cursor[pending]].astype(np.uint64)
        raw[pending] |= (byte & np.uint64(0x7F)) << np.uint64(7 * step)
        cursor[pending] += 1
        pending = pending[byte >= 0x80]
    live[pending] = False
    half = (raw >> np.uint64(1)).astype(np.int64)
    return half ^ -(raw & np.uint64(1)).astype(np.int64)


def _read_fixed(data, cursor, end, live, dtype):
    """Little-endian fixed-width values at ``cursor``."""
    width = dtype.itemsize
    live &= cursor + width <= end
    rows = np.flatnonzero(live)
    values = np.zeros(len(cursor), dtype)
    grid = data[cursor[rows, None] + np.arange(width)]
    values[rows] = np.ascontiguousarray(grid).view(dtype).ravel()
    cursor[rows] += width
    return values


def _slice_index(begin, length):
    """Positions of every byte of the slices ``[begin, begin + length)``, in row order."""
    out_start = np.cumsum(length) - length
    return np.repeat(begin - out_start, length) + np.arange(int(length.sum()))


def _text_array(data, begin, length, present):
    """Strings sliced out of ``data`` (empty where absent), and a mask of rows that are not UTF-8."""
    length = np.where(present, length, 0)
    offsets = np.concatenate(([0], np.cumsum(length))).astype(np.int32)
    body = np.ascontiguousarray(data[_slice_index(begin, length)])
    raw = pa.Array.from_buffers(
        pa.binary(), len(length), [None, pa.py_buffer(offsets), pa.py_buffer(body)]
    )
    broken = np.zeros(len(length), bool)
    try:
        text = raw.cast(pa.string())
    except pa.ArrowInvalid:
        broken[_not_text(raw, 0, len(raw))] = True
        text, _ = _text_array(data, begin, length, present & ~broken)
    return text, broken


def _not_text(raw: pa.Array, start: int, end: int) -> list[int]:
    """Rows that are no UTF-8, found by halving: whole slices are checked at once."""
    try:
        raw.slice(start, end - start).cast(pa.string())
        return []
    except pa.ArrowInvalid:
        if end - start == 1:
            return [start]
        middle = (start + end) // 2
        return _not_text(raw, start, middle) + _not_text(raw, middle, end)


def decode_batch(
    values: pa.Array,
    writers: Mapping[int, list[FieldSpec]],
    default: list[FieldSpec],
    output: list[tuple[str, str]],
) -> pa.StructArray:
    """Decode one Arrow batch of frames to ``struct<decoded, *output>``."""
    values = values.cast(pa.binary())  # 32-bit offsets, whatever Spark sends
    n = len(values)
    valid = np.asarray(values.is_valid())
    offsets = np.frombuffer(values.buffers()[1], np.int32)[values.offset : values.offset + n + 1]
    buffer = values.buffers()[2]
    data = np.frombuffer(buffer, np.uint8) if buffer is not None else np.zeros(0, np.uint8)
    begin, end = offsets[:-1].astype(np.int64), offsets[1:].astype(np.int64)

    framed = np.flatnonzero(valid & (end - begin >= HEADER_BYTES))
    framed = framed[data[begin[framed]] == 0]
    head = data[begin[framed, None] + np.arange(1, HEADER_BYTES)]
    schema_ids = np.ascontiguousarray(head).view(">u4").ravel()

    decoded = np.zeros(n, bool)
    present = {name: np.zeros(n, bool) for name, _ in output}
    numbers = {
        name: np.zeros(n, ARROW_TYPES[kind].to_pandas_dtype()) for name, kind in output if kind != "string"
    }
    starts = {name: np.zeros(n, np.int64) for name, kind in output if kind == "string"}
    lengths = {name: np.zeros(n, np.int64) for name in starts}

    for schema_id in np.unique(schema_ids):
        rows = framed[schema_ids == schema_id]
        cursor, stop = begin[rows] + HEADER_BYTES, end[rows]
        live = np.ones(len(rows), bool)
        for field in writers.get(int(schema_id), default):
            filled = live.copy()
            if field.null_branch is not None:
                branch = _read_varint(data, cursor, stop, live)
                live &= (branch == 0) | (branch == 1)
                filled = live & (branch != field.null_branch)
            ok = filled.copy()
            if field.kind == "string":
                size = _read_varint(data, cursor, stop, ok)
                ok &= (size >= 0) & (size <= stop - cursor)
                starts[field.name][rows] = cursor
                lengths[field.name][rows] = np.where(ok, size, 0)
                cursor[ok] += size[ok]
                shown = ok
            elif field.kind in ("int", "long"):
                number = _read_varint(data, cursor, stop, ok)
                target = numbers[field.name].dtype
                bounds = np.iinfo(target)
                shown = ok & (number >= bounds.min) & (number <= bounds.max)
                numbers[field.name][rows] = np.where(shown, number, 0).astype(target)
            else:
                wire = {"float": "<f4", "double": "<f8", "boolean": "u1"}[field.kind]
                numbers[field.name][rows] = _read_fixed(data, cursor, stop, ok, np.dtype(wire))
                shown = ok
            live &= ok | ~filled
            present[field.name][rows] = shown
        decoded[rows] = live

    texts = {}
    for name in starts:
        texts[name], broken = _text_array(data, starts[name], lengths[name], present[name] & decoded)
        decoded &= ~broken

    columns = [pa.array(decoded)]
    for name, kind in output:
        hidden = ~(present[name] & decoded)
        if kind == "string":
            keep = pa.array(np.arange(n), mask=hidden)
            columns.append(texts[name].take(keep))
        else:
            columns.append(pa.array(numbers[name], ARROW_TYPES[kind], mask=hidden))
    return pa.StructArray.from_arrays(columns, names=["decoded", *[name for name, _ in output]])


class FrameDecoder:
    """Decoder for a fixed set of writer schemas, resolved once on the driver.

    ``writers`` maps schema ids to Avro JSON; frames with any other id are read with ``default``.
    """

    def __init__(self, writers: Mapping[int, str], default: str):
        self.texts, self.default_text = {int(k): v for k, v in writers.items()}, default
        self.writers = {int(k): flat_fields(v) for k, v in writers.items()}
        self.default = flat_fields(default)
        kinds: dict[str, str] = {}
        for fields in [self.default, *self.writers.values()]:
            for field in fields:
                if kinds.setdefault(field.name, field.kind) != field.kind:
                    raise ValueError(f"field {field.name} has conflicting types")
        self.output = list(kinds.items())

    @property
    def struct_type(self) -> T.StructType:
        fields = [T.StructField("decoded", T.BooleanType())]
        return T.StructType(fields + [T.StructField(n, SPARK_TYPES[k]) for n, k in self.output])

    def decode(self, value: Column) -> Column:
        """``struct<decoded boolean, field...>``; fields are null where decoding failed."""
        if avro.avro_loaded():
            kinds = [(name, SPARK_TYPES[kind].simpleString()) for name, kind in self.output]
            framed = frame_status(value) == "framed"
            return avro.decode_frame(value, framed, frame_schema_id(value), self.texts, self.default_text, kinds)
        writers, default, output = self.writers, self.default, self.output

        @F.arrow_udf(self.struct_type)
        def decode_frames(values: pa.Array) -> pa.Array:
            return decode_batch(values, writers, default, output)

        # Declared non-deterministic so that filters on decoded fields are not pushed below the
        # UDF, where the optimizer would run it a second time.
        return decode_frames.asNondeterministic()(value)

    def payload_json(self, decoded: Column) -> Column:
        """JSON text of a decoded struct, null where decoding failed; null fields are left out."""
        fields = F.struct(*[decoded[name].alias(name) for name, _ in self.output])
        return F.when(decoded["decoded"], F.to_json(fields))


# --- encode --------------------------------------------------------------------------------------


class _Piece(NamedTuple):
    """Bytes that one field adds to every row: their count, and a function that writes them."""

    size: np.ndarray
    write: object


def _varint_piece(number, shown):
    number = number.astype(np.int64)
    code = ((number << np.int64(1)) ^ (number >> np.int64(63))).astype(np.uint64)
    size = np.ones(len(code), np.int64)
    for step in range(1, MAX_VARINT_BYTES):
        size += code >> np.uint64(7 * step) > 0
    size = np.where(shown, size, 0)

    def write(out, at):
        for step in range(int(size.max(initial=0))):
            rows = np.flatnonzero(size > step)
            low = (code[rows] >> np.uint64(7 * step)) & np.uint64(0x7F)
            more = np.where(size[rows] > step + 1, 0x80, 0)
            out[at[rows] + step] = low.astype(np.uint8) | more.astype(np.uint8)

    return _Piece(size, write)


def _fixed_piece(values, shown):
    grid = np.ascontiguousarray(values).view(np.uint8).reshape(len(values), values.dtype.itemsize)
    rows = np.flatnonzero(shown)

    def write(out, at):
        out[at[rows, None] + np.arange(grid.shape[1])] = grid[rows]

    return _Piece(np.where(shown, grid.shape[1], 0), write)


def _bytes_piece(data, begin, length):
    def write(out, at):
        out[_slice_index(at, length)] = data[_slice_index(begin, length)]

    return _Piece(length, write)


def encode_batch(columns: list[pa.Array], fields: list[FieldSpec], schema_id: int) -> pa.Array:
    """Frames for one Arrow batch; a row with a missing required field becomes null."""
    n = len(columns[0])
    complete = np.ones(n, bool)
    pieces = []
    for column, field in zip(columns, fields):
        shown = np.asarray(column.is_valid())
        if field.null_branch is None:
            complete &= shown
        else:
            branch = np.where(shown, 1 - field.null_branch, field.null_branch)
            pieces.append(_varint_piece(branch, np.ones(n, bool)))
        if field.kind == "string":
            raw = column.cast(pa.binary())
            offsets = np.frombuffer(raw.buffers()[1], np.int32)[raw.offset : raw.offset + n + 1]
            offsets = offsets.astype(np.int64)
            body = raw.buffers()[2]
            data = np.frombuffer(body, np.uint8) if body is not None else np.zeros(0, np.uint8)
            length = np.where(shown, np.diff(offsets), 0)
            pieces.append(_varint_piece(length, shown))
            pieces.append(_bytes_piece(data, offsets[:-1], length))
        elif field.kind in ("int", "long"):
            number = column.cast(pa.int64()).fill_null(0).to_numpy(zero_copy_only=False)
            pieces.append(_varint_piece(number, shown))
        else:
            wire = {"float": "<f4", "double": "<f8", "boolean": "u1"}[field.kind]
            kind = ARROW_TYPES[field.kind]
            filled = column.cast(kind).fill_null(pa.scalar(0).cast(kind))
            pieces.append(_fixed_piece(filled.to_numpy(zero_copy_only=False).astype(wire), shown))

    size = HEADER_BYTES + sum(piece.size for piece in pieces)
    offsets = np.concatenate(([0], np.cumsum(size)))
    out = np.zeros(int(offsets[-1]), np.uint8)
    at = offsets[:-1].copy()
    out[at[:, None] + np.arange(1, HEADER_BYTES)] = np.array([schema_id], ">u4").view(np.uint8)
    at += HEADER_BYTES
    for piece in pieces:
        piece.write(out, at)
        at += piece.size
    frames = pa.Array.from_buffers(
        pa.binary(), n, [None, pa.py_buffer(offsets.astype(np.int32)), pa.py_buffer(out)]
    )
    return frames.take(pa.array(np.arange(n), mask=~complete))


def encode_frame(schema_json: str, schema_id: int) -> Column:
    """Framed record built from the columns named like the schema's fields."""
    fields = flat_fields(schema_json)
    if avro.avro_loaded():
        record = [(f.name, F.col(f.name).cast(SPARK_TYPES[f.kind]), f.null_branch is None) for f in fields]
        return avro.encode_frame(schema_json, schema_id, record)

    @F.arrow_udf(T.BinaryType())
    def encode_frames(*columns: pa.Array) -> pa.Array:
        return encode_batch(list(columns), fields, schema_id)

    columns = [F.col(f.name).cast(SPARK_TYPES[f.kind]) for f in fields]
    return encode_frames.asNondeterministic()(*columns)
