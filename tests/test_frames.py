"""Frame header, decode and encode."""

import json
import struct

import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tidemark.functions.frames import (
    _not_text,
    FrameDecoder,
    decode_batch,
    encode_batch,
    flat_fields,
    frame_schema_id,
    frame_status,
)
from tidemark.schemas import PAYLOAD_COLUMNS, avro_schema
from tidemark.session import scratch_path
from tidemark.sources import sample
from tidemark.sources.registry import event_decoder, read_schema_file, read_writer_schemas, schema_for_topic

# Bodies written by the Avro Java library.
V1_BODY = (
    "04653132323032362d30352d30315431323a30303a31302b30303a30300475310ed8040c6d6f62696c65"
    "04555310707572636861736500"
)
V3_BODY = V1_BODY[:-2] + "02046331020000003f020a626173696302000000000000294000"
E1 = {
    "event_id": "e1",
    "event_time": "2026-05-01T12:00:10+00:00",
    "user_id": "u1",
    "campaign_id": 7,
    "ad_id": 300,
    "device": "mobile",
    "country": "US",
    "event_type": "purchase",
}


def frame(schema_id, body):
    return b"\0" + schema_id.to_bytes(4, "big") + bytes.fromhex(body)


def decoded(spark, values, decoder=None):
    decoder = decoder or sample.version_decoder()
    rows = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i INT, value BINARY")
    out = rows.select("i", decoder.decode(F.col("value")).alias("f")).orderBy("i").collect()
    return [r["f"].asDict() for r in out]


def test_java_bodies(spark):
    v1, v3 = decoded(spark, [frame(1, V1_BODY), frame(3, V3_BODY)])
    assert v1.pop("decoded") and v3.pop("decoded")
    assert {k: v for k, v in v1.items() if v is not None} == E1
    more = {"ad_creative_id": "c1", "engagement_score": 0.5, "user_segment": "basic", "conversion_value": 12.5}
    assert {k: v for k, v in v3.items() if v is not None} == {**E1, **more}


@pytest.mark.parametrize(
    "value",
    [
        None,
        b"",
        b"\0\0\0\0",
        b"\x01" + frame(1, V1_BODY)[1:],
        frame(1, ""),
        frame(1, V1_BODY[:-6]),
        frame(3, V1_BODY),  # input ends at the tenth field
        frame(9, V1_BODY),  # unknown id: read with the newest schema
        frame(1, "03" + V1_BODY[2:]),  # negative length
        frame(1, V1_BODY[:-2] + "08"),  # no such union branch
        frame(1, "04ffff" + V1_BODY[6:]),  # not UTF-8
    ],
)
def test_undecodable(spark, value):
    good = frame(1, V1_BODY)
    first, bad, last = decoded(spark, [good, value, good])
    assert first["decoded"] and last["decoded"] and last["event_id"] == "e1"
    assert set(bad.values()) == {False, None}


def test_trailing_bytes_and_unknown_id(spark):
    longer, unknown = decoded(spark, [frame(1, V3_BODY), frame(77, V3_BODY)])
    assert longer["decoded"] and longer["ad_creative_id"] == "c1" and longer["user_segment"] is None
    assert unknown["decoded"] and unknown["user_segment"] == "basic"


def test_int_beyond_32_bits_is_null(spark):
    body = bytes.fromhex(V1_BODY).replace(b"\x0e\xd8\x04", b"\xfe\xff\xff\xff\xff\x1f\xd8\x04").hex()
    (row,) = decoded(spark, [frame(1, body)])
    assert row["decoded"] and row["campaign_id"] is None and row["ad_id"] == 300


def test_header_expressions(spark):
    values = [(None,), (b"\0\0\0\0",), (b"\x02\0\0\0\x01",), (b"\0\xff\xff\xff\xff",), (frame(3, "00"),)]
    rows = spark.createDataFrame(values, "v BINARY")
    out = rows.select(frame_status(F.col("v")), frame_schema_id(F.col("v"))).collect()
    assert [tuple(r) for r in out] == [
        ("null_or_short", None),
        ("null_or_short", None),
        ("bad_magic", None),
        ("framed", 2**32 - 1),
        ("framed", 3),
    ]


# A plain row-at-a-time codec to compare with.


def slow_varint(n):
    n = (n << 1) ^ (n >> 63)
    out = b""
    while n > 0x7F:
        out += bytes([n & 0x7F | 0x80])
        n >>= 7
    return out + bytes([n])


def slow_encode(row, fields, schema_id):
    out = b"\0" + schema_id.to_bytes(4, "big")
    for field in fields:
        value = row[field.name]
        if field.null_branch is not None:
            out += slow_varint(field.null_branch if value is None else 1 - field.null_branch)
            if value is None:
                continue
        elif value is None:
            return None
        if field.kind == "string":
            raw = value.encode()
            out += slow_varint(len(raw)) + raw
        elif field.kind in ("int", "long"):
            out += slow_varint(value)
        elif field.kind == "boolean":
            out += bytes([value])
        else:
            out += struct.pack("<f" if field.kind == "float" else "<d", value)
    return out


MIXED = json.dumps(
    {
        "type": "record",
        "name": "Mixed",
        "fields": [
            {"name": "s", "type": "string"},
            {"name": "i", "type": "int"},
            {"name": "l", "type": ["null", "long"]},
            {"name": "f", "type": ["float", "null"]},
            {"name": "d", "type": "double"},
            {"name": "b", "type": "boolean"},
            {"name": "t", "type": ["string", "null"]},
        ],
    }
)
MIXED_TYPES = [pa.string(), pa.int32(), pa.int64(), pa.float32(), pa.float64(), pa.bool_(), pa.string()]
TEXT = st.text(st.characters(exclude_categories=["Cs"]), max_size=70)
ROWS = st.lists(
    st.fixed_dictionaries(
        {
            "s": st.none() | TEXT,
            "i": st.integers(-(2**31), 2**31 - 1),
            "l": st.none() | st.integers(-(2**63), 2**63 - 1),
            "f": st.none() | st.floats(width=32, allow_nan=False),
            "d": st.floats(allow_nan=False),
            "b": st.booleans(),
            "t": st.none() | TEXT,
        }
    ),
    max_size=12,
)


@settings(max_examples=150, deadline=None)
@given(rows=ROWS, cut=st.integers(0, 40))
def test_codec_against_row_at_a_time(rows, cut):
    fields = flat_fields(MIXED)
    columns = [pa.array([r[f.name] for r in rows], t) for f, t in zip(fields, MIXED_TYPES)]
    frames = encode_batch(columns, fields, 5)
    assert frames.to_pylist() == [slow_encode(r, fields, 5) for r in rows]

    output = [(f.name, f.kind) for f in fields]
    # A slice starts at an offset into its buffers.
    padded = pa.concat_arrays([pa.array([b"zz", None], pa.binary()), frames]).slice(2)
    back = decode_batch(padded, {5: fields}, fields, output).to_pylist()
    for row, seen in zip(rows, back):
        assert seen.pop("decoded") == (row["s"] is not None)
        assert seen == (row if row["s"] is not None else dict.fromkeys(row))

    short = pa.array([f[: len(f) - 1 - cut] if f else None for f in frames.to_pylist()], pa.binary())
    assert not any(r["decoded"] for r in decode_batch(short, {5: fields}, fields, output).to_pylist())


def test_java_library_reads_our_frames(spark):
    """The Avro library in Spark's own jars decodes what the UDF encodes."""
    fields = flat_fields(avro_schema(3))
    row = {**dict.fromkeys(PAYLOAD_COLUMNS), **E1, "engagement_score": 0.25, "geo_latitude": -12.5}
    kinds = {"string": pa.string(), "int": pa.int32(), "float": pa.float32(), "double": pa.float64()}
    columns = [pa.array([row[f.name]], kinds[f.kind]) for f in fields]
    body = encode_batch(columns, fields, 3)[0].as_py()[5:]
    avro = spark._jvm.org.apache.avro
    schema = avro.Schema.Parser().parse(avro_schema(3))
    reader = avro.generic.GenericDatumReader(schema)
    record = reader.read(None, avro.io.DecoderFactory.get().binaryDecoder(bytearray(body), None))
    seen = {n: record.get(n) for n in PAYLOAD_COLUMNS}
    seen = {n: v.toString() if hasattr(v, "toString") else v for n, v in seen.items()}
    assert seen == row


def test_payload_text_and_versions(spark):
    decoder = sample.version_decoder()
    rows = spark.createDataFrame([(frame(1, V1_BODY),), (b"no",)], "value BINARY")
    texts = rows.select(decoder.decode(F.col("value")).alias("f")).select(decoder.payload_json(F.col("f")))
    good, bad = [r[0] for r in texts.collect()]
    assert json.loads(good) == E1 and bad is None


def test_schema_file(spark):
    path = f"{scratch_path(spark, 'schema')}/event.avsc"
    lines = [(line,) for line in json.dumps(json.loads(avro_schema(2)), indent=1).splitlines()]
    spark.createDataFrame(lines, "line STRING").coalesce(1).write.text(path)
    assert flat_fields(read_schema_file(spark, path)) == flat_fields(avro_schema(2))


def test_schema_resolution():
    assert schema_for_topic("ads", {"ads-value": "{}"}) == ("{}", "registry")
    assert schema_for_topic("ads")[1] == "local"
    with pytest.raises(ValueError, match="unsupported type"):
        flat_fields('{"fields": [{"name": "x", "type": {"type": "array", "items": "int"}}]}')
    with pytest.raises(ValueError, match="conflicting"):
        FrameDecoder({1: '{"fields": [{"name": "event_id", "type": "int"}]}'}, avro_schema())


def test_large_arrow_types(spark):
    frames = [frame(1, V1_BODY), None, b"no", frame(1, V1_BODY)]
    fields = {1: flat_fields(avro_schema(1))}
    output = [(f.name, f.kind) for f in fields[1]]
    small, large = (
        decode_batch(pa.array(frames, kind), fields, fields[1], output) for kind in (pa.binary(), pa.large_binary())
    )
    assert small.equals(large) and small.field("decoded").to_pylist() == [True, False, False, True]
    whole = decode_batch(pa.array([b"x", *frames], pa.large_binary())[1:], fields, fields[1], output)
    assert whole.equals(small)


def test_broken_text_is_found_by_halving():
    good = [b"a", "\u00e9".encode(), b"", b"long" * 50] * 40
    rows = list(good)
    for i in (0, 77, 159):
        rows[i] = b"\xff\xfe"
    assert _not_text(pa.array(rows, pa.binary()), 0, len(rows)) == [0, 77, 159]
    assert _not_text(pa.array(good, pa.binary()), 0, len(good)) == []


def test_writer_schemas_by_registry_id(spark):
    path = scratch_path(spark, "schemas")
    text = json.dumps({"1": json.loads(avro_schema(3)), "7": avro_schema(1)})
    spark.createDataFrame([(text,)], "line STRING").coalesce(1).write.text(path)
    found = read_writer_schemas(spark, path)
    assert flat_fields(found[1]) == flat_fields(avro_schema(3)) and flat_fields(found[7]) == flat_fields(avro_schema(1))
    assert event_decoder().writers == {}
