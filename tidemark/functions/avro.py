"""Frames by Spark's own Avro functions, where their module is on the class path.

The header is checked and cut off with native expressions; the body of each schema id goes through
``from_avro`` with that writer's schema. No Python runs in tasks then.
"""

from __future__ import annotations

import json
from collections.abc import Mapping

from py4j.java_gateway import JavaPackage
from pyspark import SparkContext
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.avro.functions import from_avro, to_avro

HEADER_BYTES = 5
PERMISSIVE = {"mode": "PERMISSIVE"}  # a body that cannot be read is null


def avro_loaded() -> bool:
    """Whether the running session has the Avro module."""
    context = SparkContext._active_spark_context
    return context is not None and not isinstance(context._jvm.org.apache.spark.sql.avro.AvroDataToCatalyst, JavaPackage)


def decode_body(body: Column, schema_json: str, output: list[tuple[str, str]]) -> Column:
    """``struct<decoded, field...>`` of one writer's record; fields it does not have are null."""
    written = {field["name"] for field in json.loads(schema_json)["fields"]}

    def shaped(record: Column) -> Column:
        fields = [
            (record[name] if name in written else F.lit(None)).cast(kind).alias(name) for name, kind in output
        ]
        return F.struct(record.isNotNull().alias("decoded"), *fields)

    # Read once, however many fields are taken from it.
    return F.transform(F.array(from_avro(body, schema_json, PERMISSIVE)), shaped)[0]


def decode_frame(
    value: Column, framed: Column, schema_id: Column, writers: Mapping[int, str], default: str,
    output: list[tuple[str, str]],
) -> Column:
    """The record of each frame by its schema id, or by the default; not decoded if there is no frame."""
    body = F.substring(value, HEADER_BYTES + 1, (1 << 31) - 1)
    none = F.struct(F.lit(False).alias("decoded"), *[F.lit(None).cast(kind).alias(name) for name, kind in output])
    found = F.when(~framed, none)
    for number, schema in writers.items():
        found = found.when(schema_id == number, decode_body(body, schema, output))
    return found.otherwise(decode_body(body, default, output))


def encode_frame(schema_json: str, schema_id: int, record: list[tuple[str, Column, bool]]) -> Column:
    """Header and record of (name, value, required) fields; null where a required one is missing."""
    header = F.unhex(F.lit(f"00{schema_id & 0xFFFFFFFF:08X}"))
    complete = F.lit(True)
    for _, value, required in record:
        complete = complete & value.isNotNull() if required else complete
    body = to_avro(F.struct(*[value.alias(name) for name, value, _ in record]), schema_json)
    return F.when(complete, F.concat(header, body))
