"""Writer-schema resolution, done once on the driver.

Schema ids and subjects come as plain mappings (exported from whatever registry is in use), so no
task ever makes a network call per record.
"""

from __future__ import annotations

import json
from collections.abc import Mapping

from pyspark.sql import SparkSession

from tidemark.functions.frames import FrameDecoder
from tidemark.schemas import LATEST_VERSION, avro_schema


def schema_for_topic(
    topic: str, subjects: Mapping[str, str] | None = None, fallback: str | None = None
) -> tuple[str, str]:
    """Latest schema registered for a topic's values, else the fallback; with where it came from."""
    found = (subjects or {}).get(f"{topic}-value")
    if found:
        return found, "registry"
    return fallback or avro_schema(LATEST_VERSION), "local"


def read_schema_file(spark: SparkSession, path: str) -> str:
    """Avro JSON from a local or shared path."""
    text = spark.read.text(path, wholetext=True).first()
    if text is None:
        raise FileNotFoundError(path)
    return json.dumps(json.loads(text[0]))


def read_writer_schemas(spark: SparkSession, path: str) -> dict[int, str]:
    """Schema id to Avro JSON, from a JSON object whose values are schemas (or their text)."""
    found = json.loads(read_schema_file(spark, path))
    if not isinstance(found, dict) or not all(str(k).lstrip("-").isdigit() for k in found):
        raise ValueError(f"{path} must map schema ids to schemas")
    return {int(k): v if isinstance(v, str) else json.dumps(v) for k, v in found.items()}


def event_decoder(
    writers: Mapping[int, str] | None = None, default: str | None = None
) -> FrameDecoder:
    """Decoder by registered schema id; ids outside ``writers`` are read by the topic's latest schema.

    Ids say nothing about versions: a registry counts them as schemas are registered.
    """
    return FrameDecoder(writers or {}, default or avro_schema(LATEST_VERSION))
