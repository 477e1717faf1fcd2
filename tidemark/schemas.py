"""Event, topic and table schemas, and the constants every job shares."""

from __future__ import annotations

import json
from dataclasses import dataclass, replace

from pyspark.sql import types as T

# --- Fixed values: event semantics -------------------------------------------------------------
CLICK_EVENT_TYPES = ("click",)
CONVERSION_EVENT_TYPES = ("purchase",)
WATERMARK_DELAY = "2 hours"
METRIC_WINDOW = "30 seconds"
STATS_WINDOW = "5 minutes"
TRIGGER_INTERVAL = "30 seconds"
LATE_AFTER = "2 hours"
DEFAULT_TOPIC = "ads_events"
LATEST_VERSION = 3

# --- Fixed values: the event record, as (field, wire type, nullable on the wire, since version) --
EVENT_FIELDS = (
    ("event_id", "string", False, 1),
    ("event_time", "string", False, 1),
    ("user_id", "string", False, 1),
    ("campaign_id", "int", False, 1),
    ("ad_id", "int", False, 1),
    ("device", "string", False, 1),
    ("country", "string", False, 1),
    ("event_type", "string", False, 1),
    ("ad_creative_id", "string", True, 1),
    ("engagement_score", "float", True, 2),
    ("user_segment", "string", True, 3),
    ("conversion_value", "double", True, 3),
    ("geo_latitude", "double", True, 3),
)

SPARK_TYPES = {
    "string": T.StringType(),
    "int": T.IntegerType(),
    "long": T.LongType(),
    "float": T.FloatType(),
    "double": T.DoubleType(),
    "boolean": T.BooleanType(),
}


def payload_schema(version: int = LATEST_VERSION) -> T.StructType:
    """Struct that a JSON payload is parsed with; every field is nullable."""
    return T.StructType(
        [T.StructField(n, SPARK_TYPES[t], True) for n, t, _, since in EVENT_FIELDS if since <= version]
    )


def avro_schema(version: int = LATEST_VERSION) -> str:
    """Writer schema of one event version as Avro JSON."""
    fields = [
        {"name": n, "type": ["null", t], "default": None} if optional else {"name": n, "type": t}
        for n, t, optional, since in EVENT_FIELDS
        if since <= version
    ]
    return json.dumps({"type": "record", "name": "AdEvent", "namespace": "ads", "fields": fields})


PAYLOAD_SCHEMA = payload_schema()
PAYLOAD_COLUMNS = PAYLOAD_SCHEMA.fieldNames()
REQUIRED_FIELDS = [n for n, _, optional, _ in EVENT_FIELDS if not optional]

# What a topic source delivers; the file stand-in carries the same seven columns.
TOPIC_SCHEMA = T.StructType(
    [
        T.StructField("key", T.BinaryType()),
        T.StructField("value", T.BinaryType()),
        T.StructField("topic", T.StringType()),
        T.StructField("partition", T.IntegerType()),
        T.StructField("offset", T.LongType()),
        T.StructField("timestamp", T.TimestampType()),
        T.StructField("timestampType", T.IntegerType()),
    ]
)


@dataclass(frozen=True)
class Level:
    """A further partition column, computed from others by every writer and not part of what readers see.

    Values are whole numbers from 0 on. ``transform`` says the same to catalogs that partition by hidden
    transforms and need no column for it.
    """

    name: str
    of: tuple[str, ...]  # columns that decide it
    expression: str
    transform: str


@dataclass(frozen=True)
class TableSpec:
    """Contract of one table: ordered columns, natural key and partition column; and how it is laid out.

    ``hidden`` columns are stored but not part of the contract. Rows of a file are in order of ``cluster``,
    and ``bloom`` columns have filters that let a lookup of a few values skip most row groups.
    """

    name: str
    ddl: str
    key: tuple[str, ...]
    partition: str
    hidden: str = ""
    levels: tuple[Level, ...] = ()
    cluster: tuple[str, ...] = ()
    bloom: tuple[str, ...] = ()

    @property
    def schema(self) -> T.StructType:
        return T.StructType.fromDDL(self.ddl)

    @property
    def stored(self) -> T.StructType:
        """Contract and hidden columns, without levels."""
        return T.StructType.fromDDL(", ".join(filter(None, (self.ddl, self.hidden))))

    @property
    def columns(self) -> list[str]:
        return [column.split()[0] for column in self.ddl.split(",")]

    @property
    def unseen(self) -> set[str]:
        """Stored columns that readers do not ask for."""
        return {level.name for level in self.levels} | {f.name for f in self.stored} - set(self.columns)


# An event id says nothing about its date, so its hash picks one of so many folders of each day.
KEY_BUCKETS = 8


def by_id(column: str, buckets: int = KEY_BUCKETS) -> Level:
    return Level("id_bucket", (column,), f"pmod(xxhash64({column}), {buckets})", f"bucket({buckets}, {column})")


# --- Fixed values: table names, columns, keys and partitions --------------------------------------
RAW = TableSpec(
    "raw_ad_events",
    "kafka_topic STRING, kafka_partition INT, kafka_offset BIGINT, kafka_timestamp TIMESTAMP, "
    "kafka_timestamp_type INT, key BINARY, value BINARY, deserialized_payload STRING, "
    "parse_status STRING, kafka_date DATE, ingestion_batch_id BIGINT, ingested_at TIMESTAMP",
    ("kafka_topic", "kafka_partition", "kafka_offset"),
    "kafka_date",
    # Date of the event inside, or of the record where there is none: a zone map for readers that want one day.
    hidden="event_date DATE",
    cluster=("event_date",),
)

CURATED = TableSpec(
    "ad_events",
    "event_id STRING, event_time TIMESTAMP, user_id STRING, campaign_id INT, ad_id INT, "
    "device STRING, country STRING, event_type STRING, ad_creative_id STRING, "
    "engagement_score FLOAT, user_segment STRING, conversion_value DOUBLE, geo_latitude DOUBLE, "
    "event_timestamp TIMESTAMP, event_date DATE, ingestion_batch_id BIGINT, ingested_at TIMESTAMP",
    ("event_id",),
    "event_date",
    levels=(by_id("event_id"),),
    cluster=("event_id",),
    bloom=("event_id",),
)

LATE = replace(CURATED, name="ad_events_late")

METRICS = TableSpec(
    "campaign_conversion_metrics",
    "window_start TIMESTAMP, window_end TIMESTAMP, window_date DATE, campaign_id INT, "
    "clicks BIGINT, conversions BIGINT, attributed_conversions BIGINT, orphan_conversions BIGINT, "
    "conversion_rate DOUBLE, aggregation_time TIMESTAMP",
    ("campaign_id", "window_start", "window_end"),
    "window_date",
    # Set by jobs that count a window from all stored events, which no live total may replace.
    hidden="reconciled BOOLEAN",
    levels=(Level("window_hour", ("window_start",), "hour(window_start)", "hours(window_start)"),),
)

STATS = TableSpec(
    "ad_events_aggregation",
    "window_start TIMESTAMP, window_end TIMESTAMP, event_type STRING, device STRING, "
    "event_count BIGINT, aggregation_time TIMESTAMP, aggregation_date DATE",
    ("window_start", "event_type", "device", "aggregation_time"),
    "aggregation_date",
)

ALL_TABLES = (RAW, CURATED, LATE, METRICS, STATS)
