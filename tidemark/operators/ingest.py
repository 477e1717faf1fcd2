"""Row-level steps from a topic record to a curated event."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.events import (
    event_time_of,
    is_valid_event,
    parse_status,
    violations,
    with_parsed,
)
from tidemark.functions.frames import FrameDecoder, frame_status
from tidemark.schemas import CURATED, LATE_AFTER, LATEST_VERSION, PAYLOAD_COLUMNS, PAYLOAD_SCHEMA, RAW

# Earliest copy of an event wins; the record position settles equal times.
POSITION = ("kafka_topic", "kafka_partition", "kafka_offset")

ENVELOPE = {
    "topic": "kafka_topic",
    "partition": "kafka_partition",
    "offset": "kafka_offset",
    "timestamp": "kafka_timestamp",
    "timestampType": "kafka_timestamp_type",
}


def envelope(records: DataFrame) -> DataFrame:
    """Topic columns under their table names, with key and value."""
    renamed = [F.col(old).alias(new) for old, new in ENVELOPE.items()]
    return records.select(*renamed, "key", "value")


def decode_records(records: DataFrame, decoder: FrameDecoder) -> DataFrame:
    """Envelope, payload text and parsed struct of every record."""
    frames = envelope(records).withColumn("frame", decoder.decode(F.col("value")))
    texts = frames.withColumn("deserialized_payload", decoder.payload_json(F.col("frame")))
    return with_parsed(texts.drop("frame"))


def frame_failures(records: DataFrame, decoder: FrameDecoder) -> DataFrame:
    """Record counts by decode outcome."""
    status = frame_status(F.col("value"))
    decoded = decoder.decode(F.col("value"))["decoded"]
    outcome = F.when(status != "framed", status).when(decoded, "decoded").otherwise("decode_error")
    return records.select(outcome.alias("outcome")).groupBy("outcome").agg(F.count(F.lit(1)).alias("records"))


def stamp(batch_id: int, ingested_at: datetime | Column | None) -> list[Column]:
    """Audit columns of one batch. A literal time stays the same if a task is run again."""
    if ingested_at is None:
        moment = F.current_timestamp()
    elif isinstance(ingested_at, Column):
        moment = ingested_at
    else:
        moment = F.lit(ingested_at)
    return [F.lit(int(batch_id)).cast("long").alias("ingestion_batch_id"), moment.alias("ingested_at")]


def raw_records(
    parsed: DataFrame, batch_id: int, ingested_at: datetime | Column | None = None, hidden: bool = False
) -> DataFrame:
    """Every record with its parse status, in the raw table's shape, on request with the hidden event date."""
    status = parse_status(F.col("deserialized_payload"), F.col("data"))
    # A record without an event has its own date, so that it does not keep a file from being skipped.
    happened = F.coalesce(F.to_date(event_time_of(F.col("data.event_time"))), F.to_date("kafka_timestamp"))
    return parsed.select(
        "*",
        status.alias("parse_status"),
        F.to_date("kafka_timestamp").alias("kafka_date"),
        *stamp(batch_id, ingested_at),
        happened.alias("event_date"),
    ).select(*RAW.columns, *(["event_date"] if hidden else []))


def valid_events(parsed: DataFrame, *keep: str) -> DataFrame:
    """Expand the struct, derive the event time and keep rows that can be curated."""
    events = parsed.where(F.col("data").isNotNull()).select("data.*", *keep)
    return events.withColumn("event_timestamp", event_time_of(F.col("event_time"))).where(is_valid_event())


def dedupe(events: DataFrame, key: str = "event_id", order: tuple[str, ...] = ()) -> DataFrame:
    """One row per key: the least by ``order``, then by the remaining columns.

    An aggregate, not a ranked window: copies are combined before the shuffle, so a key with very
    many copies never gathers in one task.
    """
    others = [c for c in events.columns if c != key and c not in order]
    ranked = [*[c for c in order if c != key], *others]
    first = F.min(F.struct(*ranked)).alias("first")
    return events.groupBy(key).agg(first).select(key, "first.*").select(*events.columns)


def dedupe_any(events: DataFrame, key: str = "event_id") -> DataFrame:
    """One arbitrary row per key."""
    return events.dropDuplicates([key])


def curated_events(
    events: DataFrame, batch_id: int, ingested_at: datetime | Column | None = None
) -> DataFrame:
    """De-duplicated events in the curated table's shape."""
    order = ("event_timestamp", *[c for c in POSITION if c in events.columns])
    return dedupe(events, "event_id", order).select(*curated_columns(), *stamp(batch_id, ingested_at))


def curated_columns() -> list[Column]:
    """Curated columns computed from a valid event, audit columns aside."""
    derived = {
        "event_time": F.col("event_timestamp"),
        "campaign_id": F.col("campaign_id").try_cast("int"),
        "ad_id": F.col("ad_id").try_cast("int"),
        "event_date": F.to_date("event_timestamp"),
    }
    audit = ("ingestion_batch_id", "ingested_at")
    return [derived.get(c, F.col(c)).alias(c) for c in CURATED.columns if c not in audit]


def upcast(events: DataFrame) -> DataFrame:
    """Rows of an older event version in the newest version's shape; missing fields are null."""
    return events.select(
        *[
            (F.col(f.name) if f.name in events.columns else F.lit(None)).cast(f.dataType).alias(f.name)
            for f in PAYLOAD_SCHEMA
        ]
    )


def with_violations(events: DataFrame, version: int = LATEST_VERSION) -> DataFrame:
    """Add ``violations``; an event is acceptable when the array is empty."""
    return events.withColumn("violations", violations(version))


def accepted(events: DataFrame, version: int = LATEST_VERSION) -> DataFrame:
    """Events that break no constraint."""
    return events.where(F.size(violations(version)) == 0)


def violation_counts(events: DataFrame, version: int = LATEST_VERSION) -> DataFrame:
    """Events per broken rule."""
    broken = events.select(F.explode(violations(version)).alias("rule"))
    return broken.groupBy("rule").agg(F.count(F.lit(1)).alias("events"))


def is_late(arrival: str, event_time: str = "event_timestamp", after: str = LATE_AFTER) -> Column:
    """Arrived more than ``after`` later than it happened."""
    return F.col(arrival) > F.col(event_time) + F.expr(f"INTERVAL {after}")


def split_late(events: DataFrame, arrival: str, after: str = LATE_AFTER) -> tuple[DataFrame, DataFrame]:
    """(on time, late). Rows whose arrival is unknown count as on time, so none are lost."""
    late = F.coalesce(is_late(arrival, after=after), F.lit(False))
    return events.where(~late), events.where(late)


def undecodable(raw: DataFrame) -> DataFrame:
    """Raw records without a usable event; binary columns as hex text."""
    rejected = raw.where(F.col("parse_status") != "parsed")
    return rejected.withColumns({"key": F.hex("key"), "value": F.hex("value")})


def write_quarantine(raw: DataFrame, path: str, batch_id: int) -> None:
    """Rejected records as JSON lines, in one folder per batch that a replay writes anew."""
    undecodable(raw).write.mode("overwrite").json(f"{path.rstrip('/')}/batch={batch_id}")


def quality_counts() -> list[Column]:
    """Total, valid and corrupted records of parsed ones, as aggregates to observe or to compute."""
    data = F.col("data")
    fields = {"event_timestamp": event_time_of(data["event_time"])}
    total, valid = F.count(F.lit(1)), F.count_if(is_valid_event(lambda name: fields.get(name) if name in fields else data[name]))
    return [total.alias("total"), valid.alias("valid"), (total - valid).alias("corrupted")]


def batch_quality(parsed: DataFrame) -> DataFrame:
    """One row: total, valid and corrupted records, in a single pass."""
    return parsed.agg(*quality_counts())
