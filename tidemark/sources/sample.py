"""Adapter: the generic ``events`` test table seen as ad events, payload texts and topic records."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.events import with_parsed
from tidemark.functions.frames import FrameDecoder, encode_frame
from tidemark.schemas import DEFAULT_TOPIC, LATEST_VERSION, PAYLOAD_COLUMNS, avro_schema
from tidemark.sources.registry import event_decoder
from tidemark.sources.topic import topic_partition

TOPIC_PARTITIONS = 3
EVENT_VERSIONS = (1, 2, 3)

EVENT_EXPRESSIONS = (
    "cast(event_id as string) as event_id",
    "date_format(ts, \"yyyy-MM-dd'T'HH:mm:ss.SSSSSS\") || '+00:00' as event_time",
    "cast(user_id as string) as user_id",
    "cast(user_id % 100 + 1 as int) as campaign_id",
    "cast(event_id % 500 + 1 as int) as ad_id",
    "element_at(array('mobile', 'desktop', 'tablet'), "
    "cast(get_json_object(props, '$.k') as int) % 3 + 1) as device",
    "element_at(array('US', 'DE', 'GH', 'TG', 'AD'), cast(user_id % 5 as int) + 1) as country",
    "event_type",
    "case when event_id % 10 < 3 then null else concat('cr-', event_id % 97) end as ad_creative_id",
    "case when event_id % 10 = 0 then null "
    "else cast((event_id % 101) / 100.0 as float) end as engagement_score",
    "element_at(array('premium', 'basic', 'free'), cast(user_id % 3 as int) + 1) as user_segment",
    "case when event_type = 'purchase' then value end as conversion_value",
    "case when event_id % 20 < 3 then null else cast(event_id % 181 - 90 as double) end as geo_latitude",
    "ts as event_timestamp",
    "to_date(ts) as event_date",
)


def version_decoder() -> FrameDecoder:
    """For frames of this module, whose schema ids are the event versions."""
    return event_decoder({version: avro_schema(version) for version in EVENT_VERSIONS})


def driver_events(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/events.parquet")


def ad_events(spark: SparkSession, folder: str) -> DataFrame:
    """The 13 payload fields plus event time and date, one row per driver event."""
    return shape_events(driver_events(spark, folder))


def shape_events(events: DataFrame) -> DataFrame:
    return events.selectExpr(*EVENT_EXPRESSIONS)


def arrival_time() -> Column:
    """When an event reached us: three minutes late per unit of its ``value``."""
    return F.col("ts") + F.make_dt_interval(mins=F.floor(F.col("value") * 3).cast("int"))


def with_copies(events: DataFrame) -> DataFrame:
    """Driver events plus a copy of every purchase, sent again with an event time one hour earlier.

    ``copy`` tells them apart and ``position`` orders all of them.
    """
    again = events.where(F.col("event_type") == "purchase")
    copies = again.withColumn("ts", F.col("ts") - F.expr("INTERVAL 1 HOUR"))
    both = events.withColumn("copy", F.lit(0)).unionByName(copies.withColumn("copy", F.lit(1)))
    return both.withColumn("position", F.col("event_id") * 2 + F.col("copy"))


def payload_records(events: DataFrame) -> DataFrame:
    """Decoded records with JSON payloads, some of them spoilt in every way parsing tells apart.

    ``events`` come from ``with_copies``. Event ids that leave 0 to 3 when divided by 97 get no
    payload, a blank one, one that is not JSON, or one without a campaign.
    """
    shaped = events.selectExpr("event_id as n", "position", *EVENT_EXPRESSIONS)
    fault = F.col("n") % 97
    campaign = F.when(fault != 3, F.col("campaign_id"))
    fields = [campaign.alias(c) if c == "campaign_id" else F.col(c) for c in PAYLOAD_COLUMNS]
    text = (
        F.when(fault == 0, F.lit(None))
        .when(fault == 1, F.lit("  "))
        .when(fault == 2, F.lit("not json"))
        .otherwise(F.to_json(F.struct(*fields)))
    )
    key = F.col("user_id").cast("binary")
    records = shaped.select(
        F.lit(DEFAULT_TOPIC).alias("kafka_topic"),
        topic_partition(key, TOPIC_PARTITIONS).alias("kafka_partition"),
        F.col("position").alias("kafka_offset"),
        F.col("event_timestamp").cast("timestamp").alias("kafka_timestamp"),
        F.lit(0).alias("kafka_timestamp_type"),
        key.alias("key"),
        F.lit(None).cast("binary").alias("value"),
        text.alias("deserialized_payload"),
    )
    return with_parsed(records)


def topic_records(
    events: DataFrame, version: int = LATEST_VERSION, arrival: str = "ts"
) -> DataFrame:
    """Framed topic records of the driver's events, for batch or stream.

    Error events carry broken frames: no value, a wrong first byte, or a body cut short.
    """
    shaped = events.selectExpr("event_id as n", f"{arrival} as arrived", *EVENT_EXPRESSIONS)
    frame = encode_frame(avro_schema(version), version)
    framed = shaped.withColumn("frame", frame)
    cut = F.substring("frame", 1, 9)
    spoilt = (
        F.when(F.col("event_type") != "error", F.col("frame"))
        .when(F.col("device") == "desktop", F.concat(F.unhex(F.lit("01")), F.col("frame")))
        .when(F.col("device") == "tablet", cut)
    )
    return framed.select(
        F.col("user_id").cast("binary").alias("key"),
        spoilt.alias("value"),
        F.lit(DEFAULT_TOPIC).alias("topic"),
        topic_partition(F.col("user_id").cast("binary"), TOPIC_PARTITIONS).alias("partition"),
        F.col("n").alias("offset"),
        F.col("arrived").cast("timestamp").alias("timestamp"),
        F.lit(0).alias("timestampType"),
    )
