"""Read a record topic as a stream, and publish events to one."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.functions.frames import encode_frame
from tidemark.operators.ingest import accepted
from tidemark.schemas import (
    DEFAULT_TOPIC,
    LATEST_VERSION,
    TOPIC_SCHEMA,
    avro_schema,
)
from tidemark.session import shared_dir


@dataclass(frozen=True)
class TopicSource:
    """A broker topic. Needs Spark's Kafka connector on the classpath.

    By default nothing is capped, and a query fails if records it has not read are gone.
    """

    servers: str
    topic: str = DEFAULT_TOPIC
    starting_offsets: str = "earliest"
    max_offsets: int | None = None
    fail_on_data_loss: bool = True
    client: dict[str, str] = field(
        # Client time-outs in milliseconds.
        default_factory=lambda: {
            "kafka.session.timeout.ms": "30000",
            "kafka.request.timeout.ms": "40000",
            "kafka.max.poll.interval.ms": "300000",
        }
    )

    def options(self) -> dict[str, str]:
        chosen = {
            "kafka.bootstrap.servers": self.servers,
            "subscribe": self.topic,
            "startingOffsets": self.starting_offsets,
            "failOnDataLoss": str(self.fail_on_data_loss).lower(),
            **self.client,
        }
        if self.max_offsets is not None:
            chosen["maxOffsetsPerTrigger"] = str(self.max_offsets)
        return chosen


@dataclass(frozen=True)
class FileSource:
    """Parquet files with the topic's seven columns, standing in for a topic."""

    path: str
    max_files: int | None = None


def read_event_stream(spark: SparkSession, source: TopicSource | FileSource) -> DataFrame:
    """Unbounded records with key, value, topic, partition, offset, timestamp and timestampType."""
    if isinstance(source, TopicSource):
        records = spark.readStream.format("kafka").options(**source.options()).load()
        return records.select(*TOPIC_SCHEMA.fieldNames())
    reader = spark.readStream.schema(TOPIC_SCHEMA)
    if source.max_files is not None:
        reader = reader.option("maxFilesPerTrigger", source.max_files)
    return reader.parquet(source.path)


def topic_partition(key: Column, partitions: int) -> Column:
    """Partition of a key: CRC-32 modulo the partition count, as the usual C client places it."""
    return F.pmod(F.crc32(key), F.lit(partitions)).cast("int")


def keyed(
    events: DataFrame, partitions: int, topic: str = DEFAULT_TOPIC, version: int = LATEST_VERSION
) -> DataFrame:
    """Accepted events with the topic, key and partition they go to; a user stays in one partition.

    Events that break a constraint are not published; ``with_violations`` reports them.
    """
    key = F.col("user_id").cast("binary")
    return accepted(events, version).select(
        "*",
        key.alias("key"),
        F.lit(topic).alias("topic"),
        topic_partition(key, partitions).alias("partition"),
    )


def frames(
    events: DataFrame, partitions: int, topic: str = DEFAULT_TOPIC, version: int = LATEST_VERSION
) -> DataFrame:
    """Accepted events as framed records."""
    value = encode_frame(avro_schema(version), version).alias("value")
    return keyed(events, partitions, topic, version).select(
        "key", value, "topic", "partition", "event_id", "event_timestamp"
    )


def numbered(records: DataFrame, by: str, order: tuple[str, ...], name: str) -> DataFrame:
    """Number the records of each value of ``by`` from zero, in the given order.

    A topic has few partitions, and one user may have a third of all records, so ranking each value in a
    window would put it into a single task. Instead all records are range-sorted once, kept in the shared
    folder (a second sort could cut its ranges elsewhere), and numbered within each range; one row per
    range and value then says how many records of the value came before it.
    """
    shared_dir(records.sparkSession)
    placed = records.orderBy(by, *order).withColumn("_row", F.monotonically_increasing_id()).checkpoint()
    ranged = placed.withColumn("_range", F.shiftright("_row", 33))
    runs = ranged.groupBy(by, "_range").agg(F.count(F.lit(1)).alias("_n"), F.min("_row").alias("_first"))
    # One row per sort range and value, so the window stays small.
    earlier = Window.partitionBy(by).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    bases = runs.withColumn("_base", F.coalesce(F.sum("_n").over(earlier), F.lit(0)))
    joined = ranged.join(bases, [by, "_range"])
    return joined.select(*records.columns, (F.col("_base") + F.col("_row") - F.col("_first")).alias(name))


def with_offsets(records: DataFrame, order: tuple[str, ...]) -> DataFrame:
    """Records with their offsets in their topic partitions."""
    return numbered(records, "partition", order, "offset")


def in_user_order(records: DataFrame) -> DataFrame:
    """All records of a key in one task, by event time."""
    return records.repartition("key").sortWithinPartitions("key", "event_timestamp", "event_id")


def publish(
    events: DataFrame,
    target: TopicSource | FileSource,
    partitions: int | None = None,
    topic: str = DEFAULT_TOPIC,
    version: int = LATEST_VERSION,
    options: dict[str, str] | None = None,
) -> None:
    """Write events to a topic, or to Parquet files shaped like one (then of three partitions, if none are given).

    A user's events leave one task in order of time. Without ``partitions``, which must be the topic's own
    number, the broker's client places each key. ``options`` are handed to the producer.
    """
    if isinstance(target, TopicSource):
        records = in_user_order(frames(events, partitions or 1, topic, version))
        columns = ["key", "value", "topic", *(["partition"] if partitions else [])]
        out = records.select(*columns).write.format("kafka").options(**(options or {}))
        out.option("kafka.bootstrap.servers", target.servers).save()
        return
    partitions = partitions or 3
    # Numbered before they are encoded, as the sort reads its input twice.
    numbered = with_offsets(keyed(events, partitions, topic, version), ("event_timestamp", "event_id"))
    shaped = numbered.select(
        "key",
        encode_frame(avro_schema(version), version).alias("value"),
        "topic",
        "partition",
        "offset",
        F.current_timestamp().alias("timestamp"),
        F.lit(0).alias("timestampType"),
    )
    shaped.write.mode("append").parquet(target.path)
