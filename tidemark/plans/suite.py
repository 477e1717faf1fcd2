"""Registered queries: every operator run over the whole driver tables.

Queries that write do so in a database of their own below the shared folder.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from contextlib import contextmanager
from datetime import date, datetime, timezone
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.frames import encode_frame, frame_schema_id
from tidemark.operators import ingest, metrics, tables
from tidemark.plans import reconcile, reports, sqlfile
from tidemark.schemas import (
    CURATED,
    LATE,
    METRICS,
    PAYLOAD_COLUMNS,
    RAW,
    STATS,
    TOPIC_SCHEMA,
    WATERMARK_DELAY,
    TableSpec,
    avro_schema,
    payload_schema,
)
from tidemark.session import hadoop_path, pin_session, scratch_path
from tidemark.sources import sample
from tidemark.sources.registry import event_decoder
from tidemark.sources.topic import FileSource, frames, keyed, numbered, publish, read_event_stream, with_offsets
from tidemark.streaming import queries as streams
from tidemark.streaming.progress import TriggerLog, read_state

Query = Callable[[SparkSession, str], DataFrame]

DAY = date(2024, 1, 10)
EMPTY_DAY = date(2024, 1, 12)
RANGE = (datetime(2024, 1, 5, 6, 0, 10), datetime(2024, 1, 20, 18, 0, 20))
DATES = (date(2024, 1, 5), date(2024, 1, 20))
AS_OF = datetime(2024, 1, 20)
LOADED_AT = datetime(2024, 2, 1, tzinfo=timezone.utc)

REGISTRY: dict[str, Query] = {}


def query(function: Query) -> Query:
    """Register under the function's name; sessions are pinned to UTC."""

    def run(spark: SparkSession, folder: str) -> DataFrame:
        return plain_times(function(pin_session(spark), folder))

    REGISTRY[function.__name__] = run
    return function


def plain_times(result: DataFrame) -> DataFrame:
    """UTC instants as zone-less timestamps, the way the driver's tables hold them."""
    return result.select(
        *[
            F.col(f.name).cast("timestamp_ntz").alias(f.name) if isinstance(f.dataType, T.TimestampType)
            else F.col(f.name)
            for f in result.schema
        ]
    )


def workspace(spark: SparkSession, *specs: TableSpec) -> tuple[tables.Warehouse, str]:
    """Empty tables in a new database, and the folder they live in."""
    location = scratch_path(spark, "lake")
    database = f"tidemark_{uuid.uuid4().hex[:12]}"
    return tables.create_tables(spark, database, location, specs), location


def events_of(spark: SparkSession, folder: str) -> DataFrame:
    return sample.ad_events(spark, folder)


def curated_sample(spark: SparkSession, folder: str, batch: int = 0) -> DataFrame:
    """All sample events in the curated table's shape."""
    events = events_of(spark, folder).withColumn("event_timestamp", F.col("event_timestamp").cast("timestamp"))
    return events.select(*ingest.curated_columns(), *ingest.stamp(batch, LOADED_AT))


def payloads(spark: SparkSession, folder: str) -> DataFrame:
    return sample.payload_records(sample.with_copies(sample.driver_events(spark, folder)))


def raw_days(spark: SparkSession, folder: str) -> DataFrame:
    """Raw rows as if one batch had been ingested per day; copies come two batches later."""
    raw = ingest.raw_records(payloads(spark, folder), 0, LOADED_AT, hidden=True)
    return raw.withColumn(
        "ingestion_batch_id",
        F.dayofmonth("kafka_timestamp").cast("long") + F.pmod(F.col("kafka_offset"), F.lit(2)) * 2,
    )


def stats_sample(spark: SparkSession, folder: str) -> DataFrame:
    """Five-minute statistics, published when each window closes."""
    return metrics.device_stats(events_of(spark, folder), aggregation_time=F.col("bucket.end"))


# --- metrics and statistics ----------------------------------------------------------------------


@query
def campaign_metrics_30s(spark, folder):
    return metrics.campaign_metrics(events_of(spark, folder)).drop("aggregation_time")


@query
def campaign_metrics_1d(spark, folder):
    return metrics.campaign_metrics(events_of(spark, folder), "1 day").drop("aggregation_time")


@query
def device_stats_5m(spark, folder):
    counts = metrics.device_stats(events_of(spark, folder)).drop("aggregation_time", "aggregation_date")
    return counts.withColumn("window_date", F.to_date("window_start"))


@query
def latest_snapshot(spark, folder):
    """Every window is published half way and when it closes; the closing count must remain."""
    events = events_of(spark, folder)
    second = F.unix_micros(F.col("event_timestamp").cast("timestamp")) % 300_000_000
    half_time = F.col("bucket.start") + F.expr("INTERVAL 150 SECONDS")
    early = metrics.device_stats(events.where(second < 150_000_000), aggregation_time=half_time)
    final = metrics.device_stats(events, aggregation_time=F.col("bucket.end"))
    return metrics.latest_snapshot(early.unionByName(final))


# --- parsing and curation ------------------------------------------------------------------------


@query
def parse_status_counts(spark, folder):
    return reports.parse_status_counts(ingest.raw_records(payloads(spark, folder), 0))


@query
def raw_records(spark, folder):
    raw = ingest.raw_records(payloads(spark, folder), 7)
    return raw.select("kafka_topic", "kafka_offset", "kafka_date", "parse_status", "ingestion_batch_id")


@query
def valid_events(spark, folder):
    return ingest.valid_events(payloads(spark, folder)).select("event_id", "campaign_id", "event_timestamp")


@query
def curated_events(spark, folder):
    events = ingest.valid_events(payloads(spark, folder), *ingest.POSITION)
    return ingest.curated_events(events, 1).drop("ingested_at")


@query
def dedupe_events(spark, folder):
    events = sample.shape_events(sample.with_copies(sample.driver_events(spark, folder)))
    return ingest.dedupe(events, "event_id", ("event_timestamp",))


@query
def dedupe_any(spark, folder):
    events = sample.shape_events(sample.with_copies(sample.driver_events(spark, folder)))
    return ingest.dedupe_any(events).select("event_id", "user_id", "event_type")


@query
def batch_quality(spark, folder):
    return ingest.batch_quality(payloads(spark, folder))


def _spoilt_events(spark, folder) -> DataFrame:
    """Events that break each rule: scores follow ``value``, errors lack a device, and so on."""
    shaped = sample.driver_events(spark, folder).selectExpr("value", *sample.EVENT_EXPRESSIONS)
    kind = F.col("event_type")
    return shaped.withColumns(
        {
            "engagement_score": (F.floor(F.col("value")) / 100).cast("float"),
            "conversion_value": F.when(kind == "purchase", F.floor(F.col("value")) - 10.0),
            "device": F.when(kind != "error", F.col("device")),
            "event_time": F.when(kind == "signup", F.lit("soon")).otherwise(F.col("event_time")),
        }
    )


@query
def validation_report(spark, folder):
    return ingest.violation_counts(_spoilt_events(spark, folder))


@query
def validated_events(spark, folder):
    checked = ingest.with_violations(_spoilt_events(spark, folder))
    return checked.select("event_id", F.array_join("violations", ",").alias("violations"))


@query
def accepted_events_v1(spark, folder):
    """Version 1 knows neither scores nor values, so only missing and unreadable fields count."""
    return ingest.accepted(_spoilt_events(spark, folder), version=1).select("event_id", "event_type")


@query
def lateness_split(spark, folder):
    events = sample.driver_events(spark, folder).withColumn("arrival", sample.arrival_time())
    events = events.selectExpr("arrival", *sample.EVENT_EXPRESSIONS)
    on_time, late = ingest.split_late(events, "arrival")
    both = on_time.withColumn("late", F.lit(0)).unionByName(late.withColumn("late", F.lit(1)))
    return both.select("event_id", "event_timestamp", "arrival", "late")


@query
def upcast_v1(spark, folder):
    old = events_of(spark, folder).select(*payload_schema(1).fieldNames())
    return ingest.upcast(old)


@query
def quarantine(spark, folder):
    path = scratch_path(spark, "quarantine")
    ingest.write_quarantine(ingest.raw_records(payloads(spark, folder), 3), path, 3)
    rejected = spark.read.schema(
        "kafka_topic STRING, kafka_offset BIGINT, key STRING, parse_status STRING, ingestion_batch_id BIGINT"
    ).json(path)
    return rejected.select("kafka_topic", "kafka_offset", "key", "parse_status", "ingestion_batch_id")


# --- frames --------------------------------------------------------------------------------------


@query
def encode_frames(spark, folder):
    """Version 1 frames, byte for byte."""
    out = frames(events_of(spark, folder), sample.TOPIC_PARTITIONS, version=1)
    return out.select("event_id", F.decode("key", "utf-8").alias("key"), F.hex("value").alias("frame"))


@query
def encode_frames_v3(spark, folder):
    out = frames(events_of(spark, folder), sample.TOPIC_PARTITIONS)
    return out.select(
        "event_id",
        frame_schema_id(F.col("value")).alias("schema_id"),
        F.octet_length("value").cast("long").alias("frame_bytes"),
    )


@query
def decode_frames(spark, folder):
    """Every event written in all three versions, decoded by schema id."""
    events, decoder = events_of(spark, folder), sample.version_decoder()
    written = [frames(events, sample.TOPIC_PARTITIONS, version=v).select("value") for v in sample.EVENT_VERSIONS]
    together = reduce(DataFrame.unionByName, written)
    decoded = together.select(
        decoder.decode(F.col("value")).alias("frame"), frame_schema_id(F.col("value")).alias("version")
    )
    return decoded.select("frame.*", "version").select(*PAYLOAD_COLUMNS, "version")


@query
def decode_registry_ids(spark, folder):
    """A registry numbers schemas as they come: version 3 is id 1, version 1 is id 7, id 9 is not known."""
    events = events_of(spark, folder)
    decoder = event_decoder({1: avro_schema(3), 7: avro_schema(1)}, avro_schema(3))
    number = F.pmod(F.col("event_id").cast("long"), F.lit(3))
    written = [
        events.where(number == rest).select(encode_frame(avro_schema(version), schema_id).alias("value"))
        for rest, version, schema_id in ((0, 3, 1), (1, 1, 7), (2, 3, 9))
    ]
    together = reduce(DataFrame.unionByName, written)
    decoded = together.select(
        decoder.decode(F.col("value")).alias("frame"), frame_schema_id(F.col("value")).alias("schema_id")
    )
    return decoded.select("frame.*", "schema_id").select(*PAYLOAD_COLUMNS, "schema_id")


@query
def payload_round_trip(spark, folder):
    """Frame to JSON text to struct, the way ingest reads records."""
    records = sample.topic_records(sample.driver_events(spark, folder))
    parsed = ingest.decode_records(records, sample.version_decoder())
    return ingest.valid_events(parsed).select(*PAYLOAD_COLUMNS)


@query
def frame_outcomes(spark, folder):
    records = sample.topic_records(sample.driver_events(spark, folder))
    return ingest.frame_failures(records, sample.version_decoder())


@query
def publish_order(spark, folder):
    """Every event with its place among those of its user by offset, and whether the user stays in one partition."""
    out = keyed(events_of(spark, folder), sample.TOPIC_PARTITIONS)
    sent = with_offsets(out, ("event_timestamp", "event_id"))
    placed = numbered(sent, "user_id", ("partition", "offset"), "place")
    homes = sent.groupBy("user_id").agg((F.min("partition") == F.max("partition")).alias("one_partition"))
    return placed.join(homes, "user_id").select("user_id", "event_id", "place", "one_partition")


@query
def publish_offsets(spark, folder):
    """Publish all events to files: the partitions hold each one, numbered without a gap."""
    path = scratch_path(spark, "topic")
    publish(events_of(spark, folder), FileSource(path), sample.TOPIC_PARTITIONS)
    per_partition = spark.read.parquet(path).groupBy("partition").agg(
        F.count(F.lit(1)).alias("n"),
        F.count_distinct("offset").alias("d"),
        F.min("offset").alias("low"),
        F.max("offset").alias("high"),
    )
    gap_free = (F.col("n") == F.col("d")) & (F.col("low") == 0) & (F.col("high") == F.col("n") - 1)
    return per_partition.agg(F.sum("n").alias("events"), F.bool_and(gap_free).alias("gap_free"))


# --- tables --------------------------------------------------------------------------------------


@query
def upsert_events(spark, folder):
    """Correct every purchase (value doubled, one day later) and add a new event per signup."""
    lake, _ = workspace(spark, CURATED)
    first = curated_sample(spark, folder)
    tables.upsert_spec(first, lake, CURATED)
    kind = F.col("event_type")
    later = F.when(kind == "purchase", F.expr("INTERVAL 1 DAY")).otherwise(F.expr("INTERVAL 0 DAY"))
    moved = curated_sample(spark, folder, 1).where(kind.isin("purchase", "signup"))
    changes = moved.withColumns(
        {
            "event_id": F.when(kind == "signup", F.concat(F.lit("n-"), "event_id")).otherwise(F.col("event_id")),
            "conversion_value": F.col("conversion_value") * 2,
            "event_timestamp": F.col("event_timestamp") + later,
        }
    ).withColumn("event_date", F.to_date("event_timestamp"))
    tables.upsert_spec(changes, lake, CURATED)
    kept = lake.read(CURATED)
    return kept.select(
        "event_id", "event_type", "conversion_value", "event_timestamp", "event_date", "ingestion_batch_id"
    )


@query
def upsert_raw(spark, folder):
    """The same records delivered twice stay one row each, stamped by the later batch."""
    lake, _ = workspace(spark, RAW)
    for batch in (0, 1):
        rows = ingest.raw_records(payloads(spark, folder), batch, LOADED_AT, hidden=True)
        tables.upsert_spec(rows, lake, RAW, partition_follows_key=True)
    return lake.read(RAW).groupBy("kafka_date", "parse_status", "ingestion_batch_id").agg(
        F.count(F.lit(1)).alias("records")
    )


@query
def upsert_metrics(spark, folder):
    """Click-only day metrics, then full metrics from the tenth on."""
    lake, _ = workspace(spark, METRICS)
    events = events_of(spark, folder)
    clicks = metrics.campaign_metrics(events.where(F.col("event_type") == "click"), "1 day")
    tables.upsert_spec(clicks, lake, METRICS)
    recent = events.where(F.col("event_date") >= F.lit(DAY))
    full = metrics.campaign_metrics(recent, "1 day")
    tables.upsert_spec(full, lake, METRICS, keys_unique=True, partition_follows_key=True)
    return lake.read(METRICS).drop("aggregation_time")


@query
def replace_day(spark, folder):
    """Hourly metrics; one day replaced by clicks only, another by nothing."""
    lake, _ = workspace(spark, METRICS)
    events = events_of(spark, folder)
    hourly = metrics.campaign_metrics(events, "1 hour")
    tables.append(hourly, lake.name(METRICS))
    clicks = events.where((F.col("event_date") == F.lit(DAY)) & (F.col("event_type") == "click"))
    tables.replace_partition(metrics.campaign_metrics(clicks, "1 hour"), lake.name(METRICS), DAY)
    nothing = hourly.where(F.lit(False))
    tables.replace_partition(nothing, lake.name(METRICS), EMPTY_DAY)
    return lake.read(METRICS).drop("aggregation_time")


@query
def delete_day(spark, folder):
    lake, _ = workspace(spark, CURATED)
    tables.append(curated_sample(spark, folder), lake.name(CURATED))
    tables.delete_partition(spark, lake.name(CURATED), DAY)
    return reports.partition_stats(lake.read(CURATED))


@query
def schema_align(spark, folder):
    """A version 1 table gains the newer columns, then takes newer rows."""
    audit = "event_timestamp TIMESTAMP, event_date DATE"
    old_ddl = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in payload_schema(1))
    old_spec = TableSpec(CURATED.name, f"{old_ddl}, {audit}", CURATED.key, CURATED.partition)
    lake, _ = workspace(spark, old_spec)
    events = curated_sample(spark, folder).withColumn(
        "event_time", F.date_format("event_timestamp", "yyyy-MM-dd HH:mm:ss")
    )
    tables.append(events.where(F.col("event_date") < F.lit(DAY)), lake.name(CURATED))
    tables.evolve_curated(lake)
    tables.append(events.where(F.col("event_date") >= F.lit(DAY)), lake.name(CURATED))
    return lake.read(CURATED).drop("ingested_at", "ingestion_batch_id", "event_time")


# --- daily batch ---------------------------------------------------------------------------------


def _reconciled(spark, folder) -> tables.Warehouse:
    lake, _ = workspace(spark, RAW, CURATED, METRICS)
    tables.append(raw_days(spark, folder), lake.name(RAW))
    wrong = metrics.campaign_metrics(events_of(spark, folder).where(F.col("event_type") == "click"), "1 hour")
    tables.append(wrong, lake.name(METRICS))
    for _ in range(2):  # the second run must change nothing
        reconcile.reconcile_day(lake, DAY)
    return lake


@query
def reconcile_day(spark, folder):
    return _reconciled(spark, folder).read(METRICS).drop("aggregation_time")


@query
def reconcile_day_events(spark, folder):
    return _reconciled(spark, folder).read(CURATED).drop("ingested_at")


@query
def reconcile_job(spark, folder):
    """The daily job as its command line runs it, over tables that lie in a folder."""
    lake, location = workspace(spark, RAW, CURATED, METRICS)
    tables.append(raw_days(spark, folder), lake.name(RAW))
    wrong = metrics.campaign_metrics(events_of(spark, folder).where(F.col("event_type") == "click"), "1 hour")
    tables.append(wrong, lake.name(METRICS))
    flags = ["--date", DAY.isoformat(), "--database", lake.database, "--location", location, "--match-days", "2"]
    reconcile.run_job(spark, reconcile.arguments(flags))
    return lake.read(METRICS).drop("aggregation_time")


@query
def live_after_reconcile(spark, folder):
    """Live totals that come after a day was reconciled: they replace other days' windows, but none of that day."""
    lake, _ = workspace(spark, RAW, CURATED, METRICS)
    tables.append(raw_days(spark, folder), lake.name(RAW))
    readable = events_of(spark, folder).where(F.col("event_id").cast("long") % 97 > 3)
    tables.append(metrics.campaign_metrics(readable.where(F.col("event_type") == "purchase")), lake.name(METRICS))
    reconcile.reconcile_day(lake, DAY)
    clicks = metrics.campaign_metrics(readable.where(F.col("event_type") == "click"))
    streams.metrics_batch(clicks, 1, lake)
    return lake.read(METRICS).drop("aggregation_time")


@query
def recompute_range(spark, folder):
    """Metrics of purchases only, corrected between two moments inside a window each."""
    lake, _ = workspace(spark, CURATED, METRICS)
    tables.append(curated_sample(spark, folder), lake.name(CURATED))
    purchases = lake.read(CURATED).where(F.col("event_type") == "purchase")
    tables.append(metrics.campaign_metrics(purchases, "1 hour"), lake.name(METRICS))
    reconcile.recompute_range(lake, *[t.replace(tzinfo=timezone.utc) for t in RANGE], window="1 hour")
    return lake.read(METRICS).drop("aggregation_time")


# --- reports -------------------------------------------------------------------------------------


@query
def count_by_type(spark, folder):
    return reports.count_by_type(events_of(spark, folder))


@query
def count_by_type_device(spark, folder):
    return reports.count_by_type_device(events_of(spark, folder), *DATES)


@query
def events_between(spark, folder):
    return reports.events_between(events_of(spark, folder), *DATES)


@query
def event_by_id(spark, folder):
    return reports.event_by_id(events_of(spark, folder), "77")


@query
def top_windows(spark, folder):
    return reports.top_windows(stats_sample(spark, folder))


@query
def recent_stats(spark, folder):
    return reports.recent_stats(stats_sample(spark, folder), AS_OF)


@query
def recent_stats_newest(spark, folder):
    """The last five minutes before the newest publication."""
    stats = stats_sample(spark, folder)
    return reports.recent_stats(stats, reports.newest_time(stats))


@query
def device_totals(spark, folder):
    return reports.device_totals(stats_sample(spark, folder), "view", AS_OF)


@query
def popular_combos(spark, folder):
    return reports.popular_combos(stats_sample(spark, folder), AS_OF)


@query
def metrics_for_day(spark, folder):
    found = metrics.campaign_metrics(events_of(spark, folder))
    return reports.metrics_for_day(found, DAY).drop("aggregation_time")


@query
def as_of_batch(spark, folder):
    """The curated table as it stood after batch 15."""
    then = reports.raw_as_of(raw_days(spark, folder), batch_id=15)
    return reconcile.curated_state(then).select("event_id", "event_timestamp", "event_date", "ingestion_batch_id")


@query
def as_of_time(spark, folder):
    """Raw records ingested by a moment; each batch came in at noon of its day."""
    noon = F.make_timestamp(
        F.lit(2024), F.lit(1), F.lit(1), F.lit(12), F.lit(0), F.lit(0), F.lit("UTC")
    ) + F.make_dt_interval(days=(F.col("ingestion_batch_id") - 1).cast("int"))
    raw = raw_days(spark, folder).withColumn("ingested_at", noon)
    then = reports.raw_as_of(raw, ingested_at=AS_OF.replace(tzinfo=timezone.utc))
    return then.agg(F.count(F.lit(1)).alias("event_count"))


@query
def ingest_history(spark, folder):
    return reports.ingest_history(raw_days(spark, folder))


@query
def partition_stats(spark, folder):
    return reports.partition_stats(events_of(spark, folder))


def _lake_with_late(spark, folder) -> str:
    lake, location = workspace(spark, CURATED, LATE, STATS)
    events = sample.driver_events(spark, folder).withColumn("arrival", sample.arrival_time())
    events = events.selectExpr("arrival", *sample.EVENT_EXPRESSIONS)
    for rows, spec in zip(ingest.split_late(events, "arrival"), (CURATED, LATE)):
        tables.append(rows.drop("event_time"), lake.name(spec))
    tables.append(stats_sample(spark, folder), lake.name(STATS))
    return location


def _run_sql(spark, folder, sql: str, schema: str) -> DataFrame:
    """Save the text, run it as a file over the lake's tables, and read the CSV result back."""
    location = _lake_with_late(spark, folder)
    file = f"{scratch_path(spark, 'sql')}/report.sql"
    spark.createDataFrame([(sql,)], "line STRING").coalesce(1).write.text(file)
    _, output = sqlfile.run_sql_file(spark, location, file)
    return spark.read.schema(schema).option("header", True).csv(output)


@query
def sql_file(spark, folder):
    """A join over two tables, saved as CSV."""
    return _run_sql(
        spark,
        folder,
        "SELECT l.event_type, l.device, count(*) AS late_events, max(s.total) AS all_events "
        "FROM ad_events_late l JOIN (SELECT event_type, device, sum(event_count) AS total "
        "FROM ad_events_aggregation GROUP BY event_type, device) s "
        "ON l.event_type = s.event_type AND l.device = s.device GROUP BY l.event_type, l.device",
        "event_type STRING, device STRING, late_events BIGINT, all_events BIGINT",
    )


@query
def sql_file_evolved(spark, folder):
    """A table whose first partition was written before later columns existed; all columns are read."""
    warehouse, events = scratch_path(spark, "evolved"), sample.ad_events(spark, folder)
    old, new = "event_date < DATE '2024-01-10'", "event_date >= DATE '2024-01-10'"
    first = ["event_id", "event_type", "event_date"]
    for where, columns in ((old, first), (new, [*first, "user_segment", "geo_latitude"])):
        out = events.where(where).select(*columns).write.mode("append").partitionBy("event_date")
        out.parquet(f"{warehouse}/grown/data")
    text = "SELECT g.* FROM grown g -- not from other"
    sql = f"{scratch_path(spark, 'sql')}/evolved.sql"
    spark.createDataFrame([(text,)], "line STRING").coalesce(1).write.text(sql)
    result, output = sqlfile.run_sql_file(spark, warehouse, sql)
    ddl = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in result.schema)
    return spark.read.schema(ddl).option("header", True).csv(output)


@query
def sql_file_late(spark, folder):
    """The stock report: any hundred late events."""
    rows = _run_sql(
        spark,
        folder,
        "SELECT * FROM ad_events_late LIMIT 100;",
        ", ".join(f"{c} STRING" for c in _table_order(LATE)),
    )
    late = F.col("event_timestamp").endswith("+00:00")
    return rows.agg(F.count(F.lit(1)).alias("n"), F.count_if(late).alias("with_zone"))


def _table_order(spec: TableSpec) -> list[str]:
    """Column order of a file table: the partition column is last."""
    return [c for c in spec.columns if c != spec.partition] + [spec.partition]


# --- streams -------------------------------------------------------------------------------------


def _event_stream(spark, folder) -> DataFrame:
    """The driver's events as a stream. A stream source wants a folder or a pattern, hence the ``?``."""
    schema = sample.driver_events(spark, folder).schema
    return spark.readStream.schema(schema).parquet(f"{folder}/events.parque?")


@contextmanager
def state_per_core(spark: SparkSession):
    """Start stateful queries with one state partition per core instead of the batch default."""
    width = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", spark.sparkContext.defaultParallelism)
    try:
        yield
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", width)


@query
def stream_metrics(spark, folder):
    """Records to watermarked windows to the metrics table."""
    lake, _ = workspace(spark, METRICS)
    records = sample.topic_records(_event_stream(spark, folder))
    live = streams.live_metrics(records, sample.version_decoder())
    checkpoints = scratch_path(spark, "checkpoint")
    with state_per_core(spark):
        started = streams.start_metrics(live, lake, checkpoints, None, f"metrics_{uuid.uuid4().hex[:8]}")
    started.awaitTermination()
    return lake.read(METRICS).drop("aggregation_time")


@query
def stream_stats(spark, folder):
    """Records to five-minute device statistics; the last snapshot of each window."""
    lake, _ = workspace(spark, STATS)
    records = sample.topic_records(_event_stream(spark, folder))
    live = streams.live_stats(records, sample.version_decoder())
    checkpoints = scratch_path(spark, "checkpoint")
    with state_per_core(spark):
        started = streams.start_stats(live, lake, checkpoints, None, f"stats_{uuid.uuid4().hex[:8]}")
    started.awaitTermination()
    return metrics.latest_snapshot(lake.read(STATS)).drop("aggregation_time")


def _ingested(spark, folder, options=streams.IngestOptions()) -> tables.Warehouse:
    lake, _ = workspace(spark, RAW, CURATED, LATE)
    records = sample.topic_records(_event_stream(spark, folder))
    streams.start_ingest(
        records,
        lake,
        sample.version_decoder(),
        scratch_path(spark, "checkpoint"),
        None,
        options,
        f"ingest_{uuid.uuid4().hex[:8]}",
    ).awaitTermination()
    return lake


@query
def stream_ingest(spark, folder):
    kept = _ingested(spark, folder).read(CURATED)
    return kept.drop("ingested_at", "event_time")


@query
def stream_ingest_raw(spark, folder):
    raw = _ingested(spark, folder).read(RAW)
    return raw.groupBy("kafka_date", "parse_status").agg(F.count(F.lit(1)).alias("records"))


@query
def stream_late_events(spark, folder):
    """Late events go to their own table; here a record arrives as late as its value says."""
    lake, _ = workspace(spark, RAW, CURATED, LATE)
    events = _event_stream(spark, folder).withColumn("arrival", sample.arrival_time())
    records = sample.topic_records(events, arrival="arrival")
    streams.start_ingest(
        records,
        lake,
        sample.version_decoder(),
        scratch_path(spark, "checkpoint"),
        None,
        streams.IngestOptions(separate_late=True),
        f"late_{uuid.uuid4().hex[:8]}",
    ).awaitTermination()
    on_time = lake.read(CURATED).select("event_id", "event_date", F.lit(0).alias("late"))
    late = lake.read(LATE).select("event_id", "event_date", F.lit(1).alias("late"))
    return on_time.unionByName(late)


def _append(records: DataFrame, topic: str) -> None:
    """More files of the stand-in topic, as many as there are tasks."""
    records.select(*TOPIC_SCHEMA.fieldNames()).write.mode("append").parquet(topic)


TRIGGER_FILES = 4
FILE_ROWS = 200_000


def _trigger_files(spark, folder) -> int:
    """Files of each trigger: more for more events, so that none grows with the table."""
    return max(TRIGGER_FILES, -(-sample.driver_events(spark, folder).count() // FILE_ROWS))


def _append_trigger(records: DataFrame, topic: str, files: int) -> None:
    """So many files that one trigger takes them all, with ``max_files`` set to that number."""
    _append(records.repartition(files), topic)


def _three_parts(spark, folder) -> list[DataFrame]:
    """Most events, every fiftieth, and another fiftieth, which comes too late for closed windows."""
    events = sample.driver_events(spark, folder)
    turn = F.col("event_id") % 50
    return [events.where(turn > 1), events.where(turn == 1), events.where(turn == 0)]


@query
def stream_ingest_restart(spark, folder):
    """Four triggers, each after a restart: the first ten days, nothing, ten more days, and the rest with copies.

    The copies are all purchases sent again, so upserts of the last trigger replace rows of the others.
    """
    lake, _ = workspace(spark, RAW, CURATED)
    topic, checkpoints = scratch_path(spark, "topic"), scratch_path(spark, "checkpoint")
    records = sample.topic_records(sample.driver_events(spark, folder))
    day = F.dayofmonth("timestamp")
    copies = sample.topic_records(sample.driver_events(spark, folder).where("event_type = 'purchase'"))
    resent = copies.withColumn("offset", F.col("offset") + (1 << 40))

    name = f"restart_{uuid.uuid4().hex[:8]}"

    def take_all():
        files = read_event_stream(spark, FileSource(topic))
        decoder = sample.version_decoder()
        streams.start_ingest(files, lake, decoder, checkpoints, None, name=name).awaitTermination()

    first, nothing, more = records.where(day <= 10), records.where("false"), records.where((day > 10) & (day <= 20))
    for part in (first, nothing, more, records.where(day > 20).unionByName(resent)):
        _append(part, topic)
        take_all()
    stored = lake.read(CURATED).groupBy("ingestion_batch_id", "event_type", "event_date")
    raw = lake.read(RAW).groupBy("ingestion_batch_id").agg(F.count(F.lit(1)).alias("records"))
    return stored.agg(F.count(F.lit(1)).alias("events"), F.countDistinct("event_id").alias("ids")).join(
        raw, "ingestion_batch_id"
    )


@query
def stream_metrics_late(spark, folder):
    """Three triggers: the last brings every fiftieth event, of which only the newest are let in.

    Spark drops late rows by the watermark that the trigger before started with, so one trigger lies between.
    """
    lake, _ = workspace(spark, METRICS)
    topic, checkpoints = scratch_path(spark, "topic"), scratch_path(spark, "checkpoint")
    files = _trigger_files(spark, folder)
    for part in _three_parts(spark, folder):
        _append_trigger(sample.topic_records(part), topic, files)
    records = read_event_stream(spark, FileSource(topic, max_files=files))
    live = streams.live_metrics(records, sample.version_decoder())
    with state_per_core(spark):
        started = streams.start_metrics(live, lake, checkpoints, None, f"late_{uuid.uuid4().hex[:8]}")
    started.awaitTermination()
    return lake.read(METRICS).drop("aggregation_time")


@query
def late_correction(spark, folder):
    """Live metrics drop the late rows of the last trigger; ingest counts exactly their windows again."""
    lake, _ = workspace(spark, RAW, CURATED, METRICS)
    topic, name = scratch_path(spark, "topic"), uuid.uuid4().hex[:8]
    files = _trigger_files(spark, folder)
    *on_time, late = _three_parts(spark, folder)
    for part, delay in ((on_time[0], 0), (on_time[1], 0), (late, 3)):
        _append_trigger(sample.topic_records(part, arrival=f"ts + INTERVAL {delay} DAYS"), topic, files)
    records = read_event_stream(spark, FileSource(topic, max_files=files))
    decoder, checkpoints = sample.version_decoder(), scratch_path(spark, "checkpoint")
    with state_per_core(spark):
        live = streams.live_metrics(records, decoder)
        streams.start_metrics(live, lake, checkpoints, None, f"live_{name}").awaitTermination()
    options = streams.IngestOptions(correct_late=WATERMARK_DELAY)
    streams.start_ingest(records, lake, decoder, checkpoints, None, options, f"ingest_{name}").awaitTermination()
    return lake.read(METRICS).drop("aggregation_time")


@contextmanager
def without_empty_triggers(spark: SparkSession):
    """Triggers that only move the watermark come when they come; without them a run has just those with data."""
    setting = "spark.sql.streaming.noDataMicroBatches.enabled"
    before = spark.conf.get(setting)
    spark.conf.set(setting, "false")
    try:
        yield
    finally:
        spark.conf.set(setting, before)


def _add_part(records: DataFrame, topic: str, number: int) -> None:
    """A folder of files that enters the stand-in topic in one step, so a running query sees all of it or nothing."""
    spark, staged = records.sparkSession, scratch_path(records.sparkSession, "staged")
    records.select(*TOPIC_SCHEMA.fieldNames()).write.parquet(staged)
    source, fs = hadoop_path(spark, staged)
    fs.mkdirs(hadoop_path(spark, topic)[0])
    fs.rename(source, hadoop_path(spark, f"{topic}/{number}")[0])


@query
def stream_progress(spark, folder):
    """What a listener saw of a query with a processing-time trigger: rows of each trigger and late groups."""
    lake, _ = workspace(spark, METRICS)
    topic, name = scratch_path(spark, "topic"), f"progress_{uuid.uuid4().hex[:8]}"
    seen = TriggerLog()
    spark.streams.addListener(seen)
    started = None
    try:
        for number, part in enumerate(_three_parts(spark, folder)):
            _add_part(sample.topic_records(part), topic, number)
            if started is None:
                records = read_event_stream(spark, FileSource(f"{topic}/*"))
                live = streams.live_metrics(records, sample.version_decoder())
                with state_per_core(spark), without_empty_triggers(spark):
                    started = streams.start_metrics(live, lake, scratch_path(spark, "checkpoint"), "1 second", name)
            started.processAllAvailable()
            seen.wait_for(name, started.lastProgress.batchId)
    finally:
        if started is not None:
            started.stop()
        spark.streams.removeListener(seen)
    number = F.row_number().over(Window.orderBy("batch_id"))  # three rows
    taken = seen.frame(spark, name).where("input_rows > 0")
    return taken.select(number.alias("trigger"), "input_rows", "late_rows")


@query
def stream_state(spark, folder):
    """What the metrics query still holds after a restart: the sums of windows that are not closed yet."""
    lake, _ = workspace(spark, METRICS)
    topic, checkpoints = scratch_path(spark, "topic"), scratch_path(spark, "checkpoint")
    name = f"state_{uuid.uuid4().hex[:8]}"
    records = sample.topic_records(sample.driver_events(spark, folder))
    early = F.dayofmonth("timestamp") <= 20
    for part in (records.where(early), records.where(~early)):
        _append(part, topic)
        live = streams.live_metrics(read_event_stream(spark, FileSource(topic)), sample.version_decoder())
        with state_per_core(spark):
            streams.start_metrics(live, lake, checkpoints, None, name).awaitTermination()
    key = "struct<window: struct<start: timestamp, end: timestamp>, campaign_id: int>"
    # Both sums have the same name in the state, so they are told apart by place.
    sums = F.col("value").cast("struct<clicks: bigint, conversions: bigint>").alias("sums")
    held = read_state(spark, checkpoints, name).select(F.col("key").cast(key).alias("key"), sums)
    return held.select(F.col("key.window.start").alias("window_start"), "key.campaign_id", "sums.*")


@query
def live_run(spark, folder):
    """Publish all events to files, then run both live queries from that one source."""
    lake, _ = workspace(spark, RAW, CURATED, METRICS)
    topic = scratch_path(spark, "topic")
    records = sample.topic_records(sample.driver_events(spark, folder))
    records.select(*TOPIC_SCHEMA.fieldNames()).write.parquet(topic)
    with state_per_core(spark):
        report = streams.run(spark, FileSource(topic), lake, scratch_path(spark, "checkpoint"), trigger=None)
    failed = {name: error for name, error in report.items() if error}
    if failed:
        raise RuntimeError(f"live queries failed: {failed}")
    live = lake.read(METRICS).groupBy("window_date").agg(
        F.count(F.lit(1)).alias("windows"), F.sum("clicks").alias("clicks"), F.sum("conversions").alias("conversions")
    )
    stored = lake.read(CURATED).groupBy(F.col("event_date").alias("window_date")).agg(
        F.count(F.lit(1)).alias("events")
    )
    return live.join(stored, "window_date")
