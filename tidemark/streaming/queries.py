"""The live queries: record ingest, watermarked campaign metrics, and device statistics.

    spark-submit -m tidemark.streaming.queries --servers host:9092 --checkpoints /lake/checkpoints
"""

from __future__ import annotations

import argparse
import logging
from collections.abc import Callable
from dataclasses import dataclass
from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tidemark.functions.events import event_time_of, is_valid_event
from tidemark.functions.frames import FrameDecoder
from tidemark.operators.ingest import (
    curated_events,
    decode_records,
    quality_counts,
    raw_records,
    split_late,
    valid_events,
    write_quarantine,
)
from tidemark.operators.metrics import campaign_metrics, device_stats
from tidemark.operators.tables import FILE_FORMATS, Warehouse, create_tables, upsert_spec
from tidemark.plans.reconcile import affected_windows, recompute_windows
from tidemark.schemas import (
    CURATED,
    DEFAULT_TOPIC,
    LATE,
    METRIC_WINDOW,
    METRICS,
    RAW,
    STATS,
    STATS_WINDOW,
    TRIGGER_INTERVAL,
    WATERMARK_DELAY,
)
from tidemark.session import build_session
from tidemark.sources.registry import event_decoder, read_schema_file, read_writer_schemas
from tidemark.sources.topic import TopicSource, read_event_stream

log = logging.getLogger(__name__)

# Names that the queries run under.
INGEST_QUERY = "ad_events_ingestion"
METRICS_QUERY = "campaign_conversion_metrics_watermarked"
STATS_QUERY = "ad_events_aggregation"


@dataclass(frozen=True)
class IngestOptions:
    """How ingest treats a batch.

    ``fixed_record_dates`` relies on a record's timestamp never changing, so a replayed record is
    looked up in its own date only. Clear it if a topic is deleted and created again under one name
    and the new records shall replace old ones with equal offsets.

    ``curated_match_where`` is any condition known to hold for curated rows that a new event may
    replace, such as a bound on their date; without it event ids are looked up in the whole table.

    ``correct_late`` is an interval, such as the watermark's delay: windows of events that came in later than
    that, or on a later date than they happened on, are counted again from all curated events.
    """

    fixed_record_dates: bool = True
    separate_late: bool = False
    quarantine: str | None = None
    curated_match_where: Column | None = None
    correct_late: str | None = None
    correct_window: str = METRIC_WINDOW


def evenly(records: DataFrame) -> DataFrame:
    """Records dealt over tasks by size, however few files or topic partitions they came in.

    Decoded records are several times their frames, and all of a task's are held at once.
    """
    return records.hint("rebalance")


def ingest_batch(
    records: DataFrame,
    batch_id: int,
    warehouse: Warehouse,
    decoder: FrameDecoder,
    options: IngestOptions = IngestOptions(),
    ingested_at: datetime | None = None,
) -> dict[str, int]:
    """Store one micro-batch: every record in raw, valid events in the curated table.

    Records are counted in passing, as the raw table takes them.
    """
    moment = ingested_at or datetime.now(timezone.utc)
    parsed = decode_records(evenly(records), decoder).persist()
    try:
        seen = Observation()
        raw = raw_records(parsed.observe(seen, *quality_counts()), batch_id, moment, hidden=True)
        written = upsert_spec(raw, warehouse, RAW, partition_follows_key=options.fixed_record_dates)
        quality = seen.get
        if not written.rows:
            return quality
        if options.quarantine:
            write_quarantine(raw_records(parsed, batch_id, moment), options.quarantine, batch_id)
        if quality["valid"]:
            events = valid_events(parsed, "kafka_timestamp", "kafka_topic", "kafka_partition", "kafka_offset")
            targets = [(events, CURATED)]
            if options.separate_late:
                on_time, late = split_late(events, "kafka_timestamp")
                targets = [(on_time, CURATED), (late, LATE)]
            for chosen, spec in targets:
                rows = curated_events(chosen, batch_id, moment)
                upsert_spec(rows, warehouse, spec, keys_unique=True, match_where=options.curated_match_where)
            if options.correct_late and not options.separate_late:
                windows = affected_windows(events, "kafka_timestamp", options.correct_late, options.correct_window)
                quality["corrected"] = recompute_windows(warehouse, windows, options.correct_window)
        log.info("batch %s: %s", batch_id, quality)
        return quality
    finally:
        parsed.unpersist()


def newer_and_open(old: Callable[[str], Column], new: Callable[[str], Column]) -> Column:
    """A live total takes the place of an older one, unless that was counted from all stored events."""
    settled = F.coalesce(old("reconciled"), F.lit(False))
    return ~settled & (new("aggregation_time") >= old("aggregation_time"))


def metrics_batch(rows: DataFrame, batch_id: int, warehouse: Warehouse) -> int:
    """Upsert the windows that one trigger changed, with their absolute totals."""
    options = {"keys_unique": True, "partition_follows_key": True, "replace_if": newer_and_open}
    written = upsert_spec(rows, warehouse, METRICS, **options).rows
    log.info("metrics batch %s: %s windows", batch_id, written)
    return written


def stats_batch(rows: DataFrame, batch_id: int, warehouse: Warehouse) -> int:
    """Add the counts that one trigger changed as a new snapshot of their windows.

    A replayed batch keeps its time, so it replaces its own snapshot.
    """
    options = {"keys_unique": True, "partition_follows_key": True}
    return upsert_spec(rows, warehouse, STATS, **options).rows


def live_events(records: DataFrame, decoder: FrameDecoder, *extra: str) -> DataFrame:
    """Valid events of a record stream, with just the fields that windowed queries use."""
    frame = decoder.decode(F.col("value"))
    fields = ["event_id", "event_time", "campaign_id", "event_type", *extra]
    events = records.select(frame.alias("frame")).select(*[F.col(f"frame.{c}").alias(c) for c in fields])
    return events.withColumn("event_timestamp", event_time_of(F.col("event_time"))).where(is_valid_event())


def live_metrics(
    records: DataFrame,
    decoder: FrameDecoder,
    window: str = METRIC_WINDOW,
    delay: str = WATERMARK_DELAY,
    dedupe: bool = False,
) -> DataFrame:
    """Watermarked campaign metrics of a record stream.

    Clicks and purchases alone move the watermark, as their filter runs below it. Repeated event ids
    are counted unless ``dedupe`` is set, which drops those within the watermark; the daily job never
    counts them twice.
    """
    marked = live_events(records, decoder).withWatermark("event_timestamp", delay)
    if dedupe:
        marked = marked.dropDuplicatesWithinWatermark(["event_id"])
    return campaign_metrics(marked, window)


def live_stats(
    records: DataFrame, decoder: FrameDecoder, window: str = STATS_WINDOW, delay: str = WATERMARK_DELAY
) -> DataFrame:
    """Watermarked event counts per window, event type and device."""
    return device_stats(live_events(records, decoder, "device").withWatermark("event_timestamp", delay), window)


def _started(writer, name: str, checkpoints: str, trigger: str | None) -> StreamingQuery:
    """Start with one checkpoint folder per query; no interval means: take what is there, then end."""
    writer = writer.queryName(name).option("checkpointLocation", f"{checkpoints.rstrip('/')}/{name}")
    writer = writer.trigger(processingTime=trigger) if trigger else writer.trigger(availableNow=True)
    return writer.start()


def start_ingest(
    records: DataFrame,
    warehouse: Warehouse,
    decoder: FrameDecoder,
    checkpoints: str,
    trigger: str | None = TRIGGER_INTERVAL,
    options: IngestOptions = IngestOptions(),
    name: str = INGEST_QUERY,
) -> StreamingQuery:
    def store(batch: DataFrame, batch_id: int) -> None:
        ingest_batch(batch, batch_id, _in_session(warehouse, batch), decoder, options)

    return _started(records.writeStream.foreachBatch(store).outputMode("append"), name, checkpoints, trigger)


def start_metrics(
    metrics: DataFrame,
    warehouse: Warehouse,
    checkpoints: str,
    trigger: str | None = TRIGGER_INTERVAL,
    name: str = METRICS_QUERY,
) -> StreamingQuery:
    def store(batch: DataFrame, batch_id: int) -> None:
        metrics_batch(batch, batch_id, _in_session(warehouse, batch))

    return _started(metrics.writeStream.foreachBatch(store).outputMode("update"), name, checkpoints, trigger)


def start_stats(
    stats: DataFrame,
    warehouse: Warehouse,
    checkpoints: str,
    trigger: str | None = TRIGGER_INTERVAL,
    name: str = STATS_QUERY,
) -> StreamingQuery:
    def store(batch: DataFrame, batch_id: int) -> None:
        stats_batch(batch, batch_id, _in_session(warehouse, batch))

    return _started(stats.writeStream.foreachBatch(store).outputMode("update"), name, checkpoints, trigger)


def _in_session(warehouse: Warehouse, batch: DataFrame) -> Warehouse:
    """The same tables through the session the micro-batch runs in."""
    return Warehouse(batch.sparkSession, warehouse.database)


def failure_of(query: StreamingQuery) -> str | None:
    error = query.exception()
    return str(error) if error else None


def stop_all(queries: list[StreamingQuery]) -> dict[str, str | None]:
    """Stop what still runs; returns each query's failure, if any."""
    report = {}
    for query in queries:
        report[query.name] = failure_of(query)
        try:
            if query.isActive:
                query.stop()
        except Exception as error:  # the others must still stop, and the first failure be reported
            log.exception("%s did not stop", query.name)
            report[query.name] = report[query.name] or str(error)
        log.info("%s ended: %s", query.name, report[query.name] or "no failure")
    return report


def run(
    spark: SparkSession,
    source,
    warehouse: Warehouse,
    checkpoints: str,
    decoder: FrameDecoder | None = None,
    trigger: str | None = TRIGGER_INTERVAL,
    options: IngestOptions = IngestOptions(),
    stats: bool = False,
    dedupe: bool = False,
) -> dict[str, str | None]:
    """Run ingest and metrics from one source until one ends, then stop the other.

    With ``trigger=None`` they take what is there and end on their own. ``stats`` adds the
    five-minute device statistics as a third query; ``dedupe`` makes the metrics count an event id once.
    """
    decoder = decoder or event_decoder()
    records = read_event_stream(spark, source)
    spark.streams.resetTerminated()  # earlier queries of this session must not end the wait
    queries: list[StreamingQuery] = []
    try:
        queries.append(start_ingest(records, warehouse, decoder, checkpoints, trigger, options))
        queries.append(start_metrics(live_metrics(records, decoder, dedupe=dedupe), warehouse, checkpoints, trigger))
        if stats:
            queries.append(start_stats(live_stats(records, decoder), warehouse, checkpoints, trigger))
        if trigger:
            spark.streams.awaitAnyTermination()
        else:
            for query in queries:
                query.awaitTermination()
    finally:
        report = stop_all(queries)
    return report


def arguments(argv: list[str] | None = None) -> argparse.Namespace:
    parser = argparse.ArgumentParser(description="Ingest an event topic and keep live campaign metrics.")
    parser.add_argument("--servers", required=True, help="comma-separated broker addresses")
    parser.add_argument("--topic", default=DEFAULT_TOPIC)
    parser.add_argument("--max-offsets", type=int, help="records of one trigger; default all there are")
    parser.add_argument(
        "--tolerate-data-loss", action="store_true", help="go on if unread records are gone from the topic"
    )
    parser.add_argument("--schemas", help="JSON file: registered schema id to writer schema")
    parser.add_argument("--topic-schema", help="the topic's latest schema, for all other ids; default the newest version")
    parser.add_argument("--checkpoints", required=True, help="shared folder for query checkpoints")
    parser.add_argument(
        "--state-partitions",
        type=int,
        help="shuffle width of the window state; fixed once the metrics query has a checkpoint",
    )
    parser.add_argument("--stats", action="store_true", help="also keep five-minute device statistics")
    parser.add_argument("--dedupe", action="store_true", help="count repeated event ids once in live metrics")
    parser.add_argument("--separate-late", action="store_true", help="keep late events in a table of their own")
    parser.add_argument(
        "--correct-late",
        nargs="?",
        const=WATERMARK_DELAY,
        metavar="INTERVAL",
        help=f"count windows again for events that came in later than this, default {WATERMARK_DELAY}",
    )
    parser.add_argument("--quarantine", help="folder for records that could not be curated")
    parser.add_argument("--match-days", type=int, help="look event ids up in so many days before each batch only")
    parser.add_argument(
        "--changing-record-dates", action="store_true", help="the topic may be created again with the same offsets"
    )
    parser.add_argument("--database", default="default")
    parser.add_argument("--location", help="warehouse folder for tables that do not exist yet")
    parser.add_argument("--provider", default="parquet", help="table format for new tables")
    args = parser.parse_args(argv)
    if args.provider in FILE_FORMATS and not args.location:
        parser.error("file tables need --location, or a restart cannot find them")
    if args.correct_late and args.separate_late:
        parser.error("events kept apart by --separate-late are in no metrics, so --correct-late cannot count them")
    return args


def source_of(args: argparse.Namespace) -> TopicSource:
    return TopicSource(
        args.servers, args.topic, max_offsets=args.max_offsets, fail_on_data_loss=not args.tolerate_data_loss
    )


def decoder_of(spark: SparkSession, args: argparse.Namespace) -> FrameDecoder:
    """Writer schemas as the registry numbered them; all other ids are read by the topic's latest schema."""
    writers = read_writer_schemas(spark, args.schemas) if args.schemas else {}
    return event_decoder(writers, read_schema_file(spark, args.topic_schema) if args.topic_schema else None)


def options_of(args: argparse.Namespace) -> IngestOptions:
    bound = None
    if args.match_days is not None:
        bound = F.col(CURATED.partition) >= F.date_sub(F.current_date(), args.match_days)
    return IngestOptions(
        not args.changing_record_dates, args.separate_late, args.quarantine, bound, args.correct_late
    )


def main(argv: list[str] | None = None) -> None:
    args = arguments(argv)
    spark = build_session("live")
    if args.state_partitions:
        spark.conf.set("spark.sql.shuffle.partitions", args.state_partitions)
    try:
        warehouse = create_tables(spark, args.database, args.location, provider=args.provider)
        run(
            spark,
            source_of(args),
            warehouse,
            args.checkpoints,
            decoder_of(spark, args),
            options=options_of(args),
            stats=args.stats,
            dedupe=args.dedupe,
        )
    finally:
        spark.stop()


if __name__ == "__main__":
    main()
