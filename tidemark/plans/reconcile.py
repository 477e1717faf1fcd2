"""Daily batch: rebuild one day's events and metrics from the raw table.

    spark-submit -m tidemark.plans.reconcile --date 2026-05-02 --database ads
"""

from __future__ import annotations

import argparse
import re
from datetime import date, datetime, timedelta

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.events import is_click, is_conversion, with_parsed
from tidemark.operators.ingest import POSITION, curated_columns, dedupe, is_late, valid_events
from tidemark.operators.metrics import campaign_metrics
from tidemark.operators.tables import (
    FILE_FORMATS,
    Warehouse,
    create_tables,
    replace_partition,
    restricted,
    upsert_spec,
)
from tidemark.schemas import CURATED, METRIC_WINDOW, METRICS, RAW
from tidemark.session import build_session

LINEAGE = ("ingestion_batch_id", "ingested_at")


def _parsed(raw: DataFrame) -> DataFrame:
    usable = raw.where(F.col("parse_status") == "parsed")
    return with_parsed(usable.select("deserialized_payload", *POSITION, *LINEAGE))


def curated_from_raw(raw: DataFrame, day: date, since_kafka_date: date | None = None) -> DataFrame:
    """One event day from raw records, keeping the batch and time each record came in with.

    Raw records carry their event date as a hidden column, in whose order they are stored, so row groups of
    other days are skipped whenever the records came in. Rows older than that column have none and are
    read. A producer whose clock can be trusted allows ``since_kafka_date``, which prunes earlier partitions.
    """
    if since_kafka_date is not None:
        raw = raw.where(F.col("kafka_date") >= F.lit(since_kafka_date))
    if "event_date" in raw.columns:
        raw = raw.where((F.col("event_date") == F.lit(day)) | F.col("event_date").isNull())
    events = valid_events(_parsed(raw), *POSITION, *LINEAGE)
    events = events.where(F.to_date("event_timestamp") == F.lit(day))
    first = dedupe(events, "event_id", ("event_timestamp", *POSITION))
    return first.select(*curated_columns(), *LINEAGE).select(*CURATED.columns)


def curated_state(raw: DataFrame) -> DataFrame:
    """Curated table that upserting all of ``raw`` batch by batch leaves: the latest batch wins."""
    events = valid_events(_parsed(raw), *POSITION, *LINEAGE)
    ranked = events.withColumn("_newest", -F.col("ingestion_batch_id"))
    last = dedupe(ranked, "event_id", ("_newest", "event_timestamp", *POSITION))
    return last.select(*curated_columns(), *LINEAGE).select(*CURATED.columns)


def reconcile_day(
    warehouse: Warehouse,
    day: date,
    window: str = METRIC_WINDOW,
    since_kafka_date: date | None = None,
    aggregation_time: Column | None = None,
    match_where: Column | None = None,
) -> tuple[int, int]:
    """Correct the curated events and replace the metrics of one day; (events, windows).

    The windows are marked, so that a live total cannot take their place. ``match_where`` is passed to the
    curated upsert. Live jobs may go on: writers of a file table take turns.
    """
    curated = curated_from_raw(warehouse.read(RAW, hidden=True), day, since_kafka_date).persist()
    try:
        events = upsert_spec(curated, warehouse, CURATED, keys_unique=True, match_where=match_where).rows
        metrics = campaign_metrics(curated, window, aggregation_time).withColumn("reconciled", F.lit(True))
        return events, replace_partition(metrics, warehouse.name(METRICS), day)
    finally:
        curated.unpersist()


def window_bounds(start: datetime, end: datetime, window: str = METRIC_WINDOW) -> tuple[Column, Column]:
    """Start of the first window and end of the last that ``[start, end]`` touches."""
    width = pd.Timedelta(window) // pd.Timedelta(microseconds=1)
    first = F.floor(F.unix_micros(F.lit(start)) / width) * width
    last = F.floor(F.unix_micros(F.lit(end)) / width) * width + width
    return F.timestamp_micros(first), F.timestamp_micros(last)


def metrics_for_range(
    events: DataFrame,
    start: datetime,
    end: datetime,
    window: str = METRIC_WINDOW,
    aggregation_time: Column | None = None,
) -> DataFrame:
    """Metrics of every window that the closed range touches, each from all of its events."""
    low, high = window_bounds(start, end, window)
    moment = F.col("event_timestamp")
    inside = events.where((moment >= low) & (moment < high))
    # Same condition on the partition column, so only the days concerned are read.
    inside = inside.where(F.col("event_date").between(F.to_date(low), F.to_date(high)))
    return campaign_metrics(inside, window, aggregation_time)


def recompute_range(
    warehouse: Warehouse,
    start: datetime,
    end: datetime,
    window: str = METRIC_WINDOW,
    aggregation_time: Column | None = None,
) -> int:
    """Recompute and upsert the metrics of an event-time range; returns the window count."""
    metrics = metrics_for_range(warehouse.read(CURATED), start, end, window, aggregation_time)
    options = {"keys_unique": True, "partition_follows_key": True}
    return upsert_spec(metrics, warehouse, METRICS, **options).rows


def affected_windows(events: DataFrame, arrival: str, late_after: str, window: str = METRIC_WINDOW) -> DataFrame:
    """campaign_id, window_start, window_date and reconciled of the windows that live metrics may have missed events of.

    These are events that came in later than ``late_after``, and all that came in on a later date than they
    happened on: their day may have been reconciled without them. Windows of earlier days are marked as
    reconciled again, as from then on each such event corrects them.
    """
    missed = events.where(is_click() | is_conversion()).where(
        is_late(arrival, after=late_after) | (F.to_date(arrival) > F.to_date("event_timestamp"))
    )
    start = F.window("event_timestamp", window)["start"]
    placed = missed.select("campaign_id", start.alias("window_start"), F.to_date(arrival).alias("_arrived"))
    placed = placed.withColumn("window_date", F.to_date("window_start"))
    later = (F.max("_arrived") > F.col("window_date")).alias("reconciled")
    return placed.groupBy("campaign_id", "window_start", "window_date").agg(later)


def recompute_windows(
    warehouse: Warehouse,
    windows: DataFrame,
    window: str = METRIC_WINDOW,
    aggregation_time: Column | None = None,
) -> int:
    """Recompute and upsert exactly the given windows from all their curated events; returns how many there are.

    Only the days concerned are read, and of them only events of these windows are added up.
    """
    windows = windows.persist()
    try:
        days = {row[0] for row in windows.select("window_date").distinct().collect()}
        if not days:
            return 0
        longer = -(-pd.Timedelta(window) // pd.Timedelta(days=1))  # days that a window may reach over
        days = {d + timedelta(days=i) for d in days for i in range(longer + 1)}
        curated = restricted(warehouse.read(CURATED), (CURATED.partition,), {(d,) for d in days})
        placed = curated.where(is_click() | is_conversion()).withColumn(
            "window_start", F.window("event_timestamp", window)["start"]
        )
        mine = placed.join(windows.select("campaign_id", "window_start"), ["campaign_id", "window_start"], "left_semi")
        metrics = campaign_metrics(mine, window, aggregation_time)
        marks = windows.select("campaign_id", "window_start", "reconciled")
        marked = metrics.join(marks, ["campaign_id", "window_start"]).select(*metrics.columns, "reconciled")
        options = {"keys_unique": True, "partition_follows_key": True}
        return upsert_spec(marked, warehouse, METRICS, **options).rows
    finally:
        windows.unpersist()


def parse_day(text: str) -> date:
    """Strict YYYY-MM-DD."""
    if not re.fullmatch(r"\d{4}-\d{2}-\d{2}", text):
        raise ValueError(f"not a YYYY-MM-DD date: {text!r}")
    return date.fromisoformat(text)


def yesterday() -> date:
    return date.today() - timedelta(days=1)


def _parser() -> argparse.ArgumentParser:
    parser = argparse.ArgumentParser(description="Rebuild one day's events and metrics from raw records.")
    parser.add_argument("--date", type=parse_day, default=yesterday(), help="event date, default yesterday")
    parser.add_argument("--database", default="default")
    parser.add_argument("--location", help="warehouse folder for tables that do not exist yet")
    parser.add_argument("--provider", default="parquet", help="table format for new tables")
    parser.add_argument("--since-kafka-date", type=parse_day, help="no event of the day was recorded before")
    parser.add_argument("--match-days", type=int, help="look event ids up in so many days around the date only")
    return parser


def arguments(argv: list[str] | None = None) -> argparse.Namespace:
    parser = _parser()
    args = parser.parse_args(argv)
    if args.provider in FILE_FORMATS and not args.location:
        parser.error("file tables need --location, or the live job's tables are not found")
    return args


def match_bound(day: date, days: int | None) -> Column | None:
    """Curated rows that may hold an event of the day."""
    if days is None:
        return None
    around = timedelta(days=days)
    return F.col(CURATED.partition).between(F.lit(day - around), F.lit(day + around))


def run_job(spark: SparkSession, args: argparse.Namespace) -> tuple[int, int]:
    """What the job does in its session."""
    warehouse = create_tables(spark, args.database, args.location, provider=args.provider)
    return reconcile_day(
        warehouse,
        args.date,
        since_kafka_date=args.since_kafka_date,
        match_where=match_bound(args.date, args.match_days),
    )


def main(argv: list[str] | None = None) -> None:
    args = arguments(argv)
    spark = build_session("reconcile")
    try:
        events, windows = run_job(spark, args)
        print(f"{args.date}: {events} events, {windows} metric windows")
    finally:
        spark.stop()


if __name__ == "__main__":
    main()
