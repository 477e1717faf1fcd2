"""Canned reports over the tables."""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.schemas import STATS_WINDOW


def _rows(name: str) -> Column:
    return F.count(F.lit(1)).alias(name)


# --- events --------------------------------------------------------------------------------------


def count_by_type(events: DataFrame) -> DataFrame:
    return events.groupBy("event_type").agg(_rows("events"))


def count_by_type_device(events: DataFrame, first: date, last: date) -> DataFrame:
    """Events per type and device between two dates, most frequent first."""
    chosen = events.where(F.col("event_date").between(F.lit(first), F.lit(last)))
    counts = chosen.groupBy("event_type", "device").agg(_rows("events"))
    return counts.orderBy(F.desc("events"), "event_type", "device")


def event_by_id(events: DataFrame, event_id: str) -> DataFrame:
    return events.where(F.col("event_id") == event_id)


def events_between(
    events: DataFrame, first: date, last: date | None = None, limit: int | None = None
) -> DataFrame:
    """Events of one date or of a closed date range, optionally just some of them."""
    chosen = events.where(F.col("event_date").between(F.lit(first), F.lit(last or first)))
    return chosen if limit is None else chosen.limit(limit)


def parse_status_counts(raw: DataFrame) -> DataFrame:
    return raw.groupBy("parse_status").agg(_rows("records"))


# --- metrics -------------------------------------------------------------------------------------


def metrics_for_day(metrics: DataFrame, day: date) -> DataFrame:
    chosen = metrics.where(F.col("window_date") == F.lit(day))
    return chosen.orderBy("window_start", "campaign_id")


# --- five-minute statistics ----------------------------------------------------------------------


def top_windows(stats: DataFrame, k: int = 20) -> DataFrame:
    """The k newest windows; ties are settled by event type and device."""
    columns = ["event_type", "device", "event_count", "window_start", "window_end"]
    newest = stats.select(*columns, "aggregation_time")
    order = [F.desc("window_end"), "event_type", "device", F.desc("aggregation_time")]
    return newest.orderBy(*order).limit(k).select(*columns)


def newest_time(stats: DataFrame) -> Column:
    """Latest aggregation time as a scalar subquery."""
    return stats.agg(F.max("aggregation_time")).scalar()


def recent(stats: DataFrame, as_of: datetime | Column | None = None, within: str = STATS_WINDOW) -> DataFrame:
    """Statistics published within an interval before ``as_of`` (default: now)."""
    if as_of is None:
        as_of = F.current_timestamp()
    elif isinstance(as_of, datetime):
        as_of = F.lit(as_of)
    since = as_of - F.expr(f"INTERVAL {within}")
    # The same bound on the partition column: older days are not opened.
    return stats.where((F.col("aggregation_time") >= since) & (F.col("aggregation_date") >= F.to_date(since)))


def recent_stats(stats: DataFrame, as_of=None, within: str = STATS_WINDOW) -> DataFrame:
    columns = ["event_type", "device", "event_count", "aggregation_time"]
    chosen = recent(stats, as_of, within).select(*columns)
    return chosen.orderBy(F.desc("aggregation_time"), "event_type", "device")


def device_totals(stats: DataFrame, event_type: str, as_of=None, within: str = STATS_WINDOW) -> DataFrame:
    """Total count of one event type per device and publication."""
    chosen = recent(stats, as_of, within).where(F.col("event_type") == event_type)
    totals = chosen.groupBy("device", "aggregation_time").agg(F.sum("event_count").alias("total_count"))
    return totals.orderBy(F.desc("aggregation_time"), "device")


def popular_combos(stats: DataFrame, as_of=None, within: str = STATS_WINDOW) -> DataFrame:
    """Event type and device pairs by total count."""
    chosen = recent(stats, as_of, within).groupBy("event_type", "device")
    totals = chosen.agg(F.sum("event_count").alias("total_count"))
    return totals.orderBy(F.desc("total_count"), "event_type", "device")


# --- as-of and history ---------------------------------------------------------------------------


def raw_as_of(
    raw: DataFrame, batch_id: int | None = None, ingested_at: datetime | Column | None = None
) -> DataFrame:
    """Raw records as they stood after a batch, or at a time."""
    if batch_id is not None:
        raw = raw.where(F.col("ingestion_batch_id") <= batch_id)
    if ingested_at is not None:
        moment = ingested_at if isinstance(ingested_at, Column) else F.lit(ingested_at)
        raw = raw.where(F.col("ingested_at") <= moment)
    return raw


def ingest_history(raw: DataFrame) -> DataFrame:
    """What each batch brought."""
    return raw.groupBy("ingestion_batch_id").agg(
        _rows("records"),
        F.count_if(F.col("parse_status") == "parsed").alias("parsed"),
        F.min("kafka_timestamp").alias("first_record"),
        F.max("kafka_timestamp").alias("last_record"),
    )


def partition_stats(events: DataFrame, partition: str = "event_date") -> DataFrame:
    return events.groupBy(partition).agg(_rows("records"))
