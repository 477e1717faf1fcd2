"""Windowed campaign metrics and device statistics; the same code serves streams and tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.events import is_click, is_conversion
from tidemark.schemas import METRIC_WINDOW, METRICS, STATS, STATS_WINDOW


def derived_metrics(clicks: Column, conversions: Column) -> dict[str, Column]:
    """Count arithmetic within one window; conversions beyond the clicks are orphans."""
    attributed = F.least(clicks, conversions)
    rate = F.when(clicks > 0, attributed.cast("double") / clicks).otherwise(F.lit(0.0))
    return {
        "attributed_conversions": attributed,
        "orphan_conversions": F.greatest(conversions - clicks, F.lit(0).cast("long")),
        "conversion_rate": rate,
    }


def campaign_metrics(
    events: DataFrame, window: str = METRIC_WINDOW, aggregation_time: Column | None = None
) -> DataFrame:
    """Clicks and conversions per tumbling window and campaign, with the derived metrics.

    Counts are combined before the shuffle, so a hot campaign costs one partial row per task.
    """
    relevant = events.where(is_click() | is_conversion())
    counts = (
        relevant.select("event_timestamp", "campaign_id", "event_type")
        .groupBy(F.window("event_timestamp", window).alias("bucket"), "campaign_id")
        .agg(F.count_if(is_click()).alias("clicks"), F.count_if(is_conversion()).alias("conversions"))
    )
    moment = F.current_timestamp() if aggregation_time is None else aggregation_time
    return counts.select(
        F.col("bucket.start").alias("window_start"),
        F.col("bucket.end").alias("window_end"),
        F.to_date("bucket.start").alias("window_date"),
        "campaign_id",
        "clicks",
        "conversions",
        *[c.alias(n) for n, c in derived_metrics(F.col("clicks"), F.col("conversions")).items()],
        moment.alias("aggregation_time"),
    ).select(*METRICS.columns)


def device_stats(
    events: DataFrame, window: str = STATS_WINDOW, aggregation_time: Column | None = None
) -> DataFrame:
    """Events per tumbling window, event type and device."""
    counts = events.groupBy(
        F.window("event_timestamp", window).alias("bucket"), "event_type", "device"
    ).agg(F.count(F.lit(1)).alias("event_count"))
    moment = F.current_timestamp() if aggregation_time is None else aggregation_time
    return counts.select(
        F.col("bucket.start").alias("window_start"),
        F.col("bucket.end").alias("window_end"),
        "event_type",
        "device",
        "event_count",
        moment.alias("aggregation_time"),
        F.to_date(moment).alias("aggregation_date"),
    ).select(*STATS.columns)


def latest_snapshot(stats: DataFrame) -> DataFrame:
    """Last published count per window, event type and device."""
    keys = ["window_start", "window_end", "event_type", "device"]
    # A time is part of the key, so there are no ties. Both have fixed widths, which hash aggregates need.
    newest = F.max_by("event_count", "aggregation_time").alias("event_count")
    return stats.groupBy(*keys).agg(newest, F.max("aggregation_time").alias("aggregation_time"))
