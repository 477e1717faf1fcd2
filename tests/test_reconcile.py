"""Daily rebuild, as-of states and range recomputation."""

from datetime import date, datetime, timezone

import pytest
from pyspark.sql import functions as F

from tidemark.functions.events import parse_status, with_parsed
from tidemark.operators import tables
from tidemark.operators.metrics import campaign_metrics
from tidemark.plans import reconcile, reports
from tidemark.schemas import CURATED, METRICS, RAW

DAY = date(2026, 5, 1)
LOADED = datetime(2026, 5, 2, 3, tzinfo=timezone.utc)


def raw(spark, rows):
    """(offset, batch, event id, time text, campaign, type) to raw records."""
    texts = [
        (o, b, '{"event_id":"%s","event_time":"%s","campaign_id":%s,"event_type":"%s","ad_id":1}' % (e, t, c, k))
        for o, b, e, t, c, k in rows
    ]
    data = with_parsed(spark.createDataFrame(texts, "o LONG, b LONG, deserialized_payload STRING"))
    return data.select(
        F.lit("ads").alias("kafka_topic"),
        F.lit(0).alias("kafka_partition"),
        F.col("o").alias("kafka_offset"),
        F.lit(LOADED).alias("kafka_timestamp"),
        F.lit(0).alias("kafka_timestamp_type"),
        F.lit(None).cast("binary").alias("key"),
        F.lit(None).cast("binary").alias("value"),
        "deserialized_payload",
        parse_status(F.col("deserialized_payload"), F.col("data")).alias("parse_status"),
        F.to_date(F.lit(LOADED)).alias("kafka_date"),
        F.col("b").alias("ingestion_batch_id"),
        F.lit(LOADED).alias("ingested_at"),
    )


ROWS = [
    (0, 0, "a", "2026-05-01T12:00:01Z", 1, "click"),
    (1, 0, "b", "2026-05-01T12:00:02Z", 1, "purchase"),
    (2, 1, "a", "2026-05-01T12:00:01Z", 1, "click"),  # delivered again
    (3, 1, "c", "2026-05-01T23:59:59.9Z", 2, "purchase"),
    (4, 1, "d", "2026-05-02T00:00:00Z", 2, "click"),  # next day
    (5, 2, "a", "2026-05-02T09:00:00Z", 1, "click"),  # same id on two days
    (6, 2, "e", "2026-05-01T12:00:03Z", "null", "click"),  # no campaign
    (7, 2, "f", "nonsense", 1, "click"),
    (8, 2, "g", "2026-05-01T12:00:04Z", 1, "view"),
]


def state(lake):
    events = lake.read(CURATED).select("event_id", "event_date", "ingestion_batch_id").collect()
    windows = lake.read(METRICS).drop("aggregation_time").collect()
    return sorted(map(tuple, events)), sorted(map(tuple, windows))


def test_reconcile_day(spark, lake):
    tables.append(raw(spark, ROWS), lake.name(RAW))
    wrong = campaign_metrics(
        spark.createDataFrame(
            [(datetime(2026, 5, 1, 8), 9, "click"), (datetime(2026, 5, 3, 8), 9, "click")],
            "event_timestamp TIMESTAMP, campaign_id INT, event_type STRING",
        )
    )
    tables.append(wrong, lake.name(METRICS))
    assert reconcile.reconcile_day(lake, DAY) == (4, 2)
    events, windows = state(lake)
    assert events == [("a", DAY, 0), ("b", DAY, 0), ("c", DAY, 1), ("g", DAY, 2)]
    assert [(w[0].isoformat(), w[3], w[4], w[5]) for w in windows] == [
        ("2026-05-01T12:00:00", 1, 1, 1),
        ("2026-05-01T23:59:30", 2, 0, 1),
        ("2026-05-03T08:00:00", 9, 1, 0),
    ]
    assert reconcile.reconcile_day(lake, DAY) == (4, 2)
    assert state(lake) == (events, windows)


def test_empty_day_is_cleared(spark, lake):
    old = campaign_metrics(
        spark.createDataFrame(
            [(datetime(2026, 5, 1, 8), 9, "click")],
            "event_timestamp TIMESTAMP, campaign_id INT, event_type STRING",
        )
    )
    tables.append(old, lake.name(METRICS))
    assert reconcile.reconcile_day(lake, DAY) == (0, 0)
    assert lake.read(METRICS).count() == 0


def test_record_date_bound_prunes_raw(spark, lake):
    tables.append(raw(spark, ROWS), lake.name(RAW))
    assert reconcile.curated_from_raw(lake.read(RAW), DAY, date(2026, 5, 2)).count() == 4
    assert reconcile.curated_from_raw(lake.read(RAW), DAY, date(2026, 5, 3)).count() == 0
    plan = reconcile.curated_from_raw(lake.read(RAW), DAY, date(2026, 5, 2))
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(kafka_date" in text and "EqualTo(parse_status,parsed)" in text
    assert text.count("from_json") == 1


def test_state_as_of_batch(spark):
    records = raw(spark, ROWS)
    seen = {}
    for batch in (0, 1, 2):
        rows = reconcile.curated_state(reports.raw_as_of(records, batch_id=batch)).collect()
        seen[batch] = {r["event_id"]: (r["event_date"].day, r["ingestion_batch_id"]) for r in rows}
    assert seen[0] == {"a": (1, 0), "b": (1, 0)}
    assert seen[1] == {"a": (1, 1), "b": (1, 0), "c": (1, 1), "d": (2, 1)}
    assert seen[2]["a"] == (2, 2) and set(seen[2]) == {"a", "b", "c", "d", "g"}
    before = reports.raw_as_of(records, ingested_at=datetime(2026, 5, 2, tzinfo=timezone.utc))
    assert before.count() == 0


def test_range_is_widened_to_whole_windows(spark, lake):
    times = ["11:59:59", "12:00:00", "12:00:29", "12:00:30", "12:00:59", "12:01:00"]
    rows = [(i, 0, f"e{i}", f"2026-05-01T{t}Z", 1, "click") for i, t in enumerate(times)]
    curated = reconcile.curated_state(raw(spark, rows))
    tables.append(curated, lake.name(CURATED))
    low = datetime(2026, 5, 1, 12, 0, 10, tzinfo=timezone.utc)
    high = datetime(2026, 5, 1, 12, 0, 30, tzinfo=timezone.utc)
    assert reconcile.recompute_range(lake, low, high) == 2
    assert reconcile.recompute_range(lake, low, high) == 2
    found = lake.read(METRICS).orderBy("window_start").collect()
    assert [(r["window_start"].second, r["clicks"]) for r in found] == [(0, 2), (30, 2)]


@pytest.mark.parametrize("text", ["2026-5-2", "20260502", "2026-13-01", "yesterday", ""])
def test_bad_dates(text):
    with pytest.raises(ValueError):
        reconcile.parse_day(text)


def test_good_date():
    assert reconcile.parse_day("2026-05-02") == date(2026, 5, 2)
    assert (date.today() - reconcile.yesterday()).days == 1


def test_flags_of_the_daily_job(spark):
    args = reconcile.arguments(
        ["--date", "2026-05-02", "--location", "/lake", "--since-kafka-date", "2026-05-01", "--match-days", "2"]
    )
    assert (args.date, args.since_kafka_date, args.match_days) == (date(2026, 5, 2), date(2026, 5, 1), 2)
    assert reconcile.match_bound(args.date, None) is None and reconcile.match_bound(args.date, 2) is not None
    with pytest.raises(SystemExit):
        reconcile.arguments(["--date", "2026-05-02"])
