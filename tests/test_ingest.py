"""Parse status, validity, dedupe, validation and lateness."""

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from tidemark.functions.events import event_time_of, parse_status, with_parsed
from tidemark.operators import ingest
from tidemark.schemas import CURATED, PAYLOAD_SCHEMA, RAW

STATUSES = [
    (None, "deserialization_failed"),
    ("", "json_parse_failed"),
    ("   ", "json_parse_failed"),
    ("not json", "missing_event_id"),
    ("null", "missing_event_id"),
    ("[]", "missing_event_id"),
    ("{}", "missing_event_id"),
    ('{"event_id":"a"', "missing_event_id"),
    ('{"event_id":"a","campaign_id":"xx"}', "parsed"),
    ('{"event_id":"a","campaign_id":5.5}', "parsed"),
    ('{"event_id":"a","campaign_id":5,"extra":1}', "parsed"),
    ('{"event_id":7}', "parsed"),
]


def parsed(spark, texts):
    rows = [(i, t) for i, t in enumerate(texts)]
    return with_parsed(spark.createDataFrame(rows, "i INT, deserialized_payload STRING"))


def test_parse_status(spark):
    data = parsed(spark, [t for t, _ in STATUSES])
    status = parse_status(F.col("deserialized_payload"), F.col("data"))
    seen = data.select("i", status.alias("s")).orderBy("i").collect()
    assert [r["s"] for r in seen] == [s for _, s in STATUSES]


def test_parsed_is_not_valid(spark):
    full = '{"event_id":7,"campaign_id":%s,"event_type":"click","event_time":"%s"}'
    texts = [full % ("5", "2026-04-18T12:00:00Z"), full % ('"5"', "2026-04-18"), full % ("5", "bad"), "{}", None]
    valid = ingest.valid_events(parsed(spark, texts), "i").collect()
    assert [(r["i"], r["event_id"]) for r in valid] == [(0, "7")]


@pytest.mark.parametrize(
    "text, hour",
    [
        ("2026-04-18T12:20:38.772786+00:00", 12),
        ("2026-04-18T12:20:38Z", 12),
        ("2026-04-18T12:20:38+02:00", 10),
        ("2026-04-18", 0),
        ("bad", None),
        ("", None),
    ],
)
def test_event_time(spark, text, hour):
    row = spark.range(1).select(F.hour(event_time_of(F.lit(text)))).first()
    assert row[0] == hour


def test_raw_records_keep_everything(spark):
    rows = [("t", 0, i, datetime(2026, 5, 1, 12), 0, b"k", b"v", t) for i, (t, _) in enumerate(STATUSES)]
    ddl = (
        "kafka_topic STRING, kafka_partition INT, kafka_offset LONG, kafka_timestamp TIMESTAMP, "
        "kafka_timestamp_type INT, key BINARY, value BINARY, deserialized_payload STRING"
    )
    raw = ingest.raw_records(with_parsed(spark.createDataFrame(rows, ddl)), 4)
    assert raw.columns == RAW.columns
    assert raw.count() == len(STATUSES)
    assert raw.select("ingestion_batch_id").distinct().collect()[0][0] == 4


def test_dedupe_takes_least_and_survives_a_hot_key(spark):
    """A third of all rows share one id; the plan combines them before the shuffle."""
    rows = spark.range(30_000).select(
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.col("id").cast("string")).alias("event_id"),
        (F.lit(50_000) - F.col("id")).alias("t"),
        F.col("id").alias("v"),
    )
    kept = ingest.dedupe(rows, "event_id", ("t",))
    plan = kept._jdf.queryExecution().executedPlan().toString()
    assert plan.count("partial_min") == 1 and "Window" not in plan
    assert kept.count() == 20_001
    assert kept.where("event_id = 'hot'").first()["v"] == 29_997
    assert ingest.dedupe_any(rows).count() == 20_001


def event(**changes):
    base = {
        "event_id": "e",
        "event_time": "2026-05-01T12:00:00Z",
        "user_id": "u",
        "campaign_id": 1,
        "ad_id": 1,
        "device": "mobile",
        "country": "US",
        "event_type": "view",
    }
    return {**dict.fromkeys(PAYLOAD_SCHEMA.fieldNames()), **base, **changes}


@pytest.mark.parametrize(
    "changes, version, broken",
    [
        ({}, 3, []),
        ({"engagement_score": 0.0}, 3, []),
        ({"engagement_score": 1.0, "conversion_value": 0.0}, 3, []),
        ({"engagement_score": 1.5}, 3, ["engagement_score_out_of_range"]),
        ({"engagement_score": -0.5}, 2, ["engagement_score_out_of_range"]),
        ({"engagement_score": 1.5, "conversion_value": -1.0}, 1, []),
        ({"conversion_value": -0.01}, 3, ["conversion_value_negative"]),
        ({"conversion_value": -0.01}, 2, []),
        ({"event_time": "soon", "device": None}, 3, ["device_missing", "event_time_unreadable"]),
        ({"event_time": None, "user_id": None}, 1, ["event_time_missing", "user_id_missing"]),
    ],
)
def test_violations(spark, changes, version, broken):
    row = spark.createDataFrame([event(**changes)], PAYLOAD_SCHEMA)
    assert ingest.with_violations(row, version).first()["violations"] == broken
    assert ingest.accepted(row, version).count() == (0 if broken else 1)


def test_lateness_boundary(spark):
    noon = datetime(2026, 5, 1, 12)
    arrivals = [noon, datetime(2026, 5, 1, 14), datetime(2026, 5, 1, 14, 0, 1), None]
    rows = [(i, noon, a) for i, a in enumerate(arrivals)]
    events = spark.createDataFrame(rows, "i INT, event_timestamp TIMESTAMP, arrival TIMESTAMP")
    on_time, late = ingest.split_late(events, "arrival")
    assert sorted(r["i"] for r in on_time.collect()) == [0, 1, 3]
    assert [r["i"] for r in late.collect()] == [2]


def test_upcast_fills_newer_fields(spark):
    old = spark.createDataFrame([("a", 1)], "event_id STRING, campaign_id INT")
    new = ingest.upcast(old)
    assert new.schema == PAYLOAD_SCHEMA or [f.name for f in new.schema] == PAYLOAD_SCHEMA.fieldNames()
    assert new.first()["geo_latitude"] is None


def test_curated_shape(spark):
    text = (
        '{"event_id":"a","campaign_id":5,"event_type":"click","event_time":"2026-05-01T23:59:59.5+00:00","ad_id":2}'
    )
    rows = ingest.curated_events(ingest.valid_events(parsed(spark, [text, text])), 9)
    (row,) = rows.collect()
    assert rows.columns == CURATED.columns
    assert row["event_date"].isoformat() == "2026-05-01" and row["ingestion_batch_id"] == 9
    assert row["event_time"] == row["event_timestamp"]
