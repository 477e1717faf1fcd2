"""Live queries driven from Parquet file streams."""

import time
from datetime import datetime, timedelta, timezone

import pytest
from pyspark.sql import functions as F

from tidemark.operators import tables
from tidemark.plans import reconcile, reports, suite
from tidemark.functions.frames import encode_frame
from tidemark.operators.metrics import latest_snapshot
from tidemark.schemas import CURATED, LATE, METRICS, RAW, STATS, TOPIC_SCHEMA, avro_schema
from tidemark.session import scratch_path
from tidemark.sources import sample
from tidemark.sources.topic import FileSource, TopicSource, read_event_stream
from tidemark.streaming import queries as streams

SMALL = "/root/testdata/sf0.001"
DAY = datetime(2026, 5, 1, tzinfo=timezone.utc)


def at(clock):
    h, m, s = map(int, clock.split(":"))
    return DAY + timedelta(hours=h, minutes=m, seconds=s)


def events(spark, rows):
    """(offset, clock, campaign, type) to events."""
    data = [
        (o, f"e{o}", at(c).isoformat(), "u1", g, 1, "mobile", "US", k, None, None, None, None, None, at(c))
        for o, c, g, k in rows
    ]
    ddl = (
        "o LONG, event_id STRING, event_time STRING, user_id STRING, campaign_id INT, ad_id INT, "
        "device STRING, country STRING, event_type STRING, ad_creative_id STRING, engagement_score FLOAT, "
        "user_segment STRING, conversion_value DOUBLE, geo_latitude DOUBLE, arrived TIMESTAMP"
    )
    return spark.createDataFrame(data, ddl)


def records(spark, rows, arrival="arrived"):
    return events(spark, rows).select(
        F.col("user_id").cast("binary").alias("key"),
        encode_frame(avro_schema(3), 3).alias("value"),
        F.lit("ads").alias("topic"),
        F.lit(0).alias("partition"),
        F.col("o").alias("offset"),
        F.col(arrival).alias("timestamp"),
        F.lit(0).alias("timestampType"),
    )


def feed(spark, folder, batches):
    """One file per batch, in order of modification time."""
    for batch in batches:
        records(spark, batch).select(*TOPIC_SCHEMA.fieldNames()).coalesce(1).write.mode("append").parquet(folder)
        time.sleep(0.05)


LATE_TRACE = [
    ["12:00:10"],
    ["12:00:11"],
    ["09:59:59", "10:00:05", "10:00:15"],
    ["13:00:10"],
    ["10:30:00", "11:30:00"],
    ["10:30:01"],
]
LATE_EMITTED = [
    [("12:00:00", 1)],
    [("12:00:00", 2)],
    [("10:00:00", 2)],
    [("13:00:00", 1)],
    [("10:30:00", 1), ("11:30:00", 1)],
    [],
]
LATE_DROPPED = [0, 0, 1, 0, 0, 1]


def late_batches(kind="click"):
    offset = iter(range(100))
    return [[(next(offset), clock, 1, kind) for clock in batch] for batch in LATE_TRACE]


def test_late_data_trace(spark, lake):
    """Late rows are dropped live by the previous batch's watermark, and recovered by the daily job."""
    folder = scratch_path(spark, "topic")
    feed(spark, folder, late_batches())
    stream = read_event_stream(spark, FileSource(folder, max_files=1))
    emitted = {}

    def keep(batch, batch_id):
        # One action only: each would run the batch, and count its dropped rows, again.
        rows = batch.select("window_start", "clicks").collect()
        emitted[batch_id] = sorted((r["window_start"].strftime("%H:%M:%S"), r["clicks"]) for r in rows)

    live = streams.live_metrics(stream, sample.version_decoder())
    query = (
        live.writeStream.foreachBatch(keep)
        .outputMode("update")
        .option("checkpointLocation", scratch_path(spark, "checkpoint"))
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    with_rows = [p for p in query.recentProgress if p["numInputRows"]]
    assert [emitted[p["batchId"]] for p in with_rows] == LATE_EMITTED
    dropped = [p["stateOperators"][0]["numRowsDroppedByWatermark"] for p in with_rows]
    assert dropped == LATE_DROPPED

    ingest = streams.start_ingest(
        read_event_stream(spark, FileSource(folder)), lake, sample.version_decoder(),
        scratch_path(spark, "checkpoint"), None, name="trace_ingest",
    )
    ingest.awaitTermination()
    assert reconcile.reconcile_day(lake, DAY.date()) == (9, 6)
    found = lake.read(METRICS).orderBy("window_start").collect()
    assert [(r["window_start"].strftime("%H:%M:%S"), r["clicks"]) for r in found] == [
        ("09:59:30", 1),
        ("10:00:00", 2),
        ("10:30:00", 2),
        ("11:30:00", 1),
        ("12:00:00", 2),
        ("13:00:00", 1),
    ]


def test_views_do_not_move_the_watermark(spark):
    folder = scratch_path(spark, "topic")
    feed(spark, folder, [[(0, "12:00:00", 1, "click")], [(1, "18:00:00", 1, "view")], [(2, "11:00:00", 1, "click")],
                         [(3, "11:00:01", 1, "click")]])
    stream = read_event_stream(spark, FileSource(folder, max_files=1))
    live = streams.live_metrics(stream, sample.version_decoder())
    seen = []
    query = (
        live.writeStream.foreachBatch(lambda batch, _: seen.extend(batch.select("clicks").collect()))
        .outputMode("update")
        .option("checkpointLocation", scratch_path(spark, "checkpoint"))
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    assert [r["clicks"] for r in seen] == [1, 1, 2]


def test_repeated_ids_count_unless_deduped(spark, lake):
    folder = scratch_path(spark, "topic")
    twice = [(0, "12:00:00", 1, "click")]
    feed(spark, folder, [twice, twice])
    for dedupe, clicks in ((False, 2), (True, 1)):
        stream = read_event_stream(spark, FileSource(folder, max_files=1))
        live = streams.live_metrics(stream, sample.version_decoder(), dedupe=dedupe)
        query = streams.start_metrics(
            live, lake, scratch_path(spark, "checkpoint"), None, name=f"dedupe_{dedupe}"
        )
        query.awaitTermination()
        assert lake.read(METRICS).first()["clicks"] == clicks


def test_run_both_then_continue_from_checkpoint(spark, lake):
    """Stream and batch agree when nothing is late; a restart takes only what is new."""
    folder, checkpoints = scratch_path(spark, "topic"), scratch_path(spark, "checkpoint")
    kinds = ("click", "purchase", "view")
    rows = [(i, f"12:{i % 60:02d}:{i % 59:02d}", i % 4, kinds[i % 3]) for i in range(120)]
    feed(spark, folder, [rows[:80]])
    report = streams.run(spark, FileSource(folder), lake, checkpoints, trigger=None, stats=True)
    assert report == dict.fromkeys([streams.INGEST_QUERY, streams.METRICS_QUERY, streams.STATS_QUERY])
    assert lake.read(RAW).count() == 80
    feed(spark, folder, [rows[80:]])
    streams.run(spark, FileSource(folder), lake, checkpoints, trigger=None)
    assert lake.read(RAW).count() == 120 and lake.read(CURATED).count() == 120
    batches = reports.ingest_history(lake.read(RAW)).select("records").collect()
    assert sorted(r[0] for r in batches) == [40, 80]

    live = lake.read(METRICS).drop("aggregation_time").collect()
    reconcile.reconcile_day(lake, DAY.date())
    assert sorted(map(tuple, live)) == sorted(map(tuple, lake.read(METRICS).drop("aggregation_time").collect()))


def test_statistics_are_kept_as_snapshots(spark, lake):
    """A window that changes again gets a second, larger snapshot; replays add nothing."""
    folder, checkpoints = scratch_path(spark, "topic"), scratch_path(spark, "checkpoint")
    feed(spark, folder, [[(0, "12:00:00", 1, "view")], [(1, "12:04:59", 1, "view"), (2, "12:05:00", 1, "click")]])
    stream = read_event_stream(spark, FileSource(folder, max_files=1))
    query = streams.start_stats(streams.live_stats(stream, sample.version_decoder()), lake, checkpoints, None)
    query.awaitTermination()
    kept = lake.read(STATS)
    assert sorted(r["event_count"] for r in kept.where("event_type = 'view'").collect()) == [1, 2]
    last = latest_snapshot(kept).orderBy("window_start").collect()
    assert [(r["window_start"].minute, r["event_type"], r["event_count"]) for r in last] == [
        (0, "view", 2),
        (5, "click", 1),
    ]
    streams.stats_batch(kept.checkpoint(), 1, lake)
    assert lake.read(STATS).count() == 3


def test_replayed_batch_changes_nothing(spark, lake):
    decoder = sample.version_decoder()
    batch = records(spark, [(i, f"12:00:{i:02d}", 1, "click") for i in range(10)])
    broken = batch.limit(1).withColumns({"value": F.lit(b"junk!"), "offset": F.lit(99).cast("long")})
    batch = batch.unionByName(broken)
    moment = datetime(2026, 5, 2, tzinfo=timezone.utc)
    quality = streams.ingest_batch(batch, 3, lake, decoder, ingested_at=moment)
    assert quality == {"total": 11, "valid": 10, "corrupted": 1}
    before = [sorted(map(str, lake.read(s).collect())) for s in (RAW, CURATED)]
    streams.ingest_batch(batch, 3, lake, decoder, ingested_at=moment)
    assert [sorted(map(str, lake.read(s).collect())) for s in (RAW, CURATED)] == before
    assert len(before[0]) == 11 and len(before[1]) == 10


def test_empty_batch_writes_nothing(spark, lake):
    nothing = records(spark, [(0, "12:00:00", 1, "click")]).where(F.lit(False))
    assert streams.ingest_batch(nothing, 0, lake, sample.version_decoder())["total"] == 0
    assert streams.metrics_batch(lake.read(METRICS), 0, lake) == 0
    assert lake.read(RAW).count() == 0


def test_late_table_and_quarantine(spark, lake):
    rows = events(spark, [(0, "08:00:00", 1, "click"), (1, "11:30:00", 1, "click")])
    noon = F.lit(at("12:00:00"))
    batch = records(spark, [(0, "08:00:00", 1, "click"), (1, "11:30:00", 1, "click")]).withColumn("timestamp", noon)
    bad = batch.limit(1).withColumns({"value": F.lit(None).cast("binary"), "offset": F.lit(7).cast("long")})
    path = scratch_path(spark, "quarantine")
    options = streams.IngestOptions(separate_late=True, quarantine=path)
    for _ in range(2):  # a replay must not quarantine a record twice
        streams.ingest_batch(batch.unionByName(bad), 0, lake, sample.version_decoder(), options)
    assert [r["event_id"] for r in lake.read(CURATED).collect()] == ["e1"]
    assert [r["event_id"] for r in lake.read(LATE).collect()] == ["e0"]
    held = spark.read.json(path)
    assert [(r["kafka_offset"], r["parse_status"]) for r in held.collect()] == [(7, "deserialization_failed")]
    assert rows.count() == 2


def test_failure_is_reported_and_the_other_query_stopped(spark, lake):
    folder = scratch_path(spark, "topic")
    feed(spark, folder, [[(0, "12:00:00", 1, "click")]])
    tables.drop_table(spark, lake.name(METRICS))
    with pytest.raises(Exception):
        streams.run(spark, FileSource(folder), lake, scratch_path(spark, "checkpoint"), trigger="1 second")
    assert not [q for q in spark.streams.active if q.name in (streams.INGEST_QUERY, streams.METRICS_QUERY)]


def test_topic_options():
    options = TopicSource("a:1,b:2").options()
    assert options["subscribe"] == "ads_events" and options["startingOffsets"] == "earliest"
    assert options["failOnDataLoss"] == "true" and "maxOffsetsPerTrigger" not in options
    loose = TopicSource("a:1", max_offsets=5, fail_on_data_loss=False).options()
    assert (loose["failOnDataLoss"], loose["maxOffsetsPerTrigger"]) == ("false", "5")


REQUIRED = ["--servers", "a:1", "--checkpoints", "/cp", "--location", "/lake"]


def test_flags_of_the_live_job(spark):
    plain = streams.arguments(REQUIRED)
    assert streams.source_of(plain) == TopicSource("a:1")
    assert streams.options_of(plain) == streams.IngestOptions()
    path = scratch_path(spark, "schemas")
    text = f'{{"7": {avro_schema(1)}}}'
    spark.createDataFrame([(text,)], "line STRING").coalesce(1).write.text(path)
    args = streams.arguments(
        [*REQUIRED, "--max-offsets", "9", "--tolerate-data-loss", "--schemas", path, "--separate-late", "--match-days", "3"]
    )
    assert streams.source_of(args) == TopicSource("a:1", max_offsets=9, fail_on_data_loss=False)
    assert streams.options_of(args).separate_late and streams.options_of(args).curated_match_where is not None
    decoder = streams.decoder_of(spark, args)
    assert set(decoder.writers) == {7} and len(decoder.writers[7]) == 9 and len(decoder.default) == 13
    with pytest.raises(SystemExit):
        streams.arguments(REQUIRED[:4])


def test_all_queries_are_stopped_though_one_cannot_be():
    class Query:
        isActive = True
        stopped = False

        def __init__(self, name, failure, stops):
            self.name, self.failure, self.stops = name, failure, stops

        def exception(self):
            return self.failure

        def stop(self):
            self.stopped = True
            if not self.stops:
                raise RuntimeError("cannot stop")

    queries = [Query("a", "first failure", False), Query("b", None, False), Query("c", None, True)]
    assert streams.stop_all(queries) == {"a": "first failure", "b": "cannot stop", "c": None}
    assert all(q.stopped for q in queries)


def test_a_batch_from_one_file_is_decoded_by_several_tasks(spark, monkeypatch):
    lake, _ = suite.workspace(spark, RAW, CURATED)
    given, plain = [], streams.decode_records
    monkeypatch.setattr(streams, "decode_records", lambda rows, decoder: given.append(rows) or plain(rows, decoder))
    settings = ["spark.sql.adaptive.advisoryPartitionSizeInBytes", "spark.sql.adaptive.coalescePartitions.minPartitionSize"]
    before = [spark.conf.get(s) for s in settings]
    for setting in settings:
        spark.conf.set(setting, "4k")
    try:
        rows = sample.topic_records(sample.driver_events(spark, SMALL)).coalesce(1)
        streams.ingest_batch(rows, 0, lake, sample.version_decoder())
        assert given[0].rdd.getNumPartitions() > 1
    finally:
        for setting, value in zip(settings, before, strict=True):
            spark.conf.set(setting, value)
    assert lake.read(RAW).count() == rows.count()


def test_more_events_come_in_more_files_of_each_trigger(spark, monkeypatch):
    """No file grows with the table, and a trigger still takes its part whole."""
    want = sorted(map(tuple, suite.REGISTRY["stream_metrics_late"](spark, SMALL).collect()))
    topics, plain = [], suite._append
    monkeypatch.setattr(suite, "_append", lambda rows, topic: plain(rows, topic) or topics.append(topic))
    monkeypatch.setattr(suite, "FILE_ROWS", 100, raising=False)
    assert sorted(map(tuple, suite.REGISTRY["stream_metrics_late"](spark, SMALL).collect())) == want
    files = spark.read.parquet(topics[0]).groupBy(F.input_file_name()).count().collect()
    assert len(set(topics)) == 1 and max(n for _, n in files) <= 100
