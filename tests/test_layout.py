"""Second partition levels, Bloom filters, the zone map, conditional upserts and counts in passing."""

from dataclasses import replace
from datetime import date, datetime, timedelta, timezone

import pytest
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.operators import ingest, tables
from tidemark.plans import reconcile
from tidemark.plans.suite import workspace
from tidemark.schemas import CURATED, METRICS, RAW, by_id
from tidemark.streaming import queries as streams

DAYS, BUCKETS = 100, 4
FIRST = date(2026, 1, 1)


def scan_of(frame: DataFrame):
    """The file scan of a query that has run, and the rows that came out of it."""
    frame.collect()
    leaf = frame._jdf.queryExecution().executedPlan().collectLeaves().apply(0)
    return leaf, leaf.metrics().apply("numOutputRows").value()


@pytest.fixture(scope="module")
def hundred_days(spark):
    """Twenty events a day, in four buckets each."""
    spec = replace(CURATED, levels=(by_id("event_id", BUCKETS),))
    lake, _ = workspace(spark, spec)
    rows = spark.range(DAYS * 20).selectExpr(
        "concat('e', id) event_id", f"date_add(date'{FIRST}', cast(id % {DAYS} as int)) event_date", "1L ingestion_batch_id"
    )
    tables.append(rows, lake.name(spec))
    return lake, spec


def bucket(spark, ids):
    rows = spark.createDataFrame([(i,) for i in ids], "event_id STRING")
    return {r[0]: r[1] for r in rows.select("event_id", F.expr(by_id("event_id", BUCKETS).expression)).collect()}


def files(lake, spec):
    stored = lake.spark.table(lake.name(spec))
    rows = stored.select("event_date", "id_bucket", F.input_file_name().alias("file")).distinct().collect()
    return {(r.event_date, r.id_bucket): r.file for r in rows}


def test_a_batch_of_ids_touches_only_their_buckets(spark, hundred_days):
    """A thousand ids of one bucket over a hundred days: three quarters of the files are neither read nor written."""
    lake, spec = hundred_days
    ids = [f"e{i}" for i in range(DAYS * 20)] + [f"new{i}" for i in range(6000)]
    of = bucket(spark, ids)
    mine = [i for i in ids if of[i] == 2][:1000]
    known = {i: FIRST + timedelta(days=int(i[1:]) % DAYS) for i in mine if i.startswith("e")}
    change = spark.createDataFrame([(i, known.get(i, FIRST), 7) for i in mine], "event_id STRING, event_date DATE, ingestion_batch_id LONG")

    form, target = tables.layout(spark, lake.name(spec)), spark.table(lake.name(spec))
    rows = form.shaped(change, target.schema)
    profile, parts = tables._profile(rows, spec.key, form.partitions)
    looked_up = tables.lookup(target, rows, profile, parts, spec.key, form)
    assert len(looked_up.inputFiles()) == len({k for k in files(lake, spec) if k[1] == 2})

    before = files(lake, spec)
    result = tables.upsert_spec(change, lake, spec)
    after = files(lake, spec)
    assert result.rows == 1000 and {b for _, b in result.rewritten} == {2}
    assert {k for k in after if after[k] != before.get(k)} <= set(result.rewritten) | {(FIRST, 2)}
    stored = lake.read(spec).collect()
    assert len(stored) == DAYS * 20 + 1000 - len(known)
    assert {r.event_id for r in stored if r.ingestion_batch_id == 7} == set(mine)
    assert lake.read(spec).columns == spec.columns


def test_one_repeated_event_rewrites_one_bucket(spark, hundred_days):
    lake, spec = hundred_days
    day = FIRST + timedelta(days=5)
    again = spark.createDataFrame([("e1005", day, 9)], "event_id STRING, event_date DATE, ingestion_batch_id LONG")
    assert tables.upsert_spec(again, lake, spec).rewritten == ((day, bucket(spark, ["e1005"])["e1005"]),)


def test_an_event_that_moves_leaves_its_old_day(spark, hundred_days):
    lake, spec = hundred_days
    later = FIRST + timedelta(days=50)
    moved = spark.createDataFrame([("e1117", later, 9)], "event_id STRING, event_date DATE, ingestion_batch_id LONG")
    tables.upsert_spec(moved, lake, spec)
    assert [r.event_date for r in lake.read(spec).where("event_id = 'e1117'").collect()] == [later]


def test_bloom_filters_skip_row_groups(spark, lake):
    """Absent ids that lie between the smallest and the largest one: only a filter can tell."""
    rows = spark.range(4000).selectExpr("sha2(cast(id as string), 256) event_id", "date'2026-05-01' event_date")
    tables.append(rows, lake.name(CURATED))
    absent = [r[0] for r in spark.range(9000, 9050).selectExpr("sha2(cast(id as string), 256)").collect()]
    table = spark.table(lake.name(CURATED))
    scan, read = scan_of(table.where(F.col("event_id").isin(*absent)).select("event_id"))
    assert read == 0
    present = [r[0] for r in spark.range(3).selectExpr("sha2(cast(id as string), 256)").collect()]
    found = table.where(F.col("event_id").isin(*absent, *present)).select("event_id")
    _, read = scan_of(found)
    assert 3 <= read < 4000 and found.count() == 3


def test_large_batches_are_looked_up_by_join(spark, lake, monkeypatch):
    monkeypatch.setattr(tables, "LISTED_KEYS", 10)
    rows = spark.range(200).selectExpr("concat('k', id) event_id", "date'2026-05-01' event_date", "id ingestion_batch_id")
    for batch in (rows, rows.selectExpr("event_id", "event_date", "-1L ingestion_batch_id")):
        tables.upsert_spec(batch, lake, CURATED)
    assert lake.read(CURATED).groupBy("ingestion_batch_id").count().collect()[0][:] == (-1, 200)


# --- metrics by hour -------------------------------------------------------------------------------


def window(spark, rows):
    """(hour, campaign, clicks, aggregated at this second)"""
    at = datetime(2026, 5, 2, tzinfo=timezone.utc)
    data = [
        (at + timedelta(hours=h), at + timedelta(hours=h, seconds=30), date(2026, 5, 2), c, n, at + timedelta(days=1, seconds=s))
        for h, c, n, s in rows
    ]
    ddl = "window_start TIMESTAMP, window_end TIMESTAMP, window_date DATE, campaign_id INT, clicks LONG, aggregation_time TIMESTAMP"
    return spark.createDataFrame(data, ddl)


def clicks(lake):
    rows = lake.read(METRICS).select(F.hour("window_start").alias("h"), "campaign_id", "clicks").collect()
    return sorted(tuple(r) for r in rows)


def test_a_changed_window_rewrites_one_hour(spark, lake):
    streams.metrics_batch(window(spark, [(h, c, 1, 0) for h in range(24) for c in (1, 2)]), 0, lake)
    options = {"keys_unique": True, "partition_follows_key": True}
    result = tables.upsert_spec(window(spark, [(5, 1, 2, 1)]), lake, METRICS, **options)
    assert result.rewritten == ((date(2026, 5, 2), 5),)
    assert clicks(lake) == sorted([(h, c, 1) for h in range(24) for c in (1, 2) if (h, c) != (5, 1)] + [(5, 1, 2)])
    assert lake.read(METRICS).columns == METRICS.columns


def test_replacing_a_day_clears_hours_that_nothing_came_for(spark, lake):
    day = date(2026, 5, 2)
    tables.append(window(spark, [(h, 1, 1, 0) for h in range(24)]), lake.name(METRICS))
    assert tables.replace_partition(window(spark, [(3, 1, 9, 1), (4, 2, 9, 1)]), lake.name(METRICS), day) == 2
    assert clicks(lake) == [(3, 1, 9), (4, 2, 9)]
    assert tables.replace_partition(window(spark, []), lake.name(METRICS), day) == 0
    assert clicks(lake) == []
    tables.append(window(spark, [(h, 1, 1, 0) for h in range(24)]), lake.name(METRICS))
    tables.delete_partition(spark, lake.name(METRICS), day)
    assert clicks(lake) == []


def test_live_totals_never_replace_newer_or_reconciled_ones(spark, lake):
    tables.append(window(spark, [(1, 1, 10, 5), (2, 1, 10, 5)]), lake.name(METRICS))
    settled = window(spark, [(3, 1, 10, 5)]).withColumn("reconciled", F.lit(True))
    tables.append(settled, lake.name(METRICS))
    streams.metrics_batch(window(spark, [(1, 1, 11, 9), (2, 1, 11, 1), (3, 1, 11, 9), (4, 1, 11, 9)]), 3, lake)
    assert clicks(lake) == [(1, 1, 11), (2, 1, 10), (3, 1, 10), (4, 1, 11)]
    marks = lake.read(METRICS, hidden=True).where("reconciled").select(F.hour("window_start")).collect()
    assert [r[0] for r in marks] == [3]


def test_a_refused_row_changes_no_file(spark, lake):
    tables.append(window(spark, [(1, 1, 10, 5)]), lake.name(METRICS))
    before = lake.read(METRICS).inputFiles()
    result = tables.upsert_spec(
        window(spark, [(1, 1, 99, 1)]), lake, METRICS, replace_if=lambda old, new: new("clicks") < old("clicks")
    )
    assert (result.rows, result.rewritten) == (1, ()) and lake.read(METRICS).inputFiles() == before
    unknown = lambda old, new: F.lit(None).cast("boolean")
    tables.upsert_spec(window(spark, [(1, 1, 99, 9), (2, 1, 1, 1)]), lake, METRICS, replace_if=unknown)
    assert clicks(lake) == [(1, 1, 10), (2, 1, 1)]


def test_null_keys_pass_a_condition(spark, lake):
    rows = spark.sql("select cast(null as string) event_id, date'2026-05-01' event_date union all select 'a', date'2026-05-01'")
    for _ in range(2):
        tables.upsert_spec(rows, lake, CURATED, replace_if=lambda old, new: F.lit(True))
    assert sorted(str(r.event_id) for r in lake.read(CURATED).collect()) == ["None", "None", "a"]


# --- zone map --------------------------------------------------------------------------------------


def raw_rows(spark, days, arrived):
    """One event for each day, all of which came in on one date."""
    parts = [
        f"select '{{\"event_id\":\"e{d}\",\"campaign_id\":1,\"event_type\":\"click\",\"event_time\":\"{FIRST + timedelta(days=d)}T12:00:00Z\"}}' "
        f"payload, {n}L n" for n, d in enumerate(days)
    ]
    rows = spark.sql(" union all ".join(parts)).selectExpr(
        "'t' kafka_topic", "0 kafka_partition", "n kafka_offset", f"timestamp'{arrived} 13:00:00' kafka_timestamp",
        "0 kafka_timestamp_type", "cast(null as binary) key", "cast(null as binary) value", "payload deserialized_payload",
    )
    return ingest.raw_records(ingest.with_parsed(rows), 1, datetime(2026, 6, 1, tzinfo=timezone.utc), hidden=True)


def test_the_daily_job_reads_its_day(spark, lake):
    """Days of on-time records are skipped; a skewed clock and rows older than the column are found."""
    for d in range(10):
        tables.append(raw_rows(spark, [d], FIRST + timedelta(days=d)), lake.name(RAW))
    tables.append(raw_rows(spark, [4, 30], FIRST + timedelta(days=60)), lake.name(RAW))  # skewed
    old = raw_rows(spark, [4], FIRST + timedelta(days=70)).drop("event_date")  # before the column existed
    tables.append(old.withColumn("deserialized_payload", F.regexp_replace("deserialized_payload", "e4", "e44")), lake.name(RAW))
    day = FIRST + timedelta(days=4)
    raw = lake.read(RAW, hidden=True)
    found = reconcile.curated_from_raw(raw, day)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(event_date," in plan and "IsNull(event_date)" in plan
    assert sorted(r.event_id for r in found.collect()) == ["e4", "e44"]
    assert sorted(r.event_id for r in reconcile.curated_from_raw(raw.drop("event_date"), day).collect()) == ["e4", "e44"]
    pruned = raw.where((F.col("event_date") == F.lit(day)) | F.col("event_date").isNull()).select("kafka_offset")
    _, read = scan_of(pruned)
    assert read <= 4  # of 13


def test_records_without_an_event_have_their_own_date(spark):
    rows = spark.sql("select 't' kafka_topic, 0 kafka_partition, 1L kafka_offset, timestamp'2026-05-03 01:00:00' kafka_timestamp, "
                     "0 kafka_timestamp_type, cast(null as binary) key, cast(null as binary) value, 'junk' deserialized_payload")  # fmt: skip
    raw = ingest.raw_records(ingest.with_parsed(rows), 1, hidden=True).first()
    assert raw.event_date == date(2026, 5, 3) and raw.parse_status == "missing_event_id"


# --- counts in passing -----------------------------------------------------------------------------


def jobs_of(spark, work):
    """Result and number of jobs."""
    group = f"group-{id(work)}"
    spark.sparkContext.setJobGroup(group, "counted")
    try:
        return work(), len(spark.sparkContext.statusTracker().getJobIdsForGroup(group))
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


def test_rows_are_counted_as_they_are_written(spark, lake, monkeypatch):
    def no_count(self):
        raise AssertionError("an extra pass")

    rows = window(spark, [(h, 1, 1, 0) for h in range(3)]).coalesce(1)
    monkeypatch.setattr(type(rows), "count", no_count)
    spark.conf.set("spark.sql.adaptive.enabled", "false")  # where every stage would be a job
    try:
        written, jobs = jobs_of(spark, lambda: tables.replace_partition(rows, lake.name(METRICS), date(2026, 5, 2)))
        # With one exchange: what finds hot partitions, and the write.
        assert written == 3 and jobs == 2
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    monkeypatch.undo()
    assert lake.read(METRICS).count() == 3


def test_affected_windows_are_a_set_not_a_range(spark):
    events = spark.createDataFrame(
        [
            ("a", 1, "click", datetime(2026, 5, 1, 10, 0, 10), datetime(2026, 5, 1, 10, 1)),  # on time
            ("b", 1, "click", datetime(2026, 5, 1, 6, 0, 10), datetime(2026, 5, 1, 10, 1)),  # late, same date
            ("c", 1, "purchase", datetime(2026, 5, 1, 6, 0, 20), datetime(2026, 5, 1, 10, 1)),  # same window
            ("d", 2, "click", datetime(2026, 4, 3, 6, 0, 10), datetime(2026, 5, 1, 10, 1)),  # long ago
            ("e", 3, "click", datetime(2026, 4, 30, 23, 59, 50), datetime(2026, 5, 1, 0, 1)),  # another date, hardly late
            ("f", 4, "view", datetime(2026, 4, 3, 6, 0, 10), datetime(2026, 5, 1, 10, 1)),  # counts nowhere
        ],
        "event_id STRING, campaign_id INT, event_type STRING, event_timestamp TIMESTAMP, arrival TIMESTAMP",
    )
    rows = reconcile.affected_windows(events, "arrival", "2 hours").collect()
    found = sorted((r.campaign_id, r.window_date, r.reconciled) for r in rows)
    assert found == [(1, date(2026, 5, 1), False), (2, date(2026, 4, 3), True), (3, date(2026, 4, 30), True)]


def test_other_windows_are_left_alone(spark, lake):
    """A correction between two windows of one campaign does not touch what lies between."""
    at = datetime(2026, 5, 1, 12, tzinfo=timezone.utc)
    events = [(f"e{i}", 1, "click", at + timedelta(minutes=i)) for i in range(10)]
    rows = spark.createDataFrame(events, "event_id STRING, campaign_id INT, event_type STRING, event_timestamp TIMESTAMP")
    tables.append(rows.withColumn("event_date", F.to_date("event_timestamp")), lake.name(CURATED))
    windows = rows.where("event_id in ('e0', 'e9')").selectExpr(
        "campaign_id", "event_timestamp window_start", "to_date(event_timestamp) window_date", "false reconciled"
    )
    assert reconcile.recompute_windows(lake, windows) == 2
    assert sorted(r.window_start.minute for r in lake.read(METRICS).collect()) == [0, 9]
    assert reconcile.recompute_windows(lake, windows.where("false")) == 0
