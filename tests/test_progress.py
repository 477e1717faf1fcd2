"""The record of triggers, the status of queries, and reading their state."""

import uuid
from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F

from tidemark.session import scratch_path
from tidemark.streaming.progress import TriggerLog, read_state, state_operators, status_of


def progress(name="q", batch=0, rows=5, late=(1, 2)):
    return SimpleNamespace(
        progress=SimpleNamespace(
            name=name, runId="r", batchId=batch, timestamp="t", numInputRows=rows, batchDuration=7,
            stateOperators=[SimpleNamespace(numRowsDroppedByWatermark=n, numRowsTotal=10) for n in late],
            eventTime={"watermark": "w"},
        )
    )


def test_newest_triggers_are_kept():
    log = TriggerLog(keep=2)
    for batch in range(3):
        log.onQueryProgress(progress(batch=batch))
    log.onQueryProgress(progress(name="other"))
    assert [(t["query"], t["batch_id"]) for t in log.rows()] == [("q", 2), ("other", 0)]
    assert log.rows("q")[0]["late_rows"] == 3 and log.rows("q")[0]["state_rows"] == 20
    log.wait_for("q", 2, 0)
    with pytest.raises(TimeoutError):
        log.wait_for("q", 3, 0.05)


def test_a_failing_query_is_noted(spark):
    log = TriggerLog()
    spark.streams.addListener(log)
    name = f"failing_{uuid.uuid4().hex[:8]}"
    try:
        rows = spark.readStream.format("rate").load().select(F.raise_error(F.lit("broken on purpose")).alias("x"))
        query = rows.writeStream.format("noop").queryName(name).option("checkpointLocation", scratch_path(spark, "cp")).start()
        with pytest.raises(Exception):
            query.awaitTermination(30)
        with log.changed:
            assert log.changed.wait_for(lambda: name in log.failures, 30)
        assert "broken on purpose" in log.failures[name]
        assert status_of([query])[name]["active"] is False
    finally:
        spark.streams.removeListener(log)


def test_state_of_each_batch(spark):
    folder, checkpoints, name = scratch_path(spark, "in"), scratch_path(spark, "cp"), f"sums_{uuid.uuid4().hex[:8]}"
    for n in (1, 2):
        spark.range(n * 3).selectExpr("id % 3 k").write.mode("append").parquet(folder)
        counts = spark.readStream.schema("k LONG").parquet(folder).groupBy("k").count()
        writer = counts.writeStream.outputMode("update").queryName(name).trigger(availableNow=True)
        writer.option("checkpointLocation", f"{checkpoints}/{name}").format("noop").start().awaitTermination()

    def sums(**options):
        rows = read_state(spark, checkpoints, name, **options).select("key.*", "value.*").collect()
        return sorted(tuple(r) for r in rows)

    assert sums() == [(0, 3), (1, 3), (2, 3)] and sums(batch_id=0) == [(0, 1), (1, 1), (2, 1)]
    assert state_operators(spark, checkpoints, name).first().operatorName == "stateStoreSave"
