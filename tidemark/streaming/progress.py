"""What running queries report: one row for each trigger, and their state right now."""

from __future__ import annotations

import logging
import threading
from collections import deque

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

log = logging.getLogger(__name__)

TRIGGERS = (
    "query STRING, run STRING, batch_id BIGINT, started STRING, input_rows BIGINT, late_rows BIGINT, "
    "state_rows BIGINT, duration_ms BIGINT, watermark STRING"
)


class TriggerLog(StreamingQueryListener):
    """Keeps the newest triggers of all queries of a session, and logs each of them.

    ``late_rows`` are what stateful operators dropped for being below the watermark; a windowed aggregate
    drops them after it combined them, so they are groups rather than records.
    """

    def __init__(self, keep: int = 10_000):
        self.triggers: deque[dict] = deque(maxlen=keep)
        self.failures: dict[str, str] = {}
        self.names: dict[str, str] = {}
        self.changed = threading.Condition()

    def onQueryStarted(self, event) -> None:
        self.names[str(event.runId)] = event.name
        log.info("%s started, run %s", event.name, event.runId)

    def onQueryProgress(self, event) -> None:
        p = event.progress
        row = {
            "query": p.name,
            "run": str(p.runId),
            "batch_id": p.batchId,
            "started": p.timestamp,
            "input_rows": p.numInputRows,
            "late_rows": sum(s.numRowsDroppedByWatermark for s in p.stateOperators),
            "state_rows": sum(s.numRowsTotal for s in p.stateOperators),
            "duration_ms": p.batchDuration,
            "watermark": p.eventTime.get("watermark"),
        }
        log.info("%(query)s batch %(batch_id)s: %(input_rows)s rows, %(late_rows)s late, %(duration_ms)s ms", row)
        with self.changed:
            self.triggers.append(row)
            self.changed.notify_all()

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        name = self.names.get(str(event.runId), str(event.runId))
        with self.changed:
            if event.exception:
                self.failures[name] = event.exception
            self.changed.notify_all()
        log.info("%s ended: %s", name, event.exception or "no failure")

    def rows(self, query: str | None = None) -> list[dict]:
        with self.changed:
            return [t for t in self.triggers if query in (None, t["query"])]

    def wait_for(self, query: str, batch_id: int, seconds: float = 60.0) -> None:
        """Events come some time after the trigger they tell of."""
        with self.changed:
            seen = self.changed.wait_for(
                lambda: any(t["query"] == query and t["batch_id"] >= batch_id for t in self.triggers), seconds
            )
        if not seen:
            raise TimeoutError(f"no report of batch {batch_id} of {query}")

    def frame(self, spark: SparkSession, query: str | None = None) -> DataFrame:
        names = [f.split()[0] for f in TRIGGERS.split(", ")]
        return spark.createDataFrame([tuple(t[n] for n in names) for t in self.rows(query)], TRIGGERS)


def status_of(queries: list[StreamingQuery]) -> dict[str, dict]:
    """What each query does at the moment."""
    out = {}
    for query in queries:
        last = query.lastProgress
        out[query.name] = {
            "active": query.isActive,
            "message": query.status["message"],
            "batch_id": last.batchId if last else None,
            "input_rows": last.numInputRows if last else None,
        }
    return out


def read_state(spark: SparkSession, checkpoints: str, query: str, batch_id: int | None = None) -> DataFrame:
    """Keys and values that a stateful query holds, from its checkpoint, as of its last or any kept batch."""
    reader = spark.read.format("statestore")
    if batch_id is not None:
        reader = reader.option("batchId", batch_id)
    return reader.load(f"{checkpoints.rstrip('/')}/{query}")


def state_operators(spark: SparkSession, checkpoints: str, query: str) -> DataFrame:
    """Stateful operators of a query with their number of partitions and first and last kept batch."""
    return spark.read.format("state-metadata").load(f"{checkpoints.rstrip('/')}/{query}")
