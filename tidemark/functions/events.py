"""Column expressions over parsed events."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.schemas import (
    CLICK_EVENT_TYPES,
    CONVERSION_EVENT_TYPES,
    EVENT_FIELDS,
    LATEST_VERSION,
    PAYLOAD_SCHEMA,
)

VALID_FIELDS = ("event_id", "campaign_id", "event_type", "event_timestamp")


def parse_payload(payload: Column) -> Column:
    """JSON text to the fixed event struct; unknown fields are ignored, wrong types become null."""
    return F.from_json(payload, PAYLOAD_SCHEMA)


def with_parsed(records: DataFrame, payload: str = "deserialized_payload") -> DataFrame:
    """Add ``data``, parsed from the payload text once per row.

    The one-element explode is a fence: without it the optimizer copies the parse into every
    filter on a parsed field and each row is parsed several times.
    """
    return records.select("*", F.explode(F.array(parse_payload(F.col(payload)))).alias("data"))


def event_time_of(text: Column) -> Column:
    """ISO-8601 text to an instant, null where it does not parse."""
    return F.try_to_timestamp(text)


def parse_status(payload: Column, data: Column) -> Column:
    """First failing stage of a record, or ``parsed``.

    Only blank text yields a null struct: other malformed JSON gives a struct of nulls and so
    counts as a missing id.
    """
    return (
        F.when(payload.isNull(), "deserialization_failed")
        .when(data.isNull(), "json_parse_failed")
        .when(data["event_id"].isNull(), "missing_event_id")
        .otherwise("parsed")
    )


def is_valid_event(field: Callable[[str], Column] = F.col) -> Column:
    """All columns that curation and metrics depend on are present."""
    return reduce(and_, [field(name).isNotNull() for name in VALID_FIELDS])


def is_click() -> Column:
    return F.col("event_type").isin(*CLICK_EVENT_TYPES)


def is_conversion() -> Column:
    return F.col("event_type").isin(*CONVERSION_EVENT_TYPES)


def violations(version: int = LATEST_VERSION) -> Column:
    """Array of the constraint names that an event breaks, in field order."""
    rules: list[tuple[str, Column]] = []
    names = {name for name, _, _, since in EVENT_FIELDS if since <= version}
    for name, _, optional, since in EVENT_FIELDS:
        if not optional and since <= version:
            rules.append((f"{name}_missing", F.col(name).isNull()))
    unreadable = F.col("event_time").isNotNull() & event_time_of(F.col("event_time").cast("string")).isNull()
    rules.append(("event_time_unreadable", unreadable))
    if "engagement_score" in names:
        score = F.col("engagement_score")
        rules.append(("engagement_score_out_of_range", (score < 0) | (score > 1)))
    if "conversion_value" in names:
        rules.append(("conversion_value_negative", F.col("conversion_value") < 0))
    broken = F.array(*[F.when(failed, F.lit(rule)) for rule, failed in rules])
    return F.filter(broken, lambda rule: rule.isNotNull())
