"""DuckDB SQL with the same results as the registered queries."""

from __future__ import annotations

# The sample adapter, in SQL; ``{source}`` supplies the columns of the driver's events.
SHAPED = """
SELECT CAST(event_id AS VARCHAR) AS event_id,
  strftime(ts, '%Y-%m-%dT%H:%M:%S.%f') || '+00:00' AS event_time,
  CAST(user_id AS VARCHAR) AS user_id,
  CAST(user_id % 100 + 1 AS INTEGER) AS campaign_id,
  CAST(event_id % 500 + 1 AS INTEGER) AS ad_id,
  ['mobile', 'desktop', 'tablet'][CAST(json_extract_string(props, '$.k') AS INTEGER) % 3 + 1] AS device,
  ['US', 'DE', 'GH', 'TG', 'AD'][user_id % 5 + 1] AS country,
  event_type,
  CASE WHEN event_id % 10 < 3 THEN NULL ELSE concat('cr-', event_id % 97) END AS ad_creative_id,
  CASE WHEN event_id % 10 = 0 THEN NULL
       ELSE CAST((event_id % 101) / 100.0 AS FLOAT) END AS engagement_score,
  ['premium', 'basic', 'free'][user_id % 3 + 1] AS user_segment,
  CASE WHEN event_type = 'purchase' THEN value END AS conversion_value,
  CASE WHEN event_id % 20 < 3 THEN NULL ELSE CAST(event_id % 181 - 90 AS DOUBLE) END AS geo_latitude,
  ts AS event_timestamp, CAST(ts AS DATE) AS event_date{extra}
FROM {source}
"""

COPIES = """(SELECT *, event_id * 2 AS position FROM events UNION ALL
  SELECT event_id, ts - INTERVAL 1 HOUR AS ts, user_id, event_type, value, props, event_id * 2 + 1
  FROM events WHERE event_type = 'purchase') c"""

AD = "ad AS (" + SHAPED.format(extra="", source="events") + ")"
SENT = "sent AS (" + SHAPED.format(extra=", position, event_id AS n", source=COPIES) + ")"
ARRIVED = "arrived AS (" + SHAPED.format(
    extra=", ts + to_minutes(CAST(floor(value * 3) AS BIGINT)) AS arrival", source="events"
) + ")"
STATUS = """status AS (SELECT *, CASE n % 97 WHEN 0 THEN 'deserialization_failed'
  WHEN 1 THEN 'json_parse_failed' WHEN 2 THEN 'missing_event_id' ELSE 'parsed' END AS parse_status
  FROM sent)"""
VALID = "valid AS (SELECT * FROM sent WHERE n % 97 > 3)"
RAW_DAYS = """raw AS (SELECT *, CAST(day(event_timestamp) + position % 2 * 2 AS BIGINT) AS ingestion_batch_id
  FROM status)"""
PAYLOAD = """event_id, event_time, user_id, campaign_id, ad_id, device, country, event_type,
  ad_creative_id, engagement_score, user_segment, conversion_value, geo_latitude"""

METRIC_COLUMNS = """window_start, window_start + INTERVAL '{width}' AS window_end,
  CAST(window_start AS DATE) AS window_date, campaign_id, clicks, conversions,
  least(clicks, conversions) AS attributed_conversions,
  greatest(conversions - clicks, 0) AS orphan_conversions,
  CASE WHEN clicks > 0 THEN CAST(least(clicks, conversions) AS DOUBLE) / clicks ELSE 0.0 END AS conversion_rate"""


def metric_sql(width: str, source: str = "ad", where: str = "true") -> str:
    columns = METRIC_COLUMNS.format(width=width)
    return f"""SELECT {columns} FROM (
      SELECT time_bucket(INTERVAL '{width}', event_timestamp) AS window_start, campaign_id,
        CAST(count(*) FILTER (event_type = 'click') AS BIGINT) AS clicks,
        CAST(count(*) FILTER (event_type = 'purchase') AS BIGINT) AS conversions
      FROM {source} WHERE event_type IN ('click', 'purchase') AND ({where}) GROUP BY 1, 2)"""


STATS = """stats AS (SELECT window_start, window_start + INTERVAL 5 MINUTE AS window_end, event_type, device,
  event_count, window_start + INTERVAL 5 MINUTE AS aggregation_time,
  CAST(window_start AS DATE) AS window_date
  FROM (SELECT time_bucket(INTERVAL 5 MINUTE, event_timestamp) AS window_start, event_type, device,
          count(*) AS event_count FROM ad GROUP BY 1, 2, 3))"""

FIRST_COPY = """SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY event_id
  ORDER BY {order}) AS pick FROM {source}) WHERE pick = 1"""

CURATED_COLUMNS = """event_id, event_timestamp AS event_time, user_id, campaign_id, ad_id, device, country,
  event_type, ad_creative_id, engagement_score, user_segment, conversion_value, geo_latitude,
  event_timestamp, event_date"""

SPOILT = """spoilt AS (SELECT event_id, event_type, user_id, campaign_id, ad_id, country,
  CASE WHEN event_type <> 'error' THEN 'known' END AS device,
  event_type = 'signup' AS unreadable,
  CAST(floor(value) / 100 AS FLOAT) AS score,
  CASE WHEN event_type = 'purchase' THEN floor(value) - 10 END AS worth
  FROM (SELECT *, user_id AS campaign_id, user_id AS ad_id, user_id AS country FROM events)),
broken AS (SELECT event_id, event_type, device IS NULL AS no_device, unreadable,
  score < 0 OR score > 1 AS bad_score, coalesce(worth < 0, false) AS negative FROM spoilt)"""

# One zig-zag byte pair or single byte of a small non-negative integer.
VARINT = """CASE WHEN 2 * {0} < 128 THEN printf('%02X', 2 * {0})
  ELSE printf('%02X%02X', ((2 * {0}) & 127) | 128, (2 * {0}) >> 7) END"""


def _hex_text(column: str) -> str:
    return f"{VARINT.format(f'CAST(length({column}) AS INTEGER)')} || hex(encode({column}))"


V1_FRAME = (
    "'0000000001' || "
    + " || ".join(_hex_text(c) for c in ("event_id", "event_time", "user_id"))
    + f" || {VARINT.format('campaign_id')} || {VARINT.format('ad_id')} || "
    + " || ".join(_hex_text(c) for c in ("device", "country", "event_type"))
    + f" || CASE WHEN ad_creative_id IS NULL THEN '00' ELSE '02' || {_hex_text('ad_creative_id')} END"
)

SINCE_DAY = "event_date >= DATE '2024-01-10'"
STREAM_STATUS = "CASE WHEN event_type = 'error' THEN 'deserialization_failed' ELSE 'parsed' END"


def _with(*parts_and_query: str) -> str:
    *parts, query = parts_and_query
    return f"WITH {', '.join(parts)} {query}"


ORACLES: dict[str, str] = {
    "campaign_metrics_30s": _with(AD, metric_sql("30 seconds")),
    "campaign_metrics_1d": _with(AD, metric_sql("1 day")),
    "device_stats_5m": _with(
        AD,
        STATS,
        "SELECT window_start, window_end, event_type, device, event_count, window_date FROM stats",
    ),
    "latest_snapshot": _with(
        AD,
        STATS,
        "SELECT window_start, window_end, event_type, device, event_count, aggregation_time FROM stats",
    ),
    "parse_status_counts": _with(
        SENT, STATUS, "SELECT parse_status, count(*) AS records FROM status GROUP BY 1"
    ),
    "raw_records": _with(
        SENT,
        STATUS,
        "SELECT 'ads_events' AS kafka_topic, position AS kafka_offset, event_date AS kafka_date, "
        "parse_status, CAST(7 AS BIGINT) AS ingestion_batch_id FROM status",
    ),
    "valid_events": _with(SENT, VALID, "SELECT event_id, campaign_id, event_timestamp FROM valid"),
    "curated_events": _with(
        SENT,
        VALID,
        f"SELECT {CURATED_COLUMNS}, CAST(1 AS BIGINT) AS ingestion_batch_id FROM ("
        + FIRST_COPY.format(order="event_timestamp, position", source="valid")
        + ")",
    ),
    "dedupe_events": _with(
        SENT,
        f"SELECT {PAYLOAD}, event_timestamp, event_date FROM ("
        + FIRST_COPY.format(order="event_timestamp", source="sent")
        + ")",
    ),
    "dedupe_any": _with(SENT, "SELECT DISTINCT event_id, user_id, event_type FROM sent"),
    "batch_quality": _with(
        SENT,
        "SELECT count(*) AS total, count(*) FILTER (n % 97 > 3) AS valid, "
        "count(*) FILTER (n % 97 <= 3) AS corrupted FROM sent",
    ),
    "validation_report": _with(
        SPOILT,
        """SELECT * FROM (
        SELECT 'device_missing' AS rule, count(*) FILTER (no_device) AS events FROM broken UNION ALL
        SELECT 'event_time_unreadable', count(*) FILTER (unreadable) FROM broken UNION ALL
        SELECT 'engagement_score_out_of_range', count(*) FILTER (bad_score) FROM broken UNION ALL
        SELECT 'conversion_value_negative', count(*) FILTER (negative) FROM broken) WHERE events > 0""",
    ),
    "validated_events": _with(
        SPOILT,
        """SELECT CAST(event_id AS VARCHAR) AS event_id, concat_ws(',',
        CASE WHEN no_device THEN 'device_missing' END,
        CASE WHEN unreadable THEN 'event_time_unreadable' END,
        CASE WHEN bad_score THEN 'engagement_score_out_of_range' END,
        CASE WHEN negative THEN 'conversion_value_negative' END) AS violations FROM broken""",
    ),
    "accepted_events_v1": _with(
        SPOILT,
        "SELECT CAST(event_id AS VARCHAR) AS event_id, event_type FROM broken "
        "WHERE NOT no_device AND NOT unreadable",
    ),
    "lateness_split": _with(
        ARRIVED,
        "SELECT event_id, event_timestamp, arrival, "
        "CASE WHEN arrival - event_timestamp > INTERVAL 2 HOUR THEN 1 ELSE 0 END AS late FROM arrived",
    ),
    "upcast_v1": _with(
        AD,
        """SELECT event_id, event_time, user_id, campaign_id, ad_id, device, country, event_type,
        ad_creative_id, CAST(NULL AS FLOAT) AS engagement_score, CAST(NULL AS VARCHAR) AS user_segment,
        CAST(NULL AS DOUBLE) AS conversion_value, CAST(NULL AS DOUBLE) AS geo_latitude FROM ad""",
    ),
    "quarantine": _with(
        SENT,
        STATUS,
        "SELECT 'ads_events' AS kafka_topic, position AS kafka_offset, hex(encode(user_id)) AS key, "
        "parse_status, CAST(3 AS BIGINT) AS ingestion_batch_id FROM status WHERE parse_status <> 'parsed'",
    ),
    "encode_frames": _with(AD, f"SELECT event_id, user_id AS key, {V1_FRAME} AS frame FROM ad"),
    "encode_frames_v3": _with(
        AD,
        f"""SELECT event_id, CAST(3 AS BIGINT) AS schema_id, CAST(length({V1_FRAME}) / 2
        + 1 + CASE WHEN engagement_score IS NULL THEN 0 ELSE 4 END
        + 2 + length(user_segment)
        + 1 + CASE WHEN conversion_value IS NULL THEN 0 ELSE 8 END
        + 1 + CASE WHEN geo_latitude IS NULL THEN 0 ELSE 8 END AS BIGINT) AS frame_bytes FROM ad""",
    ),
    "decode_frames": _with(
        AD,
        """SELECT event_id, event_time, user_id, campaign_id, ad_id, device, country, event_type,
        ad_creative_id,
        CASE WHEN version >= 2 THEN engagement_score END AS engagement_score,
        CASE WHEN version = 3 THEN user_segment END AS user_segment,
        CASE WHEN version = 3 THEN conversion_value END AS conversion_value,
        CASE WHEN version = 3 THEN geo_latitude END AS geo_latitude, version
        FROM ad, (SELECT CAST(unnest([1, 2, 3]) AS BIGINT) AS version)""",
    ),
    "decode_registry_ids": _with(
        AD,
        """SELECT event_id, event_time, user_id, campaign_id, ad_id, device, country, event_type,
        ad_creative_id,
        CASE WHEN schema_id <> 7 THEN engagement_score END AS engagement_score,
        CASE WHEN schema_id <> 7 THEN user_segment END AS user_segment,
        CASE WHEN schema_id <> 7 THEN conversion_value END AS conversion_value,
        CASE WHEN schema_id <> 7 THEN geo_latitude END AS geo_latitude, schema_id
        FROM (SELECT *, CAST([1, 7, 9][CAST(event_id AS BIGINT) % 3 + 1] AS BIGINT) AS schema_id FROM ad)""",
    ),
    "payload_round_trip": _with(AD, f"SELECT {PAYLOAD} FROM ad WHERE event_type <> 'error'"),
    "frame_outcomes": _with(
        AD,
        """SELECT CASE WHEN event_type <> 'error' THEN 'decoded' WHEN device = 'mobile' THEN 'null_or_short'
        WHEN device = 'desktop' THEN 'bad_magic' ELSE 'decode_error' END AS outcome,
        count(*) AS records FROM ad GROUP BY 1""",
    ),
    "publish_order": _with(
        AD,
        "SELECT user_id, event_id, row_number() OVER (PARTITION BY user_id ORDER BY event_timestamp, event_id) - 1 "
        "AS place, true AS one_partition FROM ad",
    ),
    "publish_offsets": "SELECT count(*) AS events, true AS gap_free FROM events",
    "upsert_events": _with(
        AD,
        """SELECT event_id, event_type, CASE WHEN event_type = 'purchase' THEN conversion_value * 2
          ELSE conversion_value END AS conversion_value,
          CASE WHEN event_type = 'purchase' THEN event_timestamp + INTERVAL 1 DAY
            ELSE event_timestamp END AS event_timestamp,
          CAST(CASE WHEN event_type = 'purchase' THEN event_timestamp + INTERVAL 1 DAY
            ELSE event_timestamp END AS DATE) AS event_date,
          CAST(CASE WHEN event_type = 'purchase' THEN 1 ELSE 0 END AS BIGINT) AS ingestion_batch_id FROM ad
        UNION ALL
        SELECT 'n-' || event_id, event_type, conversion_value, event_timestamp, event_date, CAST(1 AS BIGINT)
        FROM ad WHERE event_type = 'signup'""",
    ),
    "upsert_raw": _with(
        SENT,
        STATUS,
        "SELECT event_date AS kafka_date, parse_status, CAST(1 AS BIGINT) AS ingestion_batch_id, "
        "count(*) AS records FROM status GROUP BY 1, 2",
    ),
    "upsert_metrics": _with(
        AD,
        metric_sql("1 day", where=f"event_type = 'click' OR {SINCE_DAY}"),
    ),
    "replace_day": _with(
        AD,
        metric_sql(
            "1 hour",
            where="(event_date <> DATE '2024-01-10' OR event_type = 'click') "
            "AND event_date <> DATE '2024-01-12'",
        ),
    ),
    "delete_day": _with(
        AD,
        "SELECT event_date, count(*) AS records FROM ad WHERE event_date <> DATE '2024-01-10' GROUP BY 1",
    ),
    "schema_align": _with(
        AD,
        f"""SELECT event_id, user_id, campaign_id, ad_id, device, country, event_type, ad_creative_id,
        event_timestamp, event_date,
        CASE WHEN {SINCE_DAY} THEN engagement_score END AS engagement_score,
        CASE WHEN {SINCE_DAY} THEN user_segment END AS user_segment,
        CASE WHEN {SINCE_DAY} THEN conversion_value END AS conversion_value,
        CASE WHEN {SINCE_DAY} THEN geo_latitude END AS geo_latitude FROM ad""",
    ),
    "reconcile_day": _with(
        AD,
        SENT,
        VALID,
        "day AS ("
        + FIRST_COPY.format(
            order="event_timestamp, position",
            source="(SELECT * FROM valid WHERE event_date = DATE '2024-01-10')",
        )
        + ")",
        metric_sql("30 seconds", "day")
        + " UNION ALL "
        + metric_sql("1 hour", where="event_type = 'click' AND event_date <> DATE '2024-01-10'"),
    ),
    "reconcile_day_events": _with(
        SENT,
        STATUS,
        RAW_DAYS,
        f"SELECT {CURATED_COLUMNS}, ingestion_batch_id FROM ("
        + FIRST_COPY.format(
            order="event_timestamp, position",
            source="(SELECT * FROM raw WHERE event_date = DATE '2024-01-10' AND n % 97 > 3)",
        )
        + ")",
    ),
    "live_after_reconcile": _with(
        AD,
        SENT,
        VALID,
        "day AS ("
        + FIRST_COPY.format(
            order="event_timestamp, position",
            source="(SELECT * FROM valid WHERE event_date = DATE '2024-01-10')",
        )
        + ")",
        "live AS (SELECT * FROM ad WHERE event_date <> DATE '2024-01-10' AND CAST(event_id AS BIGINT) % 97 > 3)",
        "clicked AS (" + metric_sql("30 seconds", "live", "event_type = 'click'") + ")",
        "bought AS (" + metric_sql("30 seconds", "live", "event_type = 'purchase'") + ")",
        metric_sql("30 seconds", "day")
        + " UNION ALL SELECT * FROM clicked UNION ALL SELECT * FROM bought ANTI JOIN clicked "
        "USING (campaign_id, window_start)",
    ),
    "recompute_range": _with(
        AD,
        metric_sql(
            "1 hour",
            where="event_type = 'purchase' OR (event_timestamp >= TIMESTAMP '2024-01-05 06:00:00' "
            "AND event_timestamp < TIMESTAMP '2024-01-20 19:00:00')",
        ),
    ),
    "count_by_type": "SELECT event_type, count(*) AS events FROM events GROUP BY 1",
    "count_by_type_device": _with(
        AD,
        "SELECT event_type, device, count(*) AS events FROM ad "
        "WHERE event_date BETWEEN DATE '2024-01-05' AND DATE '2024-01-20' GROUP BY 1, 2",
    ),
    "events_between": _with(
        AD, "SELECT * FROM ad WHERE event_date BETWEEN DATE '2024-01-05' AND DATE '2024-01-20'"
    ),
    "event_by_id": _with(AD, "SELECT * FROM ad WHERE event_id = '77'"),
    "top_windows": _with(
        AD,
        STATS,
        "SELECT event_type, device, event_count, window_start, window_end FROM stats "
        "ORDER BY window_end DESC, event_type, device LIMIT 20",
    ),
    "recent_stats": _with(
        AD,
        STATS,
        "SELECT event_type, device, event_count, aggregation_time FROM stats "
        "WHERE aggregation_time >= TIMESTAMP '2024-01-20' - INTERVAL 5 MINUTE",
    ),
    "recent_stats_newest": _with(
        AD,
        STATS,
        "SELECT event_type, device, event_count, aggregation_time FROM stats WHERE aggregation_time >= "
        "(SELECT max(aggregation_time) FROM stats) - INTERVAL 5 MINUTE",
    ),
    "device_totals": _with(
        AD,
        STATS,
        "SELECT device, aggregation_time, CAST(sum(event_count) AS BIGINT) AS total_count FROM stats "
        "WHERE event_type = 'view' AND aggregation_time >= TIMESTAMP '2024-01-20' - INTERVAL 5 MINUTE "
        "GROUP BY 1, 2",
    ),
    "popular_combos": _with(
        AD,
        STATS,
        "SELECT event_type, device, CAST(sum(event_count) AS BIGINT) AS total_count FROM stats "
        "WHERE aggregation_time >= TIMESTAMP '2024-01-20' - INTERVAL 5 MINUTE GROUP BY 1, 2",
    ),
    "metrics_for_day": _with(AD, metric_sql("30 seconds", where="event_date = DATE '2024-01-10'")),
    "as_of_batch": _with(
        SENT,
        STATUS,
        RAW_DAYS,
        "SELECT event_id, event_timestamp, event_date, ingestion_batch_id FROM ("
        + FIRST_COPY.format(
            order="ingestion_batch_id DESC, event_timestamp, position",
            source="(SELECT * FROM raw WHERE ingestion_batch_id <= 15 AND n % 97 > 3)",
        )
        + ")",
    ),
    "as_of_time": _with(
        SENT,
        STATUS,
        RAW_DAYS,
        "SELECT count(*) AS event_count FROM raw WHERE TIMESTAMP '2024-01-01 12:00:00' "
        "+ to_days(CAST(ingestion_batch_id - 1 AS INTEGER)) <= TIMESTAMP '2024-01-20'",
    ),
    "ingest_history": _with(
        SENT,
        STATUS,
        RAW_DAYS,
        "SELECT ingestion_batch_id, count(*) AS records, count(*) FILTER (parse_status = 'parsed') AS parsed, "
        "min(event_timestamp) AS first_record, max(event_timestamp) AS last_record FROM raw GROUP BY 1",
    ),
    "partition_stats": "SELECT CAST(ts AS DATE) AS event_date, count(*) AS records FROM events GROUP BY 1",
    "sql_file": _with(
        ARRIVED,
        """SELECT event_type, device, count(*) FILTER (arrival - event_timestamp > INTERVAL 2 HOUR) AS late_events,
        count(*) AS all_events FROM arrived GROUP BY 1, 2 HAVING late_events > 0""",
    ),
    "sql_file_evolved": _with(
        AD,
        """SELECT event_id, event_type, event_date,
        CASE WHEN event_date >= DATE '2024-01-10' THEN user_segment END AS user_segment,
        CASE WHEN event_date >= DATE '2024-01-10' THEN geo_latitude END AS geo_latitude FROM ad""",
    ),
    "sql_file_late": _with(
        ARRIVED,
        "SELECT least(100, count(*)) AS n, least(100, count(*)) AS with_zone FROM arrived "
        "WHERE arrival - event_timestamp > INTERVAL 2 HOUR",
    ),
    "stream_metrics": _with(AD, metric_sql("30 seconds")),
    "stream_stats": _with(
        AD,
        STATS.replace("FROM ad", "FROM ad WHERE event_type <> 'error'"),
        "SELECT window_start, window_end, event_type, device, event_count FROM stats",
    ),
    "stream_ingest": _with(
        AD,
        f"SELECT {PAYLOAD.replace('event_time, ', '')}, event_timestamp, event_date, "
        "CAST(0 AS BIGINT) AS ingestion_batch_id FROM ad WHERE event_type <> 'error'",
    ),
    "stream_ingest_raw": _with(
        AD,
        f"SELECT event_date AS kafka_date, {STREAM_STATUS} AS parse_status, count(*) AS records "
        "FROM ad GROUP BY 1, 2",
    ),
    "stream_late_events": _with(
        ARRIVED,
        "SELECT event_id, event_date, CASE WHEN arrival - event_timestamp > INTERVAL 2 HOUR THEN 1 "
        "ELSE 0 END AS late FROM arrived WHERE event_type <> 'error'",
    ),
    "stream_ingest_restart": _with(
        AD,
        """numbered AS (SELECT *, CASE WHEN day(event_timestamp) <= 10 THEN 0 WHEN day(event_timestamp) <= 20 THEN 2
        ELSE 3 END AS sent FROM ad)""",
        """stored AS (SELECT CAST(CASE WHEN event_type = 'purchase' THEN 3 ELSE sent END AS BIGINT) AS ingestion_batch_id,
        event_type, event_date, count(*) AS events, count(DISTINCT event_id) AS ids
        FROM numbered WHERE event_type <> 'error' GROUP BY 1, 2, 3)""",
        """raw AS (SELECT ingestion_batch_id, count(*) AS records FROM (SELECT CAST(sent AS BIGINT) AS ingestion_batch_id
        FROM numbered UNION ALL SELECT CAST(3 AS BIGINT) FROM numbered WHERE event_type = 'purchase') GROUP BY 1)""",
        """SELECT ingestion_batch_id, event_type, event_date, events, ids, records
        FROM stored JOIN raw USING (ingestion_batch_id)""",
    ),
    "stream_metrics_late": _with(
        AD,
        """mark AS (SELECT date_trunc('milliseconds', max(event_timestamp)) - INTERVAL 2 HOUR AS w FROM ad
        WHERE event_type IN ('click', 'purchase') AND CAST(event_id AS BIGINT) % 50 > 1)""",
        """kept AS (SELECT ad.* FROM ad, mark WHERE CAST(event_id AS BIGINT) % 50 <> 0
        OR time_bucket(INTERVAL '30 seconds', event_timestamp) + INTERVAL 30 SECOND > w)""",
        metric_sql("30 seconds", "kept"),
    ),
    "late_correction": _with(AD, metric_sql("30 seconds")),
    "stream_progress": _with(
        AD,
        """mark AS (SELECT date_trunc('milliseconds', max(event_timestamp)) - INTERVAL 2 HOUR AS w FROM ad
        WHERE event_type IN ('click', 'purchase') AND CAST(event_id AS BIGINT) % 50 > 1)""",
        """late AS (SELECT DISTINCT time_bucket(INTERVAL '30 seconds', event_timestamp) AS window_start, campaign_id
        FROM ad, mark WHERE CAST(event_id AS BIGINT) % 50 = 0 AND event_type IN ('click', 'purchase')
        AND time_bucket(INTERVAL '30 seconds', event_timestamp) + INTERVAL 30 SECOND <= w)""",
        """SELECT CAST(CASE CAST(event_id AS BIGINT) % 50 WHEN 0 THEN 3 WHEN 1 THEN 2 ELSE 1 END AS INTEGER) AS trigger,
        count(*) AS input_rows, CASE WHEN min(CAST(event_id AS BIGINT) % 50) = 0 THEN (SELECT count(*) FROM late)
        ELSE 0 END AS late_rows FROM ad GROUP BY 1""",
    ),
    "stream_state": _with(
        AD,
        """mark AS (SELECT date_trunc('milliseconds', max(event_timestamp)) - INTERVAL 2 HOUR AS w FROM ad
        WHERE event_type IN ('click', 'purchase'))""",
        "m AS (" + metric_sql("30 seconds") + ")",
        "SELECT window_start, campaign_id, clicks, conversions FROM m, mark WHERE window_end > w",
    ),
    "live_run": _with(
        AD,
        "m AS (" + metric_sql("30 seconds") + ")",
        """SELECT window_date, count(*) AS windows, CAST(sum(clicks) AS BIGINT) AS clicks,
        CAST(sum(conversions) AS BIGINT) AS conversions,
        max(s.events) AS events FROM m JOIN (SELECT event_date, count(*) AS events FROM ad
        WHERE event_type <> 'error' GROUP BY 1) s ON m.window_date = s.event_date GROUP BY 1""",
    ),
}

# The job does what the function does.
ORACLES["reconcile_job"] = ORACLES["reconcile_day"]
