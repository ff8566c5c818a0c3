"""The same queries as plain SQL over the driver's tables."""

from __future__ import annotations

# The events table as sensor readings, written out independently of the engine.
_READINGS = """
WITH sensed AS (
  SELECT event_id, ts,
    CAST(json_extract(props, '$.k') AS INTEGER) AS k,
    CASE event_type WHEN 'view' THEN 'temperature' WHEN 'click' THEN 'humidity'
      WHEN 'purchase' THEN 'pressure' ELSE event_type END AS sensor_type,
    CASE event_type WHEN 'view' THEN round(value - 60, 2)
      WHEN 'purchase' THEN round(value + 960, 2) ELSE value END AS value,
    CASE event_type WHEN 'view' THEN 'C' WHEN 'click' THEN '%'
      WHEN 'purchase' THEN 'hPa' END AS unit,
    epoch_us(ts) // 1000 AS ms,
    'user-' || user_id AS reading_source,
    CAST(event_id % 3 AS INTEGER) AS kafka_partition,
    event_id // 3 AS kafka_offset
  FROM events
), flagged AS (
  SELECT *,
    CASE sensor_type WHEN 'temperature' THEN value > 35 WHEN 'humidity' THEN value > 90
      WHEN 'pressure' THEN value < 990 OR value > 1030 ELSE false END AS is_anomaly,
    CASE sensor_type WHEN 'temperature' THEN value BETWEEN -50 AND 80
      WHEN 'humidity' THEN value BETWEEN 0 AND 100
      WHEN 'pressure' THEN value BETWEEN 900 AND 1100 END AS plausible,
    date_trunc('second', ts) AS event_time,
    date_trunc('milliseconds', ts) AS kafka_timestamp,
    TIMESTAMP '2024-06-01 00:00:00' AS ingestion_time,
    '{"sensor":"' || sensor_type || '","value":' || CAST(value AS VARCHAR)
      || coalesce(',"unit":"' || unit || '"', '') || ',"timestamp":' || ms
      || ',"source":"' || reading_source || '","anomaly":'
      || CASE WHEN is_anomaly THEN 'true' ELSE 'false' END || '}' AS json_payload
  FROM sensed
), curated AS (
  SELECT sensor_type, value, unit, ms AS event_timestamp_ms, reading_source,
    is_anomaly AS producer_anomaly, sensor_type AS message_key, kafka_timestamp,
    kafka_partition, kafka_offset, ingestion_time, event_time, is_anomaly,
    'sensor-events' AS topic, 'iot' AS domain,
    CAST(year(event_time) AS INTEGER) AS year, CAST(month(event_time) AS INTEGER) AS month,
    CAST(day(event_time) AS INTEGER) AS day
  FROM flagged WHERE plausible
)
"""

_CURATED = _READINGS + "SELECT * FROM curated"

_RAW = _READINGS + """
SELECT sensor_type AS message_key, json_payload, kafka_timestamp, kafka_partition, kafka_offset,
  ingestion_time, 'kafka' AS source, 'sensor-events' AS topic,
  2024 AS year, 6 AS month, 1 AS day, 0 AS hour
FROM flagged
"""

# Faults in the messages of error events, by the event's number.
_REJECTS = """, faulty AS (
  SELECT flagged.*, event_id % 6 AS fault, events.event_type = 'error' AS broken
  FROM flagged JOIN events USING (event_id)
), judged AS (
  SELECT *,
    CASE WHEN NOT broken THEN json_payload
      WHEN fault = 0 THEN NULL
      WHEN fault = 1 THEN left(json_payload, 12)
      WHEN fault = 2 THEN '[' || event_id || ']'
      WHEN fault = 3 THEN '{"sensor":"humidity","value":null,"timestamp":' || ms || '}'
      WHEN fault = 4 THEN '{"sensor":"humidity","value":1.5}'
      ELSE '{"sensor":"humidity","value":1.5,"timestamp":999999999999999}' END AS payload,
    CASE WHEN broken AND fault = 0 THEN 'no_payload'
      WHEN broken AND fault IN (1, 2) THEN 'sensor_missing'
      WHEN broken AND fault = 3 THEN 'value_missing'
      WHEN broken AND fault = 4 THEN 'timestamp_missing'
      WHEN broken THEN 'timestamp_out_of_range'
      WHEN plausible IS NULL THEN 'sensor_unsupported'
      WHEN NOT plausible THEN 'value_implausible' END AS reject_reason
  FROM faulty
), rejects AS (
  SELECT sensor_type AS message_key, 'sensor-events' AS topic, kafka_timestamp, kafka_partition,
    kafka_offset, ingestion_time,
    CASE WHEN NOT broken THEN sensor_type WHEN fault > 2 THEN 'humidity' END AS sensor_type,
    CASE WHEN NOT broken THEN value WHEN fault > 3 THEN 1.5 END AS value,
    CASE WHEN NOT broken OR fault = 3 THEN ms WHEN fault = 5 THEN 999999999999999 END
      AS event_timestamp_ms,
    payload AS json_payload, reject_reason, 2024 AS year, 6 AS month, 1 AS day
  FROM judged WHERE reject_reason IS NOT NULL
)
"""


def _windows(width: str, condition: str = "true") -> str:
    return _READINGS + f"""
SELECT time_bucket(INTERVAL '{width}', event_time) AS window_start,
  time_bucket(INTERVAL '{width}', event_time) + INTERVAL '{width}' AS window_end,
  sensor_type, round(avg(value), 8) AS mean_value, min(value) AS min_value,
  max(value) AS max_value, count(*) AS observation_count,
  CAST(count(*) FILTER (WHERE is_anomaly) AS BIGINT) AS anomaly_count,
  'sensor_averages' AS use_case,
  CAST(year(window_start) AS INTEGER) AS year, CAST(month(window_start) AS INTEGER) AS month
FROM curated GROUP BY 1, 2, 3
HAVING {condition}
"""


_TOP_HOURS = _READINGS + """
SELECT strftime(event_time, '%Y-%m-%d %H:00') AS hour_bucket, count(*) AS anomaly_count
FROM curated WHERE is_anomaly GROUP BY 1
ORDER BY anomaly_count DESC, hour_bucket LIMIT 5
"""


def _daily(sensor: str, since: str) -> str:
    return f"""
SELECT strftime(event_time, '%Y-%m-%d') AS event_day, round(avg(value), 2) AS mean_value,
  round(min(value), 2) AS min_value, round(max(value), 2) AS max_value,
  count(value) AS observation_count,
  CAST(count(*) FILTER (WHERE is_anomaly) AS BIGINT) AS anomaly_count
FROM curated WHERE sensor_type = '{sensor}' AND event_time >= TIMESTAMP '{since}' GROUP BY 1
"""


def _zone_counts(condition: str = "true") -> str:
    return _READINGS + f"""
SELECT 'raw' AS zone, sensor_type, count(*) AS row_count FROM flagged WHERE {condition} GROUP BY 2
UNION ALL
SELECT 'curated', sensor_type, count(*) FROM flagged WHERE plausible AND {condition} GROUP BY 2
UNION ALL
SELECT 'consumption', sensor_type, count(DISTINCT time_bucket(INTERVAL '5 minutes', event_time))
FROM flagged WHERE plausible AND {condition} GROUP BY 2
UNION ALL
SELECT 'rejected', sensor_type, count(*) FROM flagged
WHERE plausible IS NOT TRUE AND {condition} GROUP BY 2
"""


# Submissions: what each value of k makes of the body, then the checks in order.
_SUBMISSIONS = _READINGS + """
, submitted AS (
  SELECT *,
    k BETWEEN 25 AND 27 AS malformed,
    k BETWEEN 20 AND 24 AS no_source,
    CASE WHEN k BETWEEN 5 AND 9 THEN 'K' ELSE coalesce(unit, 'C') END AS given_unit,
    CASE sensor_type WHEN 'temperature' THEN 'between -50.0 and 80.0'
      WHEN 'humidity' THEN 'between 0.0 and 100.0'
      WHEN 'pressure' THEN 'between 900.0 and 1100.0' END AS bounds
  FROM flagged
), checked AS (
  SELECT *,
    CASE WHEN malformed THEN 'Malformed JSON request body'
      WHEN no_source THEN 'Missing required field(s): source'
      WHEN unit IS NULL THEN 'Unsupported sensor type: ' || sensor_type
      WHEN k < 5 THEN 'Field ''value'' must be numeric'
      WHEN given_unit <> unit THEN 'Invalid unit for ' || sensor_type || '. Expected ' || unit
      WHEN NOT plausible THEN 'Value for ' || sensor_type || ' must be ' || bounds
      WHEN k BETWEEN 10 AND 14 THEN
        'Field ''timestamp'' must be an epoch millisecond integer' END AS message
  FROM submitted
), answered AS (
  SELECT event_id,
    CASE WHEN message IS NULL THEN sensor_type END AS sensor,
    CASE WHEN message IS NULL THEN value END AS value,
    CASE WHEN message IS NULL THEN unit END AS unit,
    CASE WHEN message IS NULL THEN CASE WHEN k > 19 THEN ms ELSE 1717200000000 END END
      AS timestamp,
    CASE WHEN message IS NULL THEN reading_source END AS source,
    CASE WHEN message IS NULL THEN
      CASE WHEN k BETWEEN 30 AND 59 THEN k < 45 ELSE is_anomaly END END AS anomaly,
    message,
    CASE WHEN message LIKE 'Malformed%' OR message LIKE 'Missing%' OR message LIKE 'Field%'
      THEN 400 WHEN message IS NOT NULL THEN 422 END AS status
  FROM checked
)
"""

ORACLES: dict[str, str] = {
    "curated_readings": _CURATED,
    "envelope_roundtrip": _READINGS + """
SELECT sensor_type AS message_key, 'sensor-events' AS topic, kafka_timestamp, kafka_partition,
  kafka_offset, ingestion_time, true AS has_payload, sensor_type, value, unit, ms AS event_timestamp_ms, reading_source,
  is_anomaly AS producer_anomaly
FROM flagged
""",
    "raw_envelope_parts": _RAW,
    "reject_reasons": _READINGS + _REJECTS + "SELECT * FROM rejects",
    "reject_counts": _READINGS + _REJECTS + """
SELECT reject_reason, count(*) AS message_count FROM rejects GROUP BY 1
""",
    "submit_validation": _SUBMISSIONS + "SELECT * FROM answered",
    "submit_publish": _SUBMISSIONS + """
SELECT sensor AS key, '{"sensor":"' || sensor || '","value":' || CAST(value AS VARCHAR)
  || ',"unit":"' || unit || '","timestamp":' || timestamp || ',"source":"' || source
  || '","anomaly":' || CASE WHEN anomaly THEN 'true' ELSE 'false' END || '}' AS value
FROM answered WHERE message IS NULL
""",
    "top_anomaly_hours": _TOP_HOURS,
    "sensor_statistics": _READINGS + """
SELECT sensor_type, round(avg(value), 2) AS global_mean, round(min(value), 2) AS min_value,
  round(max(value), 2) AS max_value, round(stddev_samp(value), 2) AS stddev_value,
  CAST(round(100.0 * count(*) FILTER (WHERE is_anomaly) / count(*), 2) AS DOUBLE)
    AS anomaly_rate_pct
FROM curated GROUP BY 1 ORDER BY 1
""",
    "temperature_daily": _READINGS + """
SELECT strftime(event_time, '%Y-%m-%d') AS event_day, round(avg(value), 2) AS mean_temperature,
  CAST(count(*) FILTER (WHERE is_anomaly) AS BIGINT) AS anomaly_count
FROM curated WHERE sensor_type = 'temperature' GROUP BY 1 ORDER BY 1
""",
    "partition_counts": _READINGS + """
, parts AS (
  SELECT sensor_type, year, month, day, count(*) AS n FROM curated GROUP BY ALL
), head AS (SELECT * FROM parts ORDER BY sensor_type, year, month, day LIMIT 1)
SELECT 'full_scan' AS query_type, CAST(count(*) AS VARCHAR) AS row_count,
  '' AS sensor_type_filter, '' AS year_filter, '' AS month_filter, '' AS day_filter
FROM curated HAVING count(*) > 0
UNION ALL
SELECT 'partition_pruned', CAST(n AS VARCHAR), sensor_type, CAST(year AS VARCHAR),
  CAST(month AS VARCHAR), CAST(day AS VARCHAR) FROM head
""",
    "partition_keys": _READINGS + "SELECT DISTINCT sensor_type, year, month, day FROM curated",
    "daily_stats": _READINGS + _daily("humidity", "2024-01-24"),
    "daily_stats_records": _READINGS + ", days AS (" + _daily("pressure", "2023-11-02") + """)
SELECT '{"event_day":"' || event_day || '","mean_value":' || CAST(mean_value AS VARCHAR)
  || ',"min_value":' || CAST(min_value AS VARCHAR) || ',"max_value":'
  || CAST(max_value AS VARCHAR) || ',"observation_count":' || observation_count
  || ',"anomaly_count":' || anomaly_count || '}' AS record
FROM days
""",
    "recent_anomalies": _READINGS + """
SELECT sensor_type, value, unit, event_time, reading_source, producer_anomaly, is_anomaly
FROM curated WHERE is_anomaly
ORDER BY event_time DESC, kafka_partition, kafka_offset LIMIT 20
""",
    "recent_anomalies_of_sensor": _READINGS + """
SELECT sensor_type, value, unit, event_time, reading_source, producer_anomaly, is_anomaly
FROM curated WHERE is_anomaly AND sensor_type = 'temperature'
ORDER BY event_time DESC, kafka_partition, kafka_offset LIMIT 500
""",
    "latest_reading": _READINGS + """
, ends AS (SELECT kafka_partition, max(kafka_offset) AS last FROM flagged GROUP BY 1)
SELECT sensor_type AS sensor, value, unit, ms AS timestamp, reading_source AS source,
  is_anomaly AS anomaly, kafka_partition AS partition, kafka_offset AS offset
FROM flagged JOIN ends USING (kafka_partition)
WHERE kafka_offset > last - 100 AND sensor_type = 'humidity'
ORDER BY ms DESC, kafka_partition, kafka_offset LIMIT 1
""",
    "tail_messages": _READINGS + """
, ends AS (SELECT kafka_partition, max(kafka_offset) AS last FROM flagged GROUP BY 1)
SELECT kafka_partition, kafka_offset, json_payload
FROM flagged JOIN ends USING (kafka_partition) WHERE kafka_offset > last - 100
""",
    "peek_messages": _READINGS + """
SELECT kafka_partition AS partition, kafka_offset AS offset, sensor_type AS key,
  '{"anomaly":' || CASE WHEN is_anomaly THEN 'true' ELSE 'false' END || ',"sensor":"'
  || sensor_type || '","source":"' || reading_source || '","timestamp":' || ms
  || coalesce(',"unit":"' || unit || '"', '') || ',"value":'
  || regexp_replace(CAST(value AS VARCHAR), '\\.0$', '') || '}' AS value
FROM flagged ORDER BY kafka_partition, kafka_offset LIMIT 10
""",
    "sensor_units": """
SELECT * FROM (VALUES ('temperature', 'C'), ('humidity', '%'), ('pressure', 'hPa'))
  AS listed(sensor, unit)
""",
    "reading_counts": _READINGS + """
, units AS (
  SELECT * FROM (VALUES ('temperature', 'C'), ('humidity', '%'), ('pressure', 'hPa'))
    AS listed(sensor, unit)
)
SELECT units.sensor, units.unit, count(curated.sensor_type) AS reading_count
FROM units LEFT JOIN curated ON curated.sensor_type = units.sensor GROUP BY 1, 2
""",
    "anomaly_ratio": _READINGS + """
SELECT count(*) AS event_count, CAST(count(*) FILTER (WHERE is_anomaly) AS BIGINT)
  AS anomaly_count, coalesce(avg(CAST(is_anomaly AS INTEGER)), 0.0) AS anomaly_ratio
FROM flagged
""",
    "publish_messages": _READINGS + "SELECT sensor_type AS key, json_payload AS value FROM flagged",
    "replays_dropped": _READINGS + """
SELECT * FROM curated UNION ALL SELECT * REPLACE ('other' AS topic) FROM curated
""",
    "window_averages": _windows("5 minutes"),
    "window_averages_stream_update": _windows("5 minutes"),
    "window_averages_stream_append": _windows(
        "5 minutes", "window_end <= (SELECT max(event_time) FROM curated) - INTERVAL '2 minutes'"
    ),
    "window_averages_stream_revisions": _windows("1 day"),
    "stream_ingest_zones": _zone_counts(),
    "stream_ingest_shared": _zone_counts(),
    "raw_zone_roundtrip": _RAW,
    "zone_roundtrip": _CURATED,
    "consumption_zone_roundtrip": _windows("5 minutes"),
    "report_csv": _TOP_HOURS,
}


def _anomalies(limit: int) -> str:
    return _READINGS + f"""
SELECT sensor_type, value, unit, event_time, reading_source, producer_anomaly, is_anomaly
FROM curated WHERE is_anomaly
ORDER BY event_time DESC, kafka_partition, kafka_offset LIMIT {limit}
"""


ORACLES |= {
    "rejected_zone_roundtrip": ORACLES["reject_reasons"],
    "submit_job": _SUBMISSIONS + """
SELECT coalesce(message, '') AS message, coalesce(status, 202) AS status, count(*) AS body_count
FROM answered GROUP BY 1, 2
""",
    "recent_anomaly_records": "WITH recent AS (" + _anomalies(50) + """)
SELECT '{"sensor_type":"' || sensor_type || '","value":' || CAST(value AS VARCHAR)
  || ',"unit":"' || unit || '","event_time":"' || strftime(event_time, '%Y-%m-%dT%H:%M:%S')
  || '+00:00","reading_source":"' || reading_source || '","producer_anomaly":'
  || CASE WHEN sensor_type = 'humidity' THEN 'null' ELSE 'true' END
  || ',"is_anomaly":true}' AS record
FROM recent
""",
    "window_averages_stream_late": _READINGS.replace(
        "FROM flagged WHERE plausible\n",
        """FROM flagged WHERE plausible
  AND NOT (event_id % 17 = 0 AND ts < (SELECT min(ts) + (max(ts) - min(ts)) / 2 FROM events))
""",
    )
    + _windows("5 minutes").removeprefix(_READINGS),
    "rerun_zone": _zone_counts("epoch_us(ts) < (SELECT avg(epoch_us(ts)) FROM events)"),
    "compacted_zone": _READINGS + """
SELECT sensor_type, count(*) AS row_count,
  count(DISTINCT CAST(event_time AS DATE)) AS directories, round(sum(value), 2) AS total
FROM curated GROUP BY 1
""",
    "partition_counts_from_zone": ORACLES["partition_counts"],
    "daily_stats_from_zone": ORACLES["daily_stats"],
    "recent_anomalies_from_zone": _anomalies(500),
    "tail_from_zone": ORACLES["tail_messages"],
    "latest_reading_from_zone": ORACLES["latest_reading"],
}

ORACLES |= {
    "tail_from_mixed_zone": ORACLES["tail_messages"],
    "tail_from_compacted_zone": ORACLES["tail_messages"],
    "log_gaps": _READINGS + """
, kept AS (
  SELECT kafka_partition, kafka_offset, lead(kafka_offset) OVER (
    PARTITION BY kafka_partition ORDER BY kafka_offset) AS following
  FROM flagged WHERE event_id % 1000 NOT BETWEEN 100 AND 120
)
SELECT 'sensor-events' AS topic, kafka_partition, kafka_offset + 1 AS first_offset,
  following - 1 AS last_offset
FROM kept WHERE following > kafka_offset + 1
""",
    "log_overlaps": _READINGS + """
, ranges AS (
  SELECT kafka_partition, min(kafka_offset) AS a, max(kafka_offset) + 1 AS b
  FROM flagged GROUP BY kafka_partition, date_trunc('hour', ts)
  UNION ALL
  SELECT kafka_partition, min(kafka_offset), max(kafka_offset) + 1
  FROM flagged WHERE day(ts) % 3 = 1 GROUP BY kafka_partition, date_trunc('day', ts)
), edges AS (
  SELECT kafka_partition, edge, sum(step) AS step FROM (
    SELECT kafka_partition, a AS edge, 1 AS step FROM ranges
    UNION ALL SELECT kafka_partition, b, -1 FROM ranges)
  GROUP BY 1, 2 HAVING sum(step) <> 0
), counted AS (
  SELECT kafka_partition, edge, lead(edge) OVER log AS following,
    sum(step) OVER (log ROWS UNBOUNDED PRECEDING) AS times
  FROM edges WINDOW log AS (PARTITION BY kafka_partition ORDER BY edge)
)
SELECT 'sensor-events' AS topic, kafka_partition, edge AS first_offset,
  following - 1 AS last_offset, CAST(times AS BIGINT) AS times
FROM counted WHERE times > 1
""",
    "unaccounted_messages": _READINGS + """
SELECT 'sensor-events' AS topic, kafka_partition, kafka_offset, 1 AS left_messages,
  CASE WHEN kafka_offset % 997 = 5 THEN 0 ELSE 2 END AS right_messages
FROM flagged WHERE plausible AND (kafka_offset % 997 = 5 OR kafka_offset % 1013 = 7)
""",
    "sensor_statistics_from_summaries": ORACLES["sensor_statistics"],
    "top_anomaly_hours_from_summaries": ORACLES["top_anomaly_hours"],
    "temperature_daily_from_summaries": ORACLES["temperature_daily"],
    "partition_counts_from_summaries": ORACLES["partition_counts"],
    "recent_anomalies_from_summaries": _anomalies(500),
    "zone_while_compacting": ORACLES["zone_roundtrip"],
    "settled_consumption": _windows("1 day"),
    "guarded_scans": _READINGS + """
SELECT 'there' AS zone, count(*) AS row_count FROM curated
UNION ALL SELECT 'missing', 0
""",
    "curated_view_sql": _READINGS + """
SELECT sensor_type, count(*) AS row_count,
  CAST(count(*) FILTER (WHERE is_anomaly) AS BIGINT) AS anomaly_count
FROM curated GROUP BY 1
""",
    "daily_stats_of_text_times": _READINGS.replace(
        "FROM flagged WHERE plausible\n", "FROM flagged WHERE plausible AND kafka_offset % 10 <> 3\n"
    )
    + _daily("humidity", "2024-01-24"),
}

_NEAR_IMPLAUSIBLE = """EXISTS (
  SELECT 1 FROM flagged AS bad
  WHERE bad.plausible = false AND bad.sensor_type = curated.sensor_type
    AND curated.event_time >= bad.event_time - INTERVAL 10 MINUTE
    AND curated.event_time < bad.event_time + INTERVAL 10 MINUTE)"""

ORACLES |= {
    "quarantined_readings": _READINGS + f"SELECT * FROM curated WHERE {_NEAR_IMPLAUSIBLE}",
    "trusted_counts": _READINGS
    + f"SELECT sensor_type, count(*) AS row_count FROM curated WHERE NOT {_NEAR_IMPLAUSIBLE} GROUP BY 1",
    "late_windows_corrected": _windows("5 minutes"),
    "window_averages_stream_repeats": _windows("5 minutes"),
}
