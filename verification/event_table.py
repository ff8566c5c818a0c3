"""A generic ``events`` table seen as a sensor topic.

Used to run the engine on existing event data: the event type names the sensor,
the event id gives the place in a log of three partitions.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from gaugeline.functions.rules import RuleSet
from gaugeline.schemas import EVENT, EVENT_TABLE

TOPIC = "sensor-events"
LOG_PARTITIONS = 3
TABLE_FILE = "events.parquet"

# Which event types are sensors, and how their values are shifted
# into the range of the sensor. Other types keep their name and value.
_SENSOR = """CASE event_type WHEN 'view' THEN 'temperature' WHEN 'click' THEN 'humidity'
  WHEN 'purchase' THEN 'pressure' ELSE event_type END"""
_VALUE = """CASE event_type WHEN 'view' THEN round(value - 60, 2)
  WHEN 'purchase' THEN round(value + 960, 2) ELSE value END"""
_LOG_PARTITION = f"CAST(event_id % {LOG_PARTITIONS} AS INT)"
_LOG_OFFSET = f"event_id DIV {LOG_PARTITIONS}"


def read_event_table(spark: SparkSession, directory: str) -> DataFrame:
    return spark.read.schema(EVENT_TABLE).parquet(f"{directory.rstrip('/')}/{TABLE_FILE}")


def stream_event_table(spark: SparkSession, directory: str) -> DataFrame:
    """The same table as a stream of its files, be it one file or a folder of them."""
    # A stream's path must be a folder or a pattern, and this matches the one name.
    pattern = f"{directory.rstrip('/')}/[{TABLE_FILE[0]}]{TABLE_FILE[1:]}"
    return spark.readStream.schema(EVENT_TABLE).parquet(pattern)


def as_events(table: DataFrame, *keep: str) -> DataFrame:
    """EVENT rows of the table, after the columns to keep."""
    rules = RuleSet()
    # inline computes sensor and value once; as plain columns they would be
    # repeated in every rule that mentions them.
    sensed = table.selectExpr(
        *keep,
        "ts",
        "user_id",
        f"inline(array(named_struct('sensor', {_SENSOR}, 'value', {_VALUE})))",
    )
    return sensed.selectExpr(
        *keep,
        "sensor",
        "value",
        f"{rules.unit_sql('sensor')} AS unit",
        "unix_millis(CAST(ts AS TIMESTAMP)) AS timestamp",
        "concat('user-', user_id) AS source",
        f"{rules.anomaly_sql('sensor', 'value')} AS anomaly",
    )


def as_messages(table: DataFrame) -> DataFrame:
    """KAFKA_RECORD rows: the event as JSON, keyed by sensor."""
    return as_events(table, "event_id").selectExpr(
        "CAST(sensor AS BINARY) AS key",
        f"CAST(to_json(struct({', '.join(EVENT.fieldNames())})) AS BINARY) AS value",
        f"'{TOPIC}' AS topic",
        f"{_LOG_PARTITION} AS partition",
        f"{_LOG_OFFSET} AS offset",
        "timestamp_millis(timestamp) AS timestamp",
        "0 AS timestampType",
    )


# What the messages of ``error`` events hold instead, by the event's number.
_FAULTS = """CASE event_id % 6
  WHEN 0 THEN CAST(NULL AS STRING)
  WHEN 1 THEN left(payload, 12)
  WHEN 2 THEN concat('[', event_id, ']')
  WHEN 3 THEN concat('{"sensor":"humidity","value":null,"timestamp":', timestamp, '}')
  WHEN 4 THEN '{"sensor":"humidity","value":1.5}'
  ELSE '{"sensor":"humidity","value":1.5,"timestamp":999999999999999}' END"""


def as_faulty_messages(table: DataFrame) -> DataFrame:
    """The same messages, with faults of every kind in those of ``error`` events."""
    events = as_events(table, "event_id", "event_type", "ts")
    payload = f"to_json(struct({', '.join(EVENT.fieldNames())}))"
    return events.selectExpr("*", f"{payload} AS payload").selectExpr(
        "CAST(sensor AS BINARY) AS key",
        f"CAST(CASE WHEN event_type = 'error' THEN {_FAULTS} ELSE payload END AS BINARY) AS value",
        f"'{TOPIC}' AS topic",
        f"{_LOG_PARTITION} AS partition",
        f"{_LOG_OFFSET} AS offset",
        "timestamp_millis(unix_millis(CAST(ts AS TIMESTAMP))) AS timestamp",
        "0 AS timestampType",
    )


def as_decoded(table: DataFrame, ingestion_time: str) -> DataFrame:
    """What ``operators.decode.decode`` makes of ``as_messages``, without the
    detour through JSON, so column pruning reaches the table's files."""
    return as_events(table, "event_id").selectExpr(
        "sensor AS message_key",
        f"'{TOPIC}' AS topic",
        "timestamp_millis(timestamp) AS kafka_timestamp",
        f"{_LOG_PARTITION} AS kafka_partition",
        f"{_LOG_OFFSET} AS kafka_offset",
        f"{ingestion_time} AS ingestion_time",
        "true AS has_payload",
        "sensor AS sensor_type",
        "value",
        "unit",
        "timestamp AS event_timestamp_ms",
        "source AS reading_source",
        "anomaly AS producer_anomaly",
    )


def as_submissions(table: DataFrame) -> DataFrame:
    """Submitted bodies, one per event, with the faults clients make.

    The number in ``props`` decides what is wrong with a body, so that every
    check of the strict validation meets some of the rows.
    """
    numbered = table.selectExpr("*", "CAST(get_json_object(props, '$.k') AS INT) AS k")
    # A field is written as text or as a number; to_json leaves out the other.
    body = """replace(to_json(named_struct(
      'sensor', concat(' ', upper(sensor)),
      'value_text', CASE WHEN k < 5 THEN 'warm' WHEN k < 50 THEN CAST(value AS STRING) END,
      'value', CASE WHEN k >= 50 THEN value END,
      'unit', CASE WHEN k BETWEEN 5 AND 9 THEN 'K' ELSE coalesce(unit, 'C') END,
      'timestamp_text', CASE WHEN k BETWEEN 10 AND 14 THEN 'soon' END,
      'timestamp', CASE WHEN k > 19 THEN timestamp END,
      'source', CASE WHEN k NOT BETWEEN 20 AND 24 THEN concat(source, ' ') END,
      'anomaly', CASE WHEN k BETWEEN 30 AND 59 THEN k < 45 END)), '_text', '')"""
    return as_events(numbered, "event_id", "k").selectExpr(
        "event_id", f"CASE WHEN k BETWEEN 25 AND 27 THEN left({body}, 20) ELSE {body} END AS body"
    )
