"""Column names, order and types of every table in the lake.

All zones are read with a declared schema: inference would scan the data and
would turn the JSON timestamps into strings.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T


_TYPES = {
    "binary": T.BinaryType(),
    "string": T.StringType(),
    "boolean": T.BooleanType(),
    "int": T.IntegerType(),
    "bigint": T.LongType(),
    "double": T.DoubleType(),
    "timestamp": T.TimestampType(),
    "timestamp_ntz": T.TimestampNTZType(),
}


def _schema(columns: str) -> T.StructType:
    """``"a int, b string"`` as a schema; needs no running session."""
    pairs = [column.split() for column in columns.split(",")]
    return T.StructType([T.StructField(name, _TYPES[kind]) for name, kind in pairs])


# Records as the Kafka connector delivers them; replay files use the same shape.
KAFKA_RECORD = _schema(
    "key binary, value binary, topic string, partition int, offset bigint, "
    "timestamp timestamp, timestampType int"
)

# A generic event table, which can be read as a sensor topic.
EVENT_TABLE = _schema(
    "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string"
)

# JSON value of one message; ``timestamp`` is epoch milliseconds.
EVENT = _schema(
    "sensor string, value double, unit string, timestamp bigint, source string, anomaly boolean"
)

RAW = _schema(
    "message_key string, json_payload string, kafka_timestamp timestamp, "
    "kafka_partition int, kafka_offset bigint, ingestion_time timestamp, "
    "source string, topic string, year int, month int, day int, hour int"
)

CURATED = _schema(
    "sensor_type string, value double, unit string, event_timestamp_ms bigint, "
    "reading_source string, producer_anomaly boolean, message_key string, "
    "kafka_timestamp timestamp, kafka_partition int, kafka_offset bigint, "
    "ingestion_time timestamp, event_time timestamp, is_anomaly boolean, topic string, "
    "domain string, year int, month int, day int"
)

# Refused messages with the first check they fail, and their text as it came.
REJECTED = _schema(
    "message_key string, topic string, kafka_timestamp timestamp, kafka_partition int, "
    "kafka_offset bigint, ingestion_time timestamp, sensor_type string, value double, "
    "event_timestamp_ms bigint, json_payload string, "
    "reject_reason string, year int, month int, day int"
)

# Refused submissions; ``received_day`` is the day of the job that refused them.
REFUSED = _schema("body string, message string, status int, received_day string")

# ``batch_id`` is the micro-batch that emitted the revision of the window.
CONSUMPTION = _schema(
    "window_start timestamp, window_end timestamp, sensor_type string, "
    "mean_value double, min_value double, max_value double, "
    "observation_count bigint, anomaly_count bigint, "
    "use_case string, year int, month int, batch_id bigint"
)

# A leaf directory under every partition that names the write which made it, so
# that a repeated write replaces its own files and nothing else.
WRITE_ID = "write_id"


@dataclass(frozen=True)
class Zone:
    """Storage layout of one zone of the lake."""

    name: str
    schema: T.StructType
    format: str
    partitions: tuple[str, ...]

    @property
    def columns(self) -> list[str]:
        return self.schema.fieldNames()

    @property
    def stored_schema(self) -> T.StructType:
        return T.StructType([*self.schema.fields, T.StructField(WRITE_ID, T.StringType())])


RAW_ZONE = Zone("raw", RAW, "json", ("source", "topic", "year", "month", "day", "hour"))
CURATED_ZONE = Zone(
    "curated", CURATED, "parquet", ("domain", "sensor_type", "year", "month", "day")
)
# Where in the log the rows of each raw hour are from, and of which write. Without
# ``raw_write`` it is the write that recorded them.
OFFSETS = _schema(
    "kafka_partition int, first_offset bigint, last_offset bigint, raw_write string, topic string, "
    "year int, month int, day int, hour int"
)
OFFSETS_ZONE = Zone("raw_offsets", OFFSETS, "parquet", ("topic",))
REJECTED_ZONE = Zone("rejected", REJECTED, "parquet", ("reject_reason", "year", "month", "day"))
REFUSED_ZONE = Zone("refused", REFUSED, "parquet", ("received_day",))
CONSUMPTION_ZONE = Zone(
    "consumption", CONSUMPTION, "parquet", ("use_case", "sensor_type", "year", "month")
)
# What reports need of one sensor and hour; ``made_of`` names the files it was made of.
SUMMARIES = _schema(
    "hour timestamp, n bigint, mean double, m2 double, min_value double, max_value double, "
    "anomalies bigint, latest_anomaly timestamp, made_of string, "
    "sensor_type string, year int, month int, day int"
)
SUMMARIES_ZONE = Zone("summaries", SUMMARIES, "parquet", ("sensor_type", "year", "month", "day"))
