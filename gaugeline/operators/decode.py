"""Raw messages -> validated, flagged, curated readings.

The stream's validation is lenient: it looks at sensor, value and time only,
and compares the sensor name as written. Rows it refuses are not lost, see
``rejected``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gaugeline.functions.payloads import decode_event
from gaugeline.functions.rules import RuleSet
from gaugeline.functions.times import date_parts, event_time, in_event_range
from gaugeline.schemas import CURATED, REJECTED

# Reject reasons in the order of the checks.
NO_PAYLOAD = "no_payload"
SENSOR_MISSING = "sensor_missing"
SENSOR_UNSUPPORTED = "sensor_unsupported"
VALUE_MISSING = "value_missing"
TIMESTAMP_MISSING = "timestamp_missing"
TIMESTAMP_OUT_OF_RANGE = "timestamp_out_of_range"
VALUE_IMPLAUSIBLE = "value_implausible"

EVENT_COLUMNS = {
    "sensor": "sensor_type",
    "value": "value",
    "unit": "unit",
    "timestamp": "event_timestamp_ms",
    "source": "reading_source",
    "anomaly": "producer_anomaly",
}
ENVELOPE_COLUMNS = (
    "message_key",
    "topic",
    "kafka_timestamp",
    "kafka_partition",
    "kafka_offset",
    "ingestion_time",
)


MESSAGE_KEY = ("topic", "kafka_partition", "kafka_offset", "kafka_timestamp")


def decode(raw: DataFrame, *keep: str) -> DataFrame:
    """Parse ``json_payload`` once per row into the event's columns.

    The struct is unnested with ``inline`` rather than by field access: filters
    on its fields would otherwise be pushed below the projection, each with its
    own copy of the parser. Further columns of ``raw`` can be kept.
    """
    event = F.inline(F.array(decode_event(F.col("json_payload"))))
    return raw.select(
        *ENVELOPE_COLUMNS,
        *keep,
        F.coalesce(F.col("json_payload") != "", F.lit(False)).alias("has_payload"),
        event.alias(*EVENT_COLUMNS.values()),
    )


def judge(decoded: DataFrame, rules: RuleSet, *, max_future_skew: str | None = None) -> DataFrame:
    """Add the rule columns, ``time_ok`` and ``event_time``.

    ``max_future_skew`` (an interval such as ``"1 hour"``) also refuses events
    dated that much after their arrival: one of them would push the watermark
    ahead and make all regular rows late.
    """
    ms = F.col("event_timestamp_ms")
    judged = rules.judge(decoded, "sensor_type", "value").withColumn("event_time", event_time(ms))
    time_ok = in_event_range(ms)
    if max_future_skew is not None:
        limit = F.col("kafka_timestamp") + F.expr(f"INTERVAL {max_future_skew}")
        time_ok = time_ok & F.coalesce(F.col("event_time") <= limit, F.lit(True))
    return judged.withColumn("time_ok", time_ok)


def accepted(judged: DataFrame) -> DataFrame:
    """Readings that pass every check; the exact complement of ``rejected``."""
    return judged.where(
        F.col("known")
        & F.col("value").isNotNull()
        & F.col("event_timestamp_ms").isNotNull()
        & F.col("time_ok")
        & F.col("plausible")
    )


def reject_reason() -> Column:
    """First failed check of a judged row, NULL if none failed.

    Every check comes after those that rule out NULL in its own columns.
    """
    return (
        F.when(~F.col("has_payload"), NO_PAYLOAD)
        .when(F.col("sensor_type").isNull(), SENSOR_MISSING)
        .when(~F.col("known"), SENSOR_UNSUPPORTED)
        .when(F.col("value").isNull(), VALUE_MISSING)
        .when(F.col("event_timestamp_ms").isNull(), TIMESTAMP_MISSING)
        .when(~F.col("time_ok"), TIMESTAMP_OUT_OF_RANGE)
        .when(~F.col("plausible"), VALUE_IMPLAUSIBLE)
    )


def with_curated_columns(readings: DataFrame) -> DataFrame:
    return (
        readings.withColumn("domain", F.lit("iot"))
        .withColumns(date_parts(F.col("event_time"), "year", "month", "day"))
        .select(*CURATED.fieldNames())
    )


def readings_of(
    raw: DataFrame, rules: RuleSet | None = None, *, max_future_skew: str | None = None
) -> DataFrame:
    """Accepted readings of raw messages, batch or stream, before partition columns."""
    return accepted(judge(decode(raw), rules or RuleSet(), max_future_skew=max_future_skew))


def curated_readings(
    raw: DataFrame, rules: RuleSet | None = None, *, max_future_skew: str | None = None
) -> DataFrame:
    """CURATED rows of raw messages, batch or stream."""
    return with_curated_columns(readings_of(raw, rules, max_future_skew=max_future_skew))


def rejected(
    raw: DataFrame, rules: RuleSet | None = None, *, max_future_skew: str | None = None
) -> DataFrame:
    """Refused messages with ``reject_reason`` and their place in the log."""
    decoded = decode(raw, "json_payload")
    judged = judge(decoded, rules or RuleSet(), max_future_skew=max_future_skew)
    return (
        judged.withColumn("reject_reason", reject_reason())
        .where(F.col("reject_reason").isNotNull())
        .withColumns(date_parts(F.col("ingestion_time"), "year", "month", "day"))
        .select(*REJECTED.fieldNames())
    )


def reject_counts(rejects: DataFrame) -> DataFrame:
    return rejects.groupBy("reject_reason").agg(F.count("*").alias("message_count"))


def drop_replayed(rows: DataFrame) -> DataFrame:
    """Keep one row per message, named by its place in the log and the log's time for it.

    Only lakes written in append mode need this: at-least-once delivery can
    store a message twice. Two topics share places, and so do a topic and the one
    that was made anew under its name; the time tells the latter apart. The key is
    unique per message, so no group is large.
    """
    return rows.dropDuplicates([c for c in MESSAGE_KEY if c in rows.columns])


def near_arrival(readings: DataFrame, limit: str) -> DataFrame:
    """Readings dated no more than ``limit`` after their arrival.

    A single one from the far future would push a watermark ahead and make all
    regular rows late. Rows without an arrival time are kept.
    """
    latest = F.col("kafka_timestamp") + F.expr(f"INTERVAL {limit}")
    return readings.where(F.coalesce(F.col("event_time") <= latest, F.lit(True)))
