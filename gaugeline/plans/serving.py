"""Queries behind a serving layer: bounded parameters, small results."""

from __future__ import annotations

from datetime import date, datetime, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gaugeline.functions.payloads import decode_event
from gaugeline.functions.rules import RuleSet
from gaugeline.functions.times import (
    as_utc,
    day_text,
    partition_day,
    timestamp_literal,
    typed_time,
)
from gaugeline.schemas import EVENT
from gaugeline.sources.tail import LOOKBACK, tail

MAX_DAYS = 90
MAX_LIMIT = 500

RECENT_COLUMNS = (
    "sensor_type",
    "value",
    "unit",
    "event_time",
    "reading_source",
    "producer_anomaly",
    "is_anomaly",
)

# Days looked at, one step after the other, by a search for recent rows.
SEARCH_DAYS = (1, 8, 64, 512)


def daily_stats(
    curated: DataFrame,
    sensor: str,
    days: int = 7,
    *,
    as_of: datetime | None = None,
    rules: RuleSet | None = None,
) -> DataFrame:
    """Daily figures of one sensor for the ``days`` before ``as_of`` (now).

    There is no upper bound, and the first day is partial. NaN counts as no
    value. The cut-off is also applied to the partition columns, so older days
    are not opened.
    """
    sensor = (rules or RuleSet()).require(sensor)
    if not 1 <= days <= MAX_DAYS:
        raise ValueError(f"days must be between 1 and {MAX_DAYS}")
    cutoff = as_utc(as_of) - timedelta(days=days)
    recent = typed_time(curated, "event_time").where(
        (F.col("sensor_type") == sensor)
        & (partition_day(curated) >= F.lit(cutoff.date()))
        & (F.col("event_time") >= timestamp_literal(cutoff))
    )
    value = F.nanvl("value", F.lit(None).cast("double"))
    return (
        recent.groupBy(F.to_date("event_time").alias("day"))
        .agg(
            F.round(F.avg(value), 2).alias("mean_value"),
            F.round(F.min(value), 2).alias("min_value"),
            F.round(F.max(value), 2).alias("max_value"),
            F.count(value).alias("observation_count"),
            F.count_if("is_anomaly").alias("anomaly_count"),
        )
        .select(
            day_text(F.col("day")).alias("event_day"),
            "mean_value",
            "min_value",
            "max_value",
            "observation_count",
            "anomaly_count",
        )
        .orderBy("event_day")
    )


def recent_anomalies(
    curated: DataFrame,
    sensor: str | None = None,
    limit: int = 20,
    *,
    as_of: datetime | None = None,
    rules: RuleSet | None = None,
) -> DataFrame:
    """The ``limit`` latest anomalies, of one sensor or of all.

    Rows of equal time are ordered by their place in the log. The search starts at the
    newest day there is, ``as_of`` if given, and goes back in growing steps until
    they hold enough rows, so a lake of years is read for its last days
    only. Days follow event time, so the result does not depend on where it starts.
    ``summaries.recent_anomalies`` needs no steps.
    """
    if not 1 <= limit <= MAX_LIMIT:
        raise ValueError(f"limit must be between 1 and {MAX_LIMIT}")
    anomalies = typed_time(curated, "event_time").where("is_anomaly")
    if sensor:
        anomalies = anomalies.where(F.col("sensor_type") == (rules or RuleSet()).require(sensor))
    anomalies = _newest_days(anomalies, limit, None if as_of is None else as_utc(as_of).date())
    return (
        anomalies.orderBy(F.desc_nulls_last("event_time"), "kafka_partition", "kafka_offset")
        .limit(limit)
        .select(*RECENT_COLUMNS)
    )


def _newest_days(rows: DataFrame, wanted: int, newest: date | None) -> DataFrame:
    """The shortest span of newest days that holds ``wanted`` rows, or all rows."""
    day = partition_day(rows)
    if newest is None:
        newest = rows.agg(F.max(day)).first()[0]
    for days in SEARCH_DAYS if newest else ():
        if (newest - date.min).days <= days:
            break
        span = rows.where(day > F.lit(newest - timedelta(days=days)))
        if span.select("is_anomaly").limit(wanted).count() == wanted:
            return span
    return rows


def latest_reading(
    raw: DataFrame,
    sensor: str,
    lookback: int = LOOKBACK,
    *,
    rules: RuleSet | None = None,
) -> DataFrame:
    """The sensor's reading of latest event time within the log's tail.

    Messages are taken as they are, without validation; a missing timestamp
    counts as 0. Of equal times the first in the log wins. No row if none.
    """
    return newest_of(tail(raw, lookback), (rules or RuleSet()).require(sensor))


def newest_of(messages: DataFrame, sensor: str) -> DataFrame:
    """The sensor's message of latest event time; each is parsed once."""
    event = F.inline(F.array(decode_event(F.col("json_payload"))))
    return (
        messages.select("kafka_partition", "kafka_offset", event)
        .where(F.col("sensor") == sensor)
        .orderBy(F.desc(F.coalesce("timestamp", F.lit(0))), "kafka_partition", "kafka_offset")
        .limit(1)
        .select(
            *EVENT.fieldNames(),
            F.struct(
                F.col("kafka_partition").alias("partition"), F.col("kafka_offset").alias("offset")
            ).alias("_kafka"),
        )
    )


def sensor_units(spark: SparkSession, rules: RuleSet | None = None) -> DataFrame:
    """The sensors and their units."""
    return (rules or RuleSet()).sensors(spark)


def reading_counts(readings: DataFrame, rules: RuleSet | None = None) -> DataFrame:
    """The number of readings at hand of every sensor, 0 for those without any."""
    rules = rules or RuleSet()
    counts = readings.groupBy("sensor_type").agg(F.count("*").alias("reading_count"))
    dimension = rules.sensors(readings.sparkSession)
    return dimension.join(counts, dimension["sensor"] == counts["sensor_type"], "left").select(
        "sensor", "unit", F.coalesce("reading_count", F.lit(0)).alias("reading_count")
    )


def run_summary(events: DataFrame) -> DataFrame:
    """Number of events, anomalies among them, and their ratio (0 if none)."""
    return events.agg(
        F.count("*").alias("event_count"),
        F.count_if("anomaly").alias("anomaly_count"),
        F.coalesce(F.avg(F.col("anomaly").cast("int")), F.lit(0.0)).alias("anomaly_ratio"),
    )
