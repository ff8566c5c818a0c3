"""Publishing events as keyed JSON messages."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gaugeline.config import Settings
from gaugeline.functions.payloads import encode
from gaugeline.schemas import EVENT

# Fixed values.
PRODUCER_OPTIONS = {
    "kafka.acks": "all",
    "kafka.retries": "5",
    "kafka.max.in.flight.requests.per.connection": "1",
    "kafka.linger.ms": "20",
    "kafka.batch.size": "32768",
}


def to_messages(events: DataFrame) -> DataFrame:
    """EVENT rows as ``key`` (the sensor) and ``value`` (compact JSON)."""
    return events.select(
        F.col("sensor").alias("key"), encode(*EVENT.fieldNames()).alias("value")
    )


def publish_options(settings: Settings) -> dict[str, str]:
    return {
        "kafka.bootstrap.servers": ",".join(settings.bootstrap_servers),
        "topic": settings.topic,
        **PRODUCER_OPTIONS,
    }


def publish(events: DataFrame, settings: Settings) -> None:
    """Send events to the topic, from every executor in parallel."""
    to_messages(events).write.format("kafka").options(**publish_options(settings)).save()
