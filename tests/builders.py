"""Small hand-made inputs."""

from __future__ import annotations

import json
from datetime import datetime, timezone

from gaugeline.functions.times import as_utc
from gaugeline.schemas import CURATED, KAFKA_RECORD

TOPIC = "sensor-events"


def utc(*parts: int) -> datetime:
    return datetime(*parts, tzinfo=timezone.utc)


def millis(moment: datetime) -> int:
    return int(moment.timestamp() * 1000)


def payload(sensor="temperature", value=20.5, timestamp=0, **other) -> str:
    body = {
        "sensor": sensor,
        "value": value,
        "unit": "C",
        "timestamp": timestamp,
        "source": "site-1",
        "anomaly": False,
        **other,
    }
    return json.dumps({k: v for k, v in body.items() if v is not ...})


def messages(spark, payloads, *, key="temperature", partition=0, first_offset=0, arrived=None):
    """One log partition of messages in the given order."""
    arrived = as_utc(arrived or utc(2024, 1, 1))
    rows = [
        (
            key.encode(),
            None if text is None else text.encode(),
            TOPIC,
            partition,
            first_offset + n,
            arrived,
            0,
        )
        for n, text in enumerate(payloads)
    ]
    return spark.createDataFrame(rows, KAFKA_RECORD)


def curated(spark, rows):
    """CURATED rows from (sensor, value, event time, is_anomaly)."""
    data = [
        (
            sensor,
            value,
            "u",
            millis(when),
            "site-1",
            flag,
            sensor,
            when,
            0,
            n,
            when,
            when,
            flag,
            TOPIC,
            "iot",
            when.year,
            when.month,
            when.day,
        )
        for n, (sensor, value, when, flag) in enumerate(rows)
    ]
    return spark.createDataFrame(data, CURATED)


def tuples(frame) -> list[tuple]:
    return [tuple(row) for row in frame.collect()]
