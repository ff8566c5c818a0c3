"""Kafka record -> row of the raw zone."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gaugeline.functions.times import date_parts
from gaugeline.schemas import RAW


def raw_envelope(records: DataFrame, *, ingestion_time: Column | None = None) -> DataFrame:
    """RAW rows; nothing is parsed or dropped.

    ``ingestion_time`` defaults to the start of the batch, which a stream
    records in its checkpoint, so a repeated micro-batch gets the same value.
    """
    arrived = F.current_timestamp() if ingestion_time is None else ingestion_time
    return (
        records.select(
            F.col("key").cast("string").alias("message_key"),
            F.col("value").cast("string").alias("json_payload"),
            F.col("timestamp").alias("kafka_timestamp"),
            F.col("partition").alias("kafka_partition"),
            F.col("offset").alias("kafka_offset"),
            arrived.alias("ingestion_time"),
            F.lit("kafka").alias("source"),
            "topic",
        )
        .withColumns(date_parts(F.col("ingestion_time"), "year", "month", "day", "hour"))
        .select(*RAW.fieldNames())
    )
