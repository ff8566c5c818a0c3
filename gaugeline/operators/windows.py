"""Tumbling event-time averages per sensor."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gaugeline.functions.times import date_parts

WINDOW = "5 minutes"
WATERMARK = "2 minutes"
USE_CASE = "sensor_averages"

_KEYS = ("window_start", "window_end", "sensor_type")
_MEASURES = ("mean_value", "min_value", "max_value", "observation_count", "anomaly_count")


def without_repeats(readings: DataFrame, *, watermark: str = WATERMARK) -> DataFrame:
    """Stream readings, each message once as long as its time is within the watermark.

    A message that is sent or read again would count twice in its window. The state
    holds the places in the log of messages not older than the watermark.
    """
    return readings.withWatermark("event_time", watermark).dropDuplicatesWithinWatermark(
        ["topic", "kafka_partition", "kafka_offset"]
    )


def window_averages(
    readings: DataFrame, *, window: str = WINDOW, watermark: str | None = WATERMARK
) -> DataFrame:
    """Mean, extremes and counts per ``[start, end)`` window and sensor.

    On a stream the watermark drops late rows here and nowhere else. A row is
    judged against the watermark of the data up to the batch before the last, so
    a late row right after the advance is still accepted. In batch the watermark
    has no effect. All rows of a sensor are combined before the shuffle, so a
    sensor that holds most of the data makes no large task. ``watermark`` None is for
    readings that have one.
    """
    marked = readings if watermark is None else readings.withWatermark("event_time", watermark)
    return (
        marked.groupBy(F.window("event_time", window), "sensor_type")
        .agg(
            F.avg("value").alias("mean_value"),
            F.min("value").alias("min_value"),
            F.max("value").alias("max_value"),
            F.count("*").alias("observation_count"),
            F.count_if("is_anomaly").alias("anomaly_count"),
        )
        .select(
            F.col("window.start").alias("window_start"),
            F.col("window.end").alias("window_end"),
            "sensor_type",
            *_MEASURES,
        )
        .withColumn("use_case", F.lit(USE_CASE))
        .withColumns(date_parts(F.col("window_start"), "year", "month"))
    )


def latest_revision(consumption: DataFrame) -> DataFrame:
    """One row per window and sensor out of all emitted revisions.

    Update mode emits a window again whenever rows were added to it, so the
    largest ``observation_count`` is the latest state; ``batch_id`` only breaks
    ties between runs. This also settles a replay from a lost checkpoint, where
    batch numbers start again.
    """
    order = F.struct("observation_count", F.coalesce("batch_id", F.lit(-1)))
    row = F.struct(*_MEASURES, "use_case", "year", "month", "batch_id")
    return (
        consumption.groupBy(*_KEYS)
        .agg(F.max_by(row, order).alias("latest"))
        .select(*_KEYS, "latest.*")
    )


def corrected_averages(
    curated: DataFrame, late: DataFrame, *, window: str = WINDOW, watermark: str = WATERMARK
) -> DataFrame:
    """Windows that ``late`` rows belong to, from all curated rows of those windows.

    A stream leaves out rows that come after the watermark; they are curated all the same.
    Written as a further revision these windows replace the emitted ones, whose counts are
    smaller. Only days that late rows fall on are read, by their partitions.
    """
    span = F.window("event_time", window)
    keys = late.select("sensor_type", span.alias("span")).select("sensor_type", "span.start").distinct()
    affected = keys.select(F.col("sensor_type").alias("hit_sensor"), F.col("start").alias("hit_start"))
    # The partitions of both ends of each window, by bare columns.
    days = [F.to_date("start"), F.to_date(F.col("start") + F.expr(f"INTERVAL {window}"))]
    touched = keys.select("sensor_type", F.explode(F.array(*days)).alias("day")).select(
        F.col("sensor_type").alias("hit_sensor"),
        F.year("day").alias("hit_year"),
        F.month("day").alias("hit_month"),
        F.dayofmonth("day").alias("hit_day"),
    )
    rows = curated
    if {"year", "month", "day"} <= set(curated.columns):
        same = (
            (rows["sensor_type"] == touched["hit_sensor"]) & (rows["year"] == touched["hit_year"])
            & (rows["month"] == touched["hit_month"]) & (rows["day"] == touched["hit_day"])
        )
        rows = rows.join(touched.distinct(), same, "left_semi")
    placed = rows.withColumn("span", span)
    hit = (placed["sensor_type"] == affected["hit_sensor"]) & (placed["span.start"] == affected["hit_start"])
    rows = placed.join(affected, hit, "left_semi").drop("span")
    return window_averages(rows, window=window, watermark=watermark)
