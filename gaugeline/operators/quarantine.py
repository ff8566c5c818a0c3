"""Readings within intervals of time in which a sensor is not to be trusted.

Intervals that overlap or touch are merged first, so a reading lies in one at most. Both
sides meet on bins of time: an interval is a row in each bin it reaches into, a
reading in its own. Intervals are half open, [begin, end).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

BIN_SECONDS = 86_400

_KEYS = ("sensor_type", "begin", "end")


def _bin(when: Column, seconds: int) -> Column:
    return F.floor(F.unix_micros(when) / (seconds * 1_000_000))


def _merged(intervals: DataFrame, *groups: str) -> DataFrame:
    order = Window.partitionBy(*groups).orderBy("begin", "end")
    before = F.max("end").over(order.rowsBetween(Window.unboundedPreceding, -1))
    opens = F.coalesce(F.col("begin") > before, F.lit(True)).cast("int")
    island = F.sum("opens").over(order.rowsBetween(Window.unboundedPreceding, 0))
    return (
        intervals.withColumn("opens", opens)
        .withColumn("island", island)
        .groupBy(*groups, "island")
        .agg(F.min("begin").alias("begin"), F.max("end").alias("end"))
        .drop("island")
    )


def merged_intervals(intervals: DataFrame, *, bin_seconds: int = BIN_SECONDS) -> DataFrame:
    """The fewest intervals (sensor_type, begin, end) that cover the same times.

    Those that begin in one bin are merged first, so a sensor with most of the intervals is
    not ordered as a whole until few are left. Empty ones and those with a NULL are nothing.
    """
    real = intervals.select(*_KEYS).where(F.col("begin") < F.col("end"))
    binned = real.withColumn("bin", _bin(F.col("begin"), bin_seconds))
    return _merged(_merged(binned, "sensor_type", "bin"), "sensor_type").select(*_KEYS)


def _meeting(readings: DataFrame, intervals: DataFrame, bin_seconds: int) -> tuple[DataFrame, Column]:
    """Intervals by bin, under names of their own, and when a reading is in one."""
    merged = merged_intervals(intervals, bin_seconds=bin_seconds)
    last = _bin(F.col("end") - F.expr("INTERVAL 1 MICROSECOND"), bin_seconds)
    bins = merged.select(
        F.col("sensor_type").alias("bad_sensor"),
        F.col("begin").alias("bad_begin"),
        F.col("end").alias("bad_end"),
        F.explode(F.sequence(_bin(F.col("begin"), bin_seconds), last)).alias("bad_bin"),
    )
    inside = (
        (readings["sensor_type"] == bins["bad_sensor"])
        & (_bin(readings["event_time"], bin_seconds) == bins["bad_bin"])
        & (readings["event_time"] >= bins["bad_begin"])
        & (readings["event_time"] < bins["bad_end"])
    )
    return bins, inside


def quarantined(readings: DataFrame, intervals: DataFrame, *, bin_seconds: int = BIN_SECONDS) -> DataFrame:
    """The readings that lie in an interval of their sensor."""
    bins, inside = _meeting(readings, intervals, bin_seconds)
    return readings.join(bins, inside, "left_semi")


def trusted(readings: DataFrame, intervals: DataFrame, *, bin_seconds: int = BIN_SECONDS) -> DataFrame:
    """All other readings, those without a time or sensor among them."""
    bins, inside = _meeting(readings, intervals, bin_seconds)
    return readings.join(bins, inside, "left_anti")


def around(events: DataFrame, before: str, after: str) -> DataFrame:
    """Intervals around events (sensor_type, event_time), such as readings found implausible."""
    return events.select(
        "sensor_type",
        (F.col("event_time") - F.expr(f"INTERVAL {before}")).alias("begin"),
        (F.col("event_time") + F.expr(f"INTERVAL {after}")).alias("end"),
    )
