"""Batch reports over curated readings.

Groups are formed on whole hours and days (integers inside the engine) and
turned into text after the aggregation, so no row is formatted before it is
counted. Every aggregate combines on the map side first.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gaugeline.functions.times import day_text, hour_text

PARTITION_KEYS = ("sensor_type", "year", "month", "day")


def top_anomaly_hours(curated: DataFrame, n: int = 5) -> DataFrame:
    """The ``n`` hours with most anomalies; ties go to the earlier hour."""
    return (
        curated.where("is_anomaly")
        .groupBy(F.date_trunc("hour", "event_time").alias("hour"))
        .agg(F.count("*").alias("anomaly_count"))
        .select(hour_text(F.col("hour")).alias("hour_bucket"), "anomaly_count")
        .orderBy(F.desc("anomaly_count"), F.asc("hour_bucket"))
        .limit(n)
    )


def sensor_statistics(curated: DataFrame) -> DataFrame:
    """Mean, extremes, sample deviation and anomaly percentage per sensor."""
    rate = F.lit(Decimal("100.0")) * F.count_if("is_anomaly") / F.count("*")
    return (
        curated.groupBy("sensor_type")
        .agg(
            F.round(F.avg("value"), 2).alias("global_mean"),
            F.round(F.min("value"), 2).alias("min_value"),
            F.round(F.max("value"), 2).alias("max_value"),
            F.round(F.stddev_samp("value"), 2).alias("stddev_value"),
            F.round(rate, 2).alias("anomaly_rate_pct"),
        )
        .orderBy("sensor_type")
    )


def daily_evolution(curated: DataFrame, sensor: str = "temperature") -> DataFrame:
    """Daily mean and anomaly count of one sensor."""
    return (
        curated.where(F.col("sensor_type") == sensor)
        .groupBy(F.to_date("event_time").alias("day"))
        .agg(
            F.round(F.avg("value"), 2).alias("mean_temperature"),
            F.count_if("is_anomaly").alias("anomaly_count"),
        )
        .select(day_text(F.col("day")).alias("event_day"), "mean_temperature", "anomaly_count")
        .orderBy("event_day")
    )


def in_partition(curated: DataFrame, sensor_type: str, year: int, month: int, day: int) -> DataFrame:
    """Rows of one partition; the filter is on bare partition columns, so the
    scan lists and opens the files of that partition only."""
    return curated.where(
        (F.col("sensor_type") == sensor_type)
        & (F.col("year") == year)
        & (F.col("month") == month)
        & (F.col("day") == day)
    )


def first_partition(curated: DataFrame) -> tuple[str, int, int, int] | None:
    """Keys of the first partition in sort order, None without data."""
    distinct = curated.select(*PARTITION_KEYS).distinct()
    first = distinct.agg(F.min(F.struct(*PARTITION_KEYS)).alias("keys")).first()["keys"]
    return tuple(first) if first is not None else None


def partition_counts(curated: DataFrame) -> DataFrame:
    """Row count of everything and of the first partition; no rows without data.

    Both come from one pass: counts per partition are all either number needs,
    and a scan of partition columns alone reads no column data.
    """
    return count_rows(curated.groupBy(*PARTITION_KEYS).agg(F.count("*").alias("rows")))


def count_rows(per_partition: DataFrame) -> DataFrame:
    """``partition_counts`` from (PARTITION_KEYS, rows)."""
    totals = per_partition.agg(
        F.sum("rows").alias("all_rows"),
        F.min(F.struct(*PARTITION_KEYS, "rows")).alias("first"),
    ).where(F.col("all_rows").isNotNull())
    empty = F.lit("")
    full = _count_row("full_scan", F.col("all_rows"), [empty] * len(PARTITION_KEYS))
    pruned = _count_row(
        "partition_pruned",
        F.col("first.rows"),
        [F.col(f"first.{key}").cast("string") for key in PARTITION_KEYS],
    )
    return totals.select(F.inline(F.array(full, pruned)))


def _count_row(name: str, count: Column, filters: list[Column]) -> Column:
    return F.struct(
        F.lit(name).alias("query_type"),
        count.cast("string").alias("row_count"),
        *[
            value.alias(alias)
            for value, alias in zip(
                filters, ("sensor_type_filter", "year_filter", "month_filter", "day_filter")
            )
        ],
    )
