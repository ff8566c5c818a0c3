"""Reports from stored summaries of the curated zone, made again only where it has changed.

A summary row holds what the reports need of one sensor and hour: how many readings, their
mean, their squared deviations from it, extremes, and the anomalies with the latest of
them. Rows of hours are merged to days, sensors or everything by the pairwise rule for
variances, so a report reads a few thousand rows in place of the lake.

``refresh`` compares the files of each partition with those its summary was made of, and
makes anew what differs: added, repeated, compacted and removed writes alike.
"""

from __future__ import annotations

import hashlib
from collections import defaultdict
from datetime import datetime, timedelta
from decimal import Decimal

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gaugeline.functions.rules import RuleSet
from gaugeline.functions.times import day_text, hour_text, partition_day, timestamp_literal
from gaugeline.plans.reports import count_rows
from gaugeline.plans.serving import MAX_LIMIT, RECENT_COLUMNS
from gaugeline.schemas import CURATED_ZONE, SUMMARIES_ZONE
from gaugeline.sinks.files import delete_directories
from gaugeline.sources.lake import read_curated, read_zone
from gaugeline.sources.snapshots import Directory, live_directories, zone_path

PARTITION = ("sensor_type", "year", "month", "day")
_MERGED = ("n", "mean", "m2", "min_value", "max_value", "anomalies", "latest_anomaly")


def summarize(curated: DataFrame) -> DataFrame:
    """Summary rows by sensor, day and hour, without ``made_of``."""
    return (
        curated.groupBy(*PARTITION, F.date_trunc("hour", "event_time").alias("hour"))
        .agg(
            F.count("*").alias("n"),
            F.avg("value").alias("mean"),
            (F.var_pop("value") * F.count("value")).alias("m2"),
            F.min("value").alias("min_value"),
            F.max("value").alias("max_value"),
            F.count_if("is_anomaly").alias("anomalies"),
            F.max(F.when(F.col("is_anomaly"), F.col("event_time"))).alias("latest_anomaly"),
        )
        .select(*PARTITION, "hour", *_MERGED)
    )


def merge(summaries: DataFrame, *keys: str) -> DataFrame:
    """Summary rows of larger groups: deviations from the common mean are those from the
    own means and of these from the common one."""
    groups = summaries.groupBy(*keys).agg(
        (F.sum(F.col("n") * F.col("mean")) / F.sum("n")).alias("common_mean")
    )
    apart = F.col("n") * F.pow(F.col("mean") - F.col("common_mean"), 2)
    # Both sides have some rows for each hour at most.
    return (
        summaries.join(groups, list(keys))
        .groupBy(*keys)
        .agg(
            F.sum("n").alias("n"),
            F.any_value("common_mean").alias("mean"),
            F.sum(F.col("m2") + apart).alias("m2"),
            F.min("min_value").alias("min_value"),
            F.max("max_value").alias("max_value"),
            F.sum("anomalies").alias("anomalies"),
            F.max("latest_anomaly").alias("latest_anomaly"),
        )
    )


def read_summaries(spark: SparkSession, root: str) -> DataFrame:
    return read_zone(spark, root, SUMMARIES_ZONE)


def _partitions(directories: list[Directory]) -> list[tuple]:
    """(sensor_type, year, month, day, name of the files) of every curated partition."""
    files = defaultdict(list)
    for directory in directories:
        parts = dict(zip(CURATED_ZONE.partitions, directory.values))
        key = (parts["sensor_type"], *(int(parts[k]) for k in PARTITION[1:]))
        files[key] += [f"{directory.write_id}/{name}" for name in directory.files]
    return [
        (*key, hashlib.md5("\n".join(sorted(names)).encode()).hexdigest()) for key, names in files.items()
    ]


def refresh(spark: SparkSession, root: str) -> int:
    """Make the summaries of changed partitions anew; returns the number of partitions.

    The zone is listed, not read; what is read are the changed partitions. Cut off and
    run again it does what is left.
    """
    schema = "sensor_type string, year int, month int, day int, made_of string"
    listed = spark.createDataFrame(_partitions(live_directories(spark, root, CURATED_ZONE)), schema)
    known = read_summaries(spark, root).select(*PARTITION, "made_of").distinct()
    changed = listed.join(known, [*PARTITION, "made_of"], "left_anti").collect()
    gone = {tuple(r) for r in known.join(listed, list(PARTITION), "left_anti").select(*PARTITION).collect()}
    if gone:
        stored = live_directories(spark, root, SUMMARIES_ZONE)
        paths = [d.path for d in stored if (d.values[0], *map(int, d.values[1:])) in gone]
        delete_directories(spark, paths)
    if changed:
        wanted = spark.createDataFrame(changed, schema)
        rows = read_curated(spark, root)
        for name in ("year", "month"):
            # Bare literals, so the scan skips other partitions before it is planned.
            met = sorted({r[name] for r in changed})
            rows = rows.where(F.col(name).isin(met)) if len(met) <= 24 else rows
        rows = rows.join(F.broadcast(wanted.select(*PARTITION)), list(PARTITION), "left_semi")
        made = summarize(rows).join(F.broadcast(wanted), list(PARTITION))
        (
            made.select(*SUMMARIES_ZONE.columns)
            .repartition(*PARTITION)
            .write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .partitionBy(*SUMMARIES_ZONE.partitions)
            .parquet(zone_path(root, SUMMARIES_ZONE))
        )
    return len(changed) + len(gone)


# ---- reports

def top_anomaly_hours(summaries: DataFrame, n: int = 5) -> DataFrame:
    """The same as ``reports.top_anomaly_hours`` of the curated rows."""
    return (
        summaries.groupBy("hour")
        .agg(F.sum("anomalies").alias("anomaly_count"))
        .where("anomaly_count > 0")
        .select(hour_text(F.col("hour")).alias("hour_bucket"), "anomaly_count")
        .orderBy(F.desc("anomaly_count"), F.asc("hour_bucket"))
        .limit(n)
    )


def sensor_statistics(summaries: DataFrame) -> DataFrame:
    """The same as ``reports.sensor_statistics`` of the curated rows."""
    rate = F.lit(Decimal("100.0")) * F.col("anomalies") / F.col("n")
    deviation = F.when(F.col("n") > 1, F.sqrt(F.col("m2") / (F.col("n") - 1)))
    return (
        merge(summaries, "sensor_type")
        .select(
            "sensor_type",
            F.round("mean", 2).alias("global_mean"),
            F.round("min_value", 2).alias("min_value"),
            F.round("max_value", 2).alias("max_value"),
            F.round(deviation, 2).alias("stddev_value"),
            F.round(rate, 2).alias("anomaly_rate_pct"),
        )
        .orderBy("sensor_type")
    )


def daily_evolution(summaries: DataFrame, sensor: str = "temperature") -> DataFrame:
    """The same as ``reports.daily_evolution`` of the curated rows."""
    days = summaries.where(F.col("sensor_type") == sensor).withColumn("date", partition_day(summaries))
    return (
        merge(days, "date")
        .select(
            day_text(F.col("date")).alias("event_day"),
            F.round("mean", 2).alias("mean_temperature"),
            F.col("anomalies").alias("anomaly_count"),
        )
        .orderBy("event_day")
    )


def partition_counts(summaries: DataFrame) -> DataFrame:
    """The same as ``reports.partition_counts`` of the curated rows."""
    return count_rows(summaries.groupBy(*PARTITION).agg(F.sum("n").alias("rows")))


def recent_anomalies(
    summaries: DataFrame,
    curated: DataFrame,
    sensor: str | None = None,
    limit: int = 20,
    *,
    rules: RuleSet | None = None,
) -> DataFrame:
    """The same as ``serving.recent_anomalies``, from the newest hours that hold enough.

    The summaries say how many anomalies each hour has. Newest first, hours are taken until
    they have ``limit`` of them; no other can add to the result, and none is opened. Rows
    added since the last refresh only make the search longer than it had to be.
    """
    if not 1 <= limit <= MAX_LIMIT:
        raise ValueError(f"limit must be between 1 and {MAX_LIMIT}")
    hours, anomalies = summaries.where("anomalies > 0"), curated.where("is_anomaly")
    if sensor:
        name = (rules or RuleSet()).require(sensor)
        hours = hours.where(F.col("sensor_type") == name)
        anomalies = anomalies.where(F.col("sensor_type") == name)
    # Each hour has an anomaly at least, so no more hours than rows are needed.
    newest = (
        hours.groupBy("hour").agg(F.sum("anomalies").alias("anomalies"))
        .orderBy(F.desc("hour")).limit(limit)
        .select((F.unix_micros("hour") / 1_000_000).cast("bigint").alias("seconds"), "anomalies")
        .collect()
    )
    total, since = 0, None
    for seconds, n in newest:
        total, since = total + n, seconds
        if total >= limit:
            break
    if since is not None:
        start = datetime(1970, 1, 1) + timedelta(seconds=since)
        anomalies = anomalies.where(
            (partition_day(anomalies) >= F.lit(start.date()))
            & (F.col("event_time") >= timestamp_literal(start))
        )
    return (
        anomalies.orderBy(F.desc_nulls_last("event_time"), "kafka_partition", "kafka_offset")
        .limit(limit)
        .select(*RECENT_COLUMNS)
    )
