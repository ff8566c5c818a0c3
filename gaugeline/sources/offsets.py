"""Which offsets of the log each write of the raw zone holds, hour by hour.

Every write to the raw zone records the ranges it adds. This index knows what it does not
cover: raw directories of writes without an entry, such as those of a lake that is older than
the index, and the plain layout. Those alone are read for their ranges.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gaugeline.schemas import OFFSETS_ZONE, RAW_ZONE, WRITE_ID
from gaugeline.sources.lake import stored_rows
from gaugeline.sources.snapshots import directory_rows, live_directories

HOUR = ("topic", "year", "month", "day", "hour")
RANGE = ("kafka_partition", "first_offset", "last_offset", "raw_write", *HOUR)


def ranges_of(rows: DataFrame, raw_write) -> DataFrame:
    """First and last offset of each log partition, hour and write of raw rows."""
    return (
        rows.groupBy("kafka_partition", raw_write.alias("raw_write"), *HOUR)
        .agg(F.min("kafka_offset").alias("first_offset"), F.max("kafka_offset").alias("last_offset"))
        .select(*RANGE)
    )


def _raw_directories(spark: SparkSession, root: str) -> DataFrame:
    """(topic, hour, raw_write) of the live directories of the raw zone."""
    rows = directory_rows(spark, RAW_ZONE, live_directories(spark, root, RAW_ZONE))
    return rows.select(*HOUR, F.col(WRITE_ID).alias("raw_write")).distinct()


def _entries(spark: SparkSession, root: str) -> DataFrame | None:
    stored = stored_rows(spark, root, OFFSETS_ZONE)
    if stored is None:
        return None
    raw_write = F.coalesce("raw_write", WRITE_ID).alias("raw_write")
    return stored.select(*(raw_write if c == "raw_write" else c for c in RANGE), WRITE_ID)


def live_index(
    spark: SparkSession, root: str, *, of_writes: DataFrame | None = None
) -> DataFrame:
    """Entries (RANGE columns) whose raw directory is live, each once.

    ``of_writes`` (write_id, topic) restricts them to entries recorded by these writes.
    """
    entries = _entries(spark, root)
    if of_writes is not None:
        entries = entries.join(F.broadcast(of_writes.distinct()), [WRITE_ID, "topic"], "left_semi")
    live = entries.join(_raw_directories(spark, root), [*HOUR, "raw_write"], "left_semi")
    # An entry that was recorded twice counts once.
    return live.select(*RANGE).distinct()


def uncovered_directories(spark: SparkSession, root: str) -> list:
    """(topic, hour, raw_write) of live raw directories that the index has no entry of."""
    directories = _raw_directories(spark, root)
    entries = _entries(spark, root)
    if entries is not None:
        covered = entries.select(*HOUR, "raw_write").distinct()
        directories = directories.join(covered, [*HOUR, "raw_write"], "left_anti")
    return directories.collect()


def log_ranges(spark: SparkSession, root: str) -> DataFrame:
    """The ranges (RANGE columns) of all live raw rows.

    From the index where it has them; other directories are read, and nothing else.
    """
    raw = stored_rows(spark, root, RAW_ZONE)
    if raw is None:
        return spark.createDataFrame([], OFFSETS_ZONE.schema).select(*RANGE)
    missing = uncovered_directories(spark, root)
    read = ranges_of(in_directories(raw, missing), F.col(WRITE_ID)) if missing else None
    if _entries(spark, root) is None:
        return read
    known = live_index(spark, root)
    return known if read is None else known.unionByName(read)


def in_directories(raw: DataFrame, directories: list) -> DataFrame:
    """Raw rows of (topic, hour, raw_write) directories; only partition columns are compared."""
    names = [*HOUR, "raw_write"]
    schema = ", ".join(f"wanted_{n} {'string' if n in ('topic', 'raw_write') else 'int'}" for n in names)
    wanted = raw.sparkSession.createDataFrame([tuple(r[n] for n in names) for r in directories], schema)
    for name in ("year", "month", "day"):
        met = sorted({r[name] for r in directories})
        if len(met) <= 31:
            # Bare literals, so the scan skips other days before it is planned.
            raw = raw.where(F.col(name).isin(met))
    writes = sorted({r["raw_write"] for r in directories if r["raw_write"] is not None})
    if len(writes) <= 64 and all(r["raw_write"] is not None for r in directories):
        raw = raw.where(F.col(WRITE_ID).isin(writes))
    same = F.col(WRITE_ID).eqNullSafe(F.col("wanted_raw_write"))
    for name in HOUR:
        same &= F.col(name).eqNullSafe(F.col(f"wanted_{name}"))
    return raw.join(F.broadcast(wanted), same, "left_semi")
