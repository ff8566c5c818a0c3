"""Writing the zones of the lake."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gaugeline.schemas import (
    CONSUMPTION_ZONE,
    CURATED_ZONE,
    OFFSETS_ZONE,
    RAW_ZONE,
    REJECTED_ZONE,
    WRITE_ID,
    Zone,
)
from gaugeline.sinks.files import delete_directories, files_of_write
from gaugeline.sources.lake import stored_rows
from gaugeline.sources.offsets import in_directories, ranges_of, uncovered_directories
from gaugeline.sources.snapshots import zone_path

# As many digits as the curated zone keeps of the same times.
JSON_TIMES = "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX"


def write_zone(
    rows: DataFrame, root: str, zone: Zone, *, write_id: str | None, rerun: bool = False
) -> None:
    """Add rows to a zone, under a directory named after this write.

    Repeating a write replaces its files in every partition that it touches again,
    and files of other writes are left alone. A repeated micro-batch holds the same
    rows and so touches the same partitions. A write that may hold other rows than
    its first try, such as a backfill, sets ``rerun``: partitions that only the first
    try touched are then emptied as well, after the new files are in place.

    Without ``write_id`` rows are appended in the plain layout, for lakes that
    have it already and for stores without directory replacement. A repeated
    write then stores its rows again; ``operators.decode.drop_replayed`` removes
    them on reading. One zone can only have one of the two layouts.
    """
    writer = rows.select(*zone.columns)
    partitions = zone.partitions
    if write_id is not None:
        writer = writer.withColumn(WRITE_ID, F.lit(write_id))
        partitions = (*partitions, WRITE_ID)
    writer = writer.write.format(zone.format).partitionBy(*partitions)
    if zone.format == "parquet":
        writer = writer.option("compression", "snappy")
    else:
        writer = writer.option("timestampFormat", JSON_TIMES)
    if write_id is None:
        writer = writer.mode("append")
    else:
        writer = writer.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    spark = rows.sparkSession
    before = files_of_write(spark, root, zone, write_id) if rerun and write_id else {}
    writer.save(zone_path(root, zone))
    if before:
        # New files have new names, so a directory with the old ones was not written.
        after = files_of_write(spark, root, zone, write_id)
        delete_directories(spark, (d for d, names in before.items() if after.get(d) == names))


def write_raw(
    rows: DataFrame, root: str, *, write_id: str | None, rerun: bool = False, hours: bool = False
) -> None:
    """All rows of a micro-batch share one ingestion hour, so every task writes one
    file and a shuffle would gain nothing. ``hours`` is for rows of many: they are gathered by
    hour, as else every task would write a file for each."""
    gathered = rows.hint("rebalance", *RAW_ZONE.partitions) if hours else rows
    write_zone(gathered, root, RAW_ZONE, write_id=write_id, rerun=rerun)


def write_offsets(rows: DataFrame, root: str, *, write_id: str | None, rerun: bool = False) -> None:
    """First and last offset of each log partition in each hour that a write adds to
    the raw zone, by which ``sources.tail.tail_of_zone`` finds the hours it needs."""
    ranges = ranges_of(rows, F.lit(write_id).cast("string"))
    write_zone(ranges.coalesce(1), root, OFFSETS_ZONE, write_id=write_id, rerun=rerun)


def record_offsets(spark: SparkSession, root: str) -> int:
    """Record the ranges of raw writes that the index lacks; returns their number.

    For a zone that is continued from before there was an index. Rows in the plain layout
    have no write to name, so their ranges are read again each time.
    """
    raw = stored_rows(spark, root, RAW_ZONE)
    missing = uncovered_directories(spark, root)
    if raw is None or not missing:
        return 0
    found = ranges_of(in_directories(raw, missing), F.col(WRITE_ID))
    write_zone(found.coalesce(1), root, OFFSETS_ZONE, write_id=f"recorded-{uuid.uuid4().hex}")
    return len({r["raw_write"] for r in missing})


def write_curated(rows: DataFrame, root: str, *, write_id: str | None, rerun: bool = False) -> None:
    """Rows are gathered by partition to keep the file count low.

    ``rebalance`` sizes the result adaptively: small partitions share a task and
    a sensor or day that holds much of the data is split over several.
    """
    gathered = rows.hint("rebalance", *CURATED_ZONE.partitions)
    write_zone(gathered, root, CURATED_ZONE, write_id=write_id, rerun=rerun)


def write_rejected(rows: DataFrame, root: str, *, write_id: str | None, rerun: bool = False) -> None:
    """Refused messages, gathered by reason and day as the curated ones are."""
    gathered = rows.hint("rebalance", *REJECTED_ZONE.partitions)
    write_zone(gathered, root, REJECTED_ZONE, write_id=write_id, rerun=rerun)


def write_consumption(
    rows: DataFrame, root: str, *, write_id: str | None, batch_id: int, rerun: bool = False
) -> None:
    """Stateful batches run without adaptive execution, so this gathers by a
    plain shuffle. A sensor and month hold at most some 9,000 five-minute
    windows, however many readings went into them."""
    gathered = rows.withColumn("batch_id", F.lit(batch_id).cast("bigint")).repartition(
        *CONSUMPTION_ZONE.partitions
    )
    write_zone(gathered, root, CONSUMPTION_ZONE, write_id=write_id, rerun=rerun)
