"""Closed partitions of the zones in one write each.

Every micro-batch leaves a directory in each partition it touches. Once a partition is
over they are rewritten together: curated and rejected rows without messages that were
stored twice, window rows by their latest revision, raw rows as they are. A manifest
makes the rewritten files live and the old ones dead in one step, so a reader sees each row
once at any time, also after a run that was cut off anywhere.
"""

from __future__ import annotations

import uuid
from collections import defaultdict
from collections.abc import Callable
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gaugeline.operators.decode import drop_replayed
from gaugeline.operators.windows import latest_revision
from gaugeline.schemas import (
    CONSUMPTION_ZONE,
    CURATED_ZONE,
    OFFSETS_ZONE,
    RAW_ZONE,
    REJECTED_ZONE,
    WRITE_ID,
    Zone,
)
from gaugeline.sinks.files import delete_directories
from gaugeline.sinks.zones import record_offsets, write_zone
from gaugeline.sources.lake import stored_rows
from gaugeline.sources.offsets import live_index
from gaugeline.sources.snapshots import (
    PENDING,
    Directory,
    Manifest,
    commit,
    current_manifest,
    directory_rows,
    file_system,
    live_directories,
    replaced_path,
    zone_path,
)


def closed_before(zone: Zone, directory: Directory, before: date) -> bool:
    """Whether a partition holds days before ``before`` only; one without a date never does."""
    parts = dict(zip(zone.partitions, directory.values))
    if "year" not in parts or parts["year"] is None:
        return False
    year, month = int(parts["year"]), int(parts["month"] or 1)
    if "day" in parts:
        return date(year, month, int(parts["day"] or 1)) < before
    following = date(year + month // 12, month % 12 + 1, 1) if (year, month) < (9999, 12) else date.max
    return following <= before


def _settled(rows: DataFrame) -> DataFrame:
    return latest_revision(rows).select(*CONSUMPTION_ZONE.columns)


REWRITES: dict[str, Callable[[DataFrame], DataFrame]] = {
    CURATED_ZONE.name: drop_replayed,
    REJECTED_ZONE.name: drop_replayed,
    CONSUMPTION_ZONE.name: _settled,
    RAW_ZONE.name: lambda rows: rows,
}


def compact_zone(
    spark: SparkSession, root: str, zone: Zone, before: date, *, clean: bool = True
) -> int:
    """Rewrite partitions of days before ``before`` that hold several writes.

    Returns the number of directories replaced. Days still written to must not be
    given. The zone is listed once, and the rewrite is one job whose tasks are sized
    by ``rebalance``. With ``clean=False`` the dead directories stay for
    readers that run already; ``clean_zone`` deletes them later.
    """
    start = current_manifest(spark, root, zone)
    by_partition: dict[tuple, list[Directory]] = defaultdict(list)
    for directory in live_directories(spark, root, zone):
        if directory.write_id is not None and closed_before(zone, directory, before):
            by_partition[directory.values].append(directory)
    old = [d for found in by_partition.values() if len(found) > 1 for d in found]
    if old:
        start = start or _first_version(spark, root, zone)
        write_id = f"{PENDING}{uuid.uuid4().hex}"
        rows = _rows_of(spark, root, zone, old).hint("rebalance", *zone.partitions)
        write_zone(REWRITES[zone.name](rows), root, zone, write_id=write_id)
        _commit_replacing(spark, root, zone, start, write_id, old)
        if zone is RAW_ZONE:
            record_offsets(spark, root)
    if clean:
        clean_zone(spark, root, zone)
    return len(old)


def compact_curated(spark: SparkSession, root: str, before: date) -> int:
    return compact_zone(spark, root, CURATED_ZONE, before)


def compact_offsets(spark: SparkSession, root: str, *, clean: bool = True) -> int:
    """The offset index of the raw zone in one write, without entries of dead raw writes.

    It gets a small file with every micro-batch and is read as a whole, so this is worth
    doing for open days too; writes that are added meanwhile stay beside it.
    """
    start = current_manifest(spark, root, OFFSETS_ZONE)
    old = [d for d in live_directories(spark, root, OFFSETS_ZONE) if d.write_id is not None]
    if len({d.write_id for d in old}) > 1:
        start = start or _first_version(spark, root, OFFSETS_ZONE)
        write_id = f"{PENDING}{uuid.uuid4().hex}"
        named = directory_rows(spark, OFFSETS_ZONE, old).select(WRITE_ID, "topic")
        entries = live_index(spark, root, of_writes=named)
        gathered = entries.repartition("topic")
        write_zone(gathered, root, OFFSETS_ZONE, write_id=write_id)
        _commit_replacing(spark, root, OFFSETS_ZONE, start, write_id, old)
    else:
        old = []
    if clean:
        clean_zone(spark, root, OFFSETS_ZONE)
    return len(old)


def clean_zone(spark: SparkSession, root: str, zone: Zone) -> int:
    """Delete the directories that committed compactions have replaced."""
    manifest = current_manifest(spark, root, zone)
    if manifest is None or not manifest.open:
        return 0
    dead: list[str] = []
    for write_id in manifest.open:
        dead += [r["path"] for r in spark.read.parquet(replaced_path(root, zone, write_id)).collect()]
    delete_directories(spark, dead)
    commit(spark, root, zone, Manifest(manifest.version + 1, manifest.committed))
    return len(dead)


def drop_uncommitted(spark: SparkSession, root: str, zone: Zone) -> int:
    """Delete files of compactions that were cut off before their commit. Not while one runs."""
    manifest = current_manifest(spark, root, zone)
    if manifest is None:
        return 0
    depth = "/*=*" * len(zone.partitions)
    system, pattern = file_system(spark, f"{zone_path(root, zone)}{depth}/{WRITE_ID}={PENDING}*")
    paths = [s.getPath() for s in system.globStatus(pattern) or ()]
    left = [str(p) for p in paths if p.getName().split("=", 1)[1] not in manifest.committed]
    delete_directories(spark, left)
    return len(left)


def _first_version(spark: SparkSession, root: str, zone: Zone) -> Manifest:
    """Committed before the first pending file is written, so that no reader takes it."""
    commit(spark, root, zone, Manifest(0))
    return Manifest(0)


def _rows_of(spark: SparkSession, root: str, zone: Zone, directories: list[Directory]) -> DataFrame:
    """The rows of some directories, found by partition columns alone."""
    keys = list(zone.partitions)
    rows = stored_rows(spark, root, zone)
    assert rows is not None
    for at, name in enumerate(zone.partitions):
        if name in ("year", "month"):
            met = sorted({int(d.values[at]) for d in directories if d.values[at] is not None})
            # Bare literals, so the scan skips other years before it is planned.
            rows = rows.where(F.col(name).isin(met)) if len(met) <= 24 else rows
    named = directory_rows(spark, zone, directories).select(*keys).distinct()
    return rows.join(F.broadcast(named), keys, "left_semi").select(*zone.columns)


def _commit_replacing(
    spark: SparkSession, root: str, zone: Zone, start: Manifest, write_id: str, old: list[Directory]
) -> None:
    paths = spark.createDataFrame([(*d.values, d.write_id, d.path) for d in old], _path_schema(zone))
    types = {f.name: f.dataType for f in zone.stored_schema.fields}
    typed = [F.col(n).cast(types[n]).alias(n) for n in (*zone.partitions, WRITE_ID)]
    paths.select(*typed, "path").coalesce(1).write.parquet(replaced_path(root, zone, write_id))
    after = Manifest(start.version + 1, (*start.committed, write_id), (*start.open, write_id))
    commit(spark, root, zone, after)


def _path_schema(zone: Zone) -> str:
    return ", ".join(f"`{n}` string" for n in (*zone.partitions, WRITE_ID, "path"))
