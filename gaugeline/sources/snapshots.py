"""Which writes of a zone are live, by a versioned manifest beside its files.

A compaction writes its files under a write id that no reader takes yet. Its commit is
one small file, the next version of the manifest: from then on readers take the new files, and
none of the directories they replace, whether those have been deleted yet or not. A
reader looks at one version only, so it sees every row once, before, during and after. Of
two compactions that start from one version the second fails at its commit.

Zones that were never compacted have no manifest, and nothing is read for them but that.
"""

from __future__ import annotations

import json
from dataclasses import dataclass
from functools import reduce
from operator import and_
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gaugeline.schemas import WRITE_ID, Zone

MANIFESTS = "_manifests"
# Writes that are live only once a manifest names them.
PENDING = "compacted-pending-"


class CommitConflict(RuntimeError):
    """Another compaction of the zone was committed meanwhile."""


@dataclass(frozen=True)
class Manifest:
    """``committed`` are all compactions that count, ``open`` those whose replaced
    directories may still be there."""

    version: int
    committed: tuple[str, ...] = ()
    open: tuple[str, ...] = ()


def zone_path(root: str, zone: Zone) -> str:
    return f"{str(root).rstrip('/')}/{zone.name}"


def manifest_path(root: str, zone: Zone) -> str:
    return f"{str(root).rstrip('/')}/{MANIFESTS}/{zone.name}"


def replaced_path(root: str, zone: Zone, write_id: str) -> str:
    """A table of the directories that a compaction replaces."""
    return f"{manifest_path(root, zone)}/replaced/{write_id}"


def file_system(spark: SparkSession, path: str):
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration()), hadoop_path


def current_manifest(spark: SparkSession, root: str, zone: Zone) -> Manifest | None:
    """The newest version, None for a zone without any."""
    system, pattern = file_system(spark, f"{manifest_path(root, zone)}/*.json")
    found = sorted((s.getPath().getName(), s.getPath()) for s in system.globStatus(pattern) or ())
    for name, path in reversed(found):
        stream = system.open(path)
        try:
            text = spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()
        # An empty one is being written: its commit has not happened yet.
        if text:
            listed = json.loads(text)
            return Manifest(int(name.split(".")[0]), tuple(listed["committed"]), tuple(listed["open"]))
    return None


def commit(spark: SparkSession, root: str, zone: Zone, manifest: Manifest) -> None:
    """Make a version the current one; there may not be any of its number yet."""
    name = f"{manifest_path(root, zone)}/{manifest.version:012d}.json"
    system, path = file_system(spark, name)
    if system.exists(path):
        raise CommitConflict(f"version {manifest.version} of {zone.name} is taken")
    text = json.dumps({"committed": manifest.committed, "open": manifest.open})
    try:
        stream = system.create(path, False)
    except Exception as problem:
        if "AlreadyExists" in str(problem) or "already exists" in str(problem):
            raise CommitConflict(f"version {manifest.version} of {zone.name} is taken") from None
        raise
    try:
        stream.write(bytearray(text.encode()))
    finally:
        stream.close()


def live_rows(stored: DataFrame, root: str, zone: Zone, manifest: Manifest | None) -> DataFrame:
    """Rows, with their write id, of the writes that count in a version."""
    if manifest is None:
        return stored
    write = F.coalesce(F.col(WRITE_ID), F.lit(""))
    live = stored.where(~write.startswith(PENDING) | write.isin(list(manifest.committed)))
    keys = [*zone.partitions, WRITE_ID]
    for write_id in manifest.open:
        dead = stored.sparkSession.read.parquet(replaced_path(root, zone, write_id))
        dead = dead.select(*(F.col(k).alias(f"dead_{k}") for k in keys))
        same = reduce(and_, (F.col(k).eqNullSafe(F.col(f"dead_{k}")) for k in keys))
        live = live.join(dead, same, "left_anti")
    return live.select(*stored.columns)


@dataclass(frozen=True)
class Directory:
    """One write's directory in one partition; ``values`` are those of the partition columns
    as text, None for NULL, and ``files`` the names of its files."""

    path: str
    values: tuple[str | None, ...]
    write_id: str | None
    files: tuple[str, ...]


_NULL = "__HIVE_DEFAULT_PARTITION__"


def live_directories(spark: SparkSession, root: str, zone: Zone) -> list[Directory]:
    """The directories of live writes: one listing of the zone, no file is opened.

    Their number is kept low by compaction; of an uncompacted zone it grows with the
    number of writes.
    """
    manifest = current_manifest(spark, root, zone)
    depth = len(zone.partitions)
    found: dict[str, list[str]] = {}
    # Write directories, or the files themselves in the plain layout.
    for levels in (depth + 2, depth + 1):
        system, pattern = file_system(spark, zone_path(root, zone) + "/*=*" * (levels - 1) + "/*")
        for status in system.globStatus(pattern) or ():
            name = status.getPath().getName()
            if status.isFile() and name[0] not in "._":
                found.setdefault(status.getPath().getParent().toString(), []).append(name)
    directories = []
    for path, files in found.items():
        parts = dict(part.split("=", 1) for part in path.split("/") if "=" in part)
        values = tuple(None if parts[k] == _NULL else unquote(parts[k]) for k in zone.partitions)
        write_id = unquote(parts[WRITE_ID]) if WRITE_ID in parts else None
        directories.append(Directory(path, values, write_id, tuple(sorted(files))))
    if manifest is None:
        return directories
    dead: set[tuple] = set()
    for write_id in manifest.open:
        rows = spark.read.parquet(replaced_path(root, zone, write_id)).collect()
        dead |= {(*(None if r[k] is None else str(r[k]) for k in zone.partitions), r[WRITE_ID]) for r in rows}
    pending = [d for d in directories if (d.write_id or "").startswith(PENDING)]
    out = {d.path for d in pending if d.write_id not in manifest.committed}
    return [d for d in directories if d.path not in out and (*d.values, d.write_id) not in dead]


def directory_rows(spark: SparkSession, zone: Zone, directories: list[Directory]) -> DataFrame:
    """(partition columns, write_id) of directories, with the zone's types."""
    names = [*zone.partitions, WRITE_ID]
    texts = spark.createDataFrame(
        [(*d.values, d.write_id) for d in directories], ", ".join(f"`{n}` string" for n in names)
    )
    types = {f.name: f.dataType for f in zone.stored_schema.fields}
    return texts.select(*(F.col(n).cast(types[n]).alias(n) for n in names))
