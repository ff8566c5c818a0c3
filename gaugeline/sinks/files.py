"""Directories of a zone's writes, on whatever file system the lake is."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import SparkSession

from gaugeline.schemas import WRITE_ID, Zone
from gaugeline.sources.snapshots import file_system, zone_path


def files_of_write(spark: SparkSession, root: str, zone: Zone, write_id: str) -> dict[str, set[str]]:
    """Directory -> names of its files, for every partition one write has touched."""
    levels = "/*" * len(zone.partitions)
    system, pattern = file_system(spark, f"{zone_path(root, zone)}{levels}/{WRITE_ID}={write_id}/*")
    found: dict[str, set[str]] = {}
    for status in system.globStatus(pattern) or ():
        path = status.getPath()
        found.setdefault(path.getParent().toString(), set()).add(path.getName())
    return found


def delete_directories(spark: SparkSession, directories: Iterable[str]) -> None:
    for directory in directories:
        system, path = file_system(spark, directory)
        system.delete(path, True)
