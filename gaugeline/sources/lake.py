"""Reading the zones of the lake."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gaugeline.schemas import (
    CONSUMPTION_ZONE,
    CURATED_ZONE,
    RAW_ZONE,
    REJECTED_ZONE,
    WRITE_ID,
    Zone,
)
from gaugeline.sources.snapshots import current_manifest, live_rows, zone_path

CURATED_VIEW = "curated_readings"


def stored_rows(spark: SparkSession, root: str, zone: Zone) -> DataFrame | None:
    """The live rows of a zone with their write ids, None if it does not exist yet."""
    reader = spark.read.schema(zone.stored_schema).format(zone.format)
    if zone.format == "json":
        reader = reader.option("mode", "FAILFAST")
    while True:
        manifest = current_manifest(spark, root, zone)
        try:
            stored = reader.load(zone_path(root, zone))
        except AnalysisException as problem:
            if problem.getCondition() != "PATH_NOT_FOUND":
                raise
            return None
        # Files are listed by now. Under the same version none of them was missing yet.
        if manifest == current_manifest(spark, root, zone):
            return live_rows(stored, root, zone, manifest)


def read_zone(
    spark: SparkSession, root: str, zone: Zone, *, write_id: str | None = None
) -> DataFrame:
    """A zone, or what one write put there, with its declared schema.

    Partition columns keep their types. A zone that does not exist yet reads as
    an empty frame. Files that cannot be read, and lines of them that are damaged,
    are an error, they are never taken for missing data. Of a zone that is being
    compacted each row is there once, see ``sources.snapshots``.
    """
    stored = stored_rows(spark, root, zone)
    if stored is None:
        return spark.createDataFrame([], zone.schema)
    if write_id is not None:
        stored = stored.where(F.col(WRITE_ID) == write_id)
    return stored.select(*zone.columns)


def read_raw(spark: SparkSession, root: str) -> DataFrame:
    return read_zone(spark, root, RAW_ZONE)


def read_curated(spark: SparkSession, root: str) -> DataFrame:
    return read_zone(spark, root, CURATED_ZONE)


def read_consumption(spark: SparkSession, root: str) -> DataFrame:
    """All emitted revisions; ``operators.windows.latest_revision`` settles them."""
    return read_zone(spark, root, CONSUMPTION_ZONE)


def read_rejected(spark: SparkSession, root: str) -> DataFrame:
    return read_zone(spark, root, REJECTED_ZONE)


def register_curated_view(curated: DataFrame, name: str = CURATED_VIEW) -> DataFrame:
    curated.createOrReplaceTempView(name)
    return curated
