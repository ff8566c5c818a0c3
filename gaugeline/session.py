"""Session settings the engine relies on, and shared scratch space."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

from gaugeline.config import Settings

# Day and hour buckets are formatted in the session time zone; Parquet can only
# skip row groups on timestamps it stores as 64-bit integers.
RUNTIME_SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.parquet.outputTimestampType": "TIMESTAMP_MICROS",
}

ADAPTIVE_SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
}

# Recording the source line of every Column costs more calls to the JVM than the
# expressions themselves.
BUILD_SETTINGS = {"spark.python.sql.dataFrameDebugging.enabled": "false"}

ROCKSDB_PROVIDER = (
    "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
)


_scratch: list[str] = []


def build_session(
    app_name: str,
    *,
    settings: Settings | None = None,
    master: str | None = None,
    large_state: bool = False,
    extra: dict[str, str] | None = None,
) -> SparkSession:
    """A session for the jobs of this package.

    ``large_state`` moves window state out of the JVM heap. On a large cluster
    set ``batch_partitions`` to a few times the number of cores: few shuffle
    partitions suit a stream's small state, but would hold back a backfill.
    """
    settings = settings or Settings.from_env()
    split = settings.batch_partitions
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    options = {
        **ADAPTIVE_SETTINGS,
        **RUNTIME_SETTINGS,
        **BUILD_SETTINGS,
        "spark.sql.shuffle.partitions": str(settings.shuffle_partitions),
        **({"spark.sql.adaptive.coalescePartitions.initialPartitionNum": str(split)} if split else {}),
        **({"spark.sql.streaming.stateStore.providerClass": ROCKSDB_PROVIDER} if large_state else {}),
        **(extra or {}),
    }
    for key, value in options.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("WARN")
    return spark


def apply_runtime_settings(spark: SparkSession) -> SparkSession:
    """Bring a session made elsewhere to the settings results depend on."""
    for key, value in RUNTIME_SETTINGS.items():
        if spark.conf.get(key) != value:
            spark.conf.set(key, value)
    return spark


def scratch_dir(spark: SparkSession, label: str) -> str:
    """A new directory that every executor can reach, for ``clear_scratch`` to remove.

    It lies under ``spark.checkpoint.dir``. Where that is unset a temporary
    folder serves a local session, and a cluster session is refused.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if shared:
        made = f"{shared.rstrip('/')}/{label}-{uuid.uuid4().hex}"
    elif spark.conf.get("spark.master", "").startswith("local"):
        made = os.path.join(tempfile.mkdtemp(prefix="gaugeline-"), label)
    else:
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
    _scratch.append(made)
    return made


def clear_scratch(spark: SparkSession) -> None:
    """Remove all scratch directories handed out so far.

    Results are read from them, so this is for the end of a session."""
    while _scratch:
        path = spark._jvm.org.apache.hadoop.fs.Path(_scratch.pop())
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
