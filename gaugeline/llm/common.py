"""What the operators share: tables, scratch tables, Arrow batches, row ids."""

from __future__ import annotations

import os
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

import gaugeline
from gaugeline.session import scratch_dir

PACKAGE_ROOT = os.path.dirname(os.path.dirname(os.path.abspath(gaugeline.__file__)))

# Rows in one Arrow batch of texts: a batch of long documents stays small.
TEXT_ROWS = 256

# Bounds of what is broadcast or fetched to the driver, in rows.
BROADCAST_ROWS = 200_000


def table(spark: SparkSession, directory: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{directory.rstrip('/')}/{name}.parquet")


def column(name: str) -> Column:
    """A column by its exact name, also when that has dots or spaces."""
    return F.col("`" + name.replace("`", "``") + "`")


def fresh_name(frame: DataFrame, name: str) -> str:
    """A column name the frame does not have."""
    taken = {c.lower() for c in frame.columns}
    while name.lower() in taken:
        name = f"{name}_"
    return name


def saved(frame: DataFrame, label: str) -> DataFrame:
    """The frame written to shared scratch space and read back.

    Cuts the lineage: Python work before it is done once, and lost executors
    don't undo it.
    """
    spark = frame.sparkSession
    path = scratch_dir(spark, label)
    frame.write.parquet(path)
    return spark.read.schema(frame.schema).parquet(path)


def map_arrow(
    frame: DataFrame,
    work: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]],
    schema: str,
    rows: int = TEXT_ROWS,
) -> DataFrame:
    """``mapInArrow`` with at most ``rows`` rows in a batch handed to Python."""

    names = frame.columns

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, rows):
                yield batch.slice(start, rows).rename_columns(names)

    spark = frame.sparkSession
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(rows))
    share_package(spark)
    # Passed by position, so names may be anything, dots included.
    plain = frame.toDF(*(f"c{i}" for i in range(len(names))))
    return plain.mapInArrow(lambda batches: work(cut(batches)), schema)


def share_package(spark: SparkSession) -> None:
    """Let Python workers import this package from where the driver has it.

    A cluster has it installed, or shipped with ``--py-files``; this serves
    sessions that were started without it on their path.
    """
    env = spark.sparkContext.environment
    if PACKAGE_ROOT not in env.get("PYTHONPATH", "").split(os.pathsep):
        env["PYTHONPATH"] = os.pathsep.join(filter(None, [PACKAGE_ROOT, env.get("PYTHONPATH")]))


def row_numbers() -> Iterator[int]:
    """Numbers no other task of the job gives out: task in the high bits."""
    base = TaskContext.get().partitionId() << 40
    count = 0
    while True:
        yield base + count
        count += 1


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))
