"""Bounded looks at a message log: its last offsets, and its first rows."""

from __future__ import annotations

from functools import reduce
from operator import and_, or_

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gaugeline.functions.payloads import sorted_keys
from gaugeline.schemas import RAW_ZONE
from gaugeline.sources.lake import read_raw
from gaugeline.sources.offsets import log_ranges

LOOKBACK = 100
MAX_PEEK = 10

# Ways to apply the end offsets, by their number (some 50 bytes each): literals in
# the filter, a broadcast of the fetched rows (5 MB at most), or a shuffled join.
MAX_LITERAL_ENDS = 64
MAX_BROADCAST_ENDS = 100_000

_LOG = ["topic", "kafka_partition"]


def tail(
    raw: DataFrame,
    lookback: int = LOOKBACK,
    *,
    max_literal_ends: int = MAX_LITERAL_ENDS,
    max_broadcast_ends: int = MAX_BROADCAST_ENDS,
) -> DataFrame:
    """Rows among the last ``lookback`` offsets of every topic partition.

    A log that grows meanwhile gives no more: both passes end at the offsets that
    the first one found.

    The first pass finds the end offsets: a hash aggregate over three columns
    with one row per log partition. With those as literals the second pass is a
    scan with a pushed-down range filter, so Parquet skips every row group that
    ends before the tail, and no message is shuffled. Beyond a broadcast's bound
    the ends are joined, and adaptive execution splits a log partition that
    holds much of the data.
    """
    ends = raw.groupBy(*_LOG).agg(F.max("kafka_offset").alias("last_offset"))
    fetched = ends.take(max_broadcast_ends + 1)
    if len(fetched) <= max_literal_ends:
        in_tail = [
            (F.col("topic") == topic)
            & (F.col("kafka_partition") == partition)
            & F.col("kafka_offset").between(last_offset - lookback + 1, last_offset)
            for topic, partition, last_offset in fetched
        ]
        return raw.where(reduce(or_, in_tail, F.lit(False)))
    if len(fetched) <= max_broadcast_ends:
        ends = F.broadcast(raw.sparkSession.createDataFrame(fetched, ends.schema))
    return (
        raw.join(ends, _LOG)
        .where(
            F.col("kafka_offset").between(
                F.col("last_offset") - (lookback - 1), F.col("last_offset")
            )
        )
        .select(*raw.columns)
    )


def tail_of_zone(
    spark: SparkSession,
    root: str,
    lookback: int = LOOKBACK,
    *,
    max_literal_ends: int = MAX_LITERAL_ENDS,
    max_broadcast_ends: int = MAX_BROADCAST_ENDS,
) -> DataFrame:
    """``tail`` of a stored raw zone, read from the hours that hold it alone.

    The recorded ranges give the ends of the log and the hours that reach into the tail;
    those are some few for each log partition, whatever the age of the lake. Writes whose
    ranges were never recorded are read for them, see ``sources.offsets``, so any zone
    gives the same as ``tail``.
    """
    raw = read_raw(spark, root)
    ranges = log_ranges(spark, root)
    ends = ranges.groupBy(*_LOG).agg(F.max("last_offset").alias("end"))
    hours = [name for name in RAW_ZONE.partitions if name != "source"]
    needed = (
        ranges.join(ends, _LOG)
        .where(F.col("last_offset") > F.col("end") - lookback)
        .groupBy(*hours, "kafka_partition")
        .agg(F.max("end").alias("end"))
    )
    fetched = needed.take(max_broadcast_ends + 1)
    if len(fetched) <= max_literal_ends:
        inside = [
            reduce(and_, [F.col(name) == row[name] for name in (*hours, "kafka_partition")])
            & F.col("kafka_offset").between(row["end"] - lookback + 1, row["end"])
            for row in fetched
        ]
        return raw.where(reduce(or_, inside, F.lit(False)))
    if len(fetched) <= max_broadcast_ends:
        needed = F.broadcast(spark.createDataFrame(fetched, needed.schema))
    return (
        raw.join(needed, [*hours, "kafka_partition"])
        .where(F.col("kafka_offset").between(F.col("end") - (lookback - 1), F.col("end")))
        .select(*raw.columns)
    )


def peek(raw: DataFrame, max_messages: int = MAX_PEEK, *, ordered: bool = False) -> DataFrame:
    """The first messages, with the keys of each value in order.

    As in a log scan, which messages come first is up to the source and only as
    many files are opened as needed. ``ordered`` takes the first by partition
    and offset, at the price of a full scan.
    """
    if ordered:
        raw = raw.orderBy("kafka_partition", "kafka_offset")
    return raw.limit(max_messages).select(
        F.col("kafka_partition").alias("partition"),
        F.col("kafka_offset").alias("offset"),
        F.col("message_key").alias("key"),
        sorted_keys(F.col("json_payload")).alias("value"),
    )
