"""Comparing two tables of messages by digests of ranges of the log.

Counts and hash sums of large ranges of offsets are compared first, and only ranges that
differ are looked at again in smaller steps, down to single messages. Where the tables
agree, as they do but for the odd lost or repeated write, two aggregates of some few rows
are all there is.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gaugeline.operators.coverage import LOG

# Offsets in a range, step by step. A step's ranges divide into those of the next.
STEPS = (1_000_000, 10_000, 1)
# Ranges that are broadcast to the next step; more are joined.
BROADCAST_RANGES = 100_000


def digests(messages: DataFrame, content: Column, step: int) -> DataFrame:
    """(topic, kafka_partition, range, messages, digest): of each range of ``step`` offsets.

    A digest is the sum of hashes, so it does not depend on order and is combined before the
    shuffle. It differs also where a message is there twice.
    """
    mark = F.xxhash64(*LOG, "kafka_offset", content)
    return messages.groupBy(*LOG, F.floor(F.col("kafka_offset") / step).alias("range")).agg(
        F.count("*").alias("messages"), F.sum(mark.cast("decimal(38,0)")).alias("digest")
    )


def _differing(one: DataFrame, other: DataFrame, step: int) -> DataFrame:
    sides = [
        digests(side, F.col("content"), step).select(
            *LOG, "range", F.col("messages").alias(f"{name}_messages"), F.col("digest").alias(f"{name}_digest")
        )
        for name, side in (("left", one), ("right", other))
    ]
    return sides[0].join(sides[1], [*LOG, "range"], "full").where(
        "NOT (left_digest <=> right_digest AND left_messages <=> right_messages)"
    )


def differences(
    left: DataFrame,
    right: DataFrame,
    *,
    left_content: Sequence[str] = (),
    right_content: Sequence[str] = (),
    steps: Sequence[int] = STEPS,
    broadcast_ranges: int = BROADCAST_RANGES,
) -> DataFrame:
    """(topic, kafka_partition, kafka_offset, left_messages, right_messages) of messages that
    are not the same on both sides.

    The content columns, as many on either side, are compared as well; without any only
    the places in the log count.
    """
    sides = []
    for side, content in ((left, left_content), (right, right_content)):
        mark = F.xxhash64(*content) if content else F.lit(0).cast("bigint")
        sides.append(side.select(*LOG, "kafka_offset", mark.alias("content")))
    for step in steps[:-1]:
        found = _differing(*sides, step).select(*LOG, "range")
        fetched = found.take(broadcast_ranges + 1)
        if len(fetched) <= broadcast_ranges:
            found = F.broadcast(found.sparkSession.createDataFrame(fetched, found.schema))
        place = F.floor(F.col("kafka_offset") / step)
        sides = [
            side.withColumn("range", place).join(found, [*LOG, "range"], "left_semi").drop("range")
            for side in sides
        ]
    return _differing(*sides, steps[-1]).select(
        *LOG,
        (F.col("range") * steps[-1]).alias("kafka_offset"),
        F.coalesce("left_messages", F.lit(0)).alias("left_messages"),
        F.coalesce("right_messages", F.lit(0)).alias("right_messages"),
    )


def unaccounted(raw: DataFrame, curated: DataFrame, rejected: DataFrame, **how) -> DataFrame:
    """Messages of the raw zone that are not once in the curated or rejected zone, or the
    reverse. ``left_messages`` are those in raw, ``right_messages`` those in the others."""
    places = [rows.select(*LOG, "kafka_offset") for rows in (curated, rejected)]
    return differences(raw, places[0].unionByName(places[1]), **how)
