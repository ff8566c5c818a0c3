"""Which offsets of the log are there: merged ranges, gaps and overlaps.

A log partition may hold a third of all rows, so nothing is ordered as one group that
grows with them: offsets and ranges are merged in blocks of the log first, and only what is
left of each block, one stretch of a log without gaps, is merged across blocks.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

LOG = ("topic", "kafka_partition")
BLOCK = 1_000_000


def offset_stretches(rows: DataFrame, *, block: int = BLOCK) -> DataFrame:
    """(topic, kafka_partition, first_offset, last_offset) of stretches without a gap.

    Of raw, curated or rejected rows; a message that is stored twice counts once.
    """
    once = rows.select(*LOG, "kafka_offset").where(F.col("kafka_offset").isNotNull()).distinct()
    blocks = once.withColumn("block", F.floor(F.col("kafka_offset") / block))
    order = Window.partitionBy(*LOG, "block").orderBy("kafka_offset")
    stretch = (F.col("kafka_offset") - F.row_number().over(order)).alias("stretch")
    parts = (
        blocks.select(*LOG, "block", "kafka_offset", stretch)
        .groupBy(*LOG, "block", "stretch")
        .agg(F.min("kafka_offset").alias("first_offset"), F.max("kafka_offset").alias("last_offset"))
    )
    return merged_ranges(parts, block=block)


def _merged(ranges: DataFrame, *keys: str) -> DataFrame:
    """Ranges that overlap or touch as one, within groups of the keys."""
    order = Window.partitionBy(*keys).orderBy("first_offset", "last_offset")
    before = F.max("last_offset").over(order.rowsBetween(Window.unboundedPreceding, -1))
    opens = F.coalesce(F.col("first_offset") > before + 1, F.lit(True)).cast("int")
    island = F.sum("opens").over(order.rowsBetween(Window.unboundedPreceding, 0))
    return (
        ranges.withColumn("opens", opens)
        .withColumn("island", island)
        .groupBy(*keys, "island")
        .agg(F.min("first_offset").alias("first_offset"), F.max("last_offset").alias("last_offset"))
        .drop("island")
    )


def merged_ranges(ranges: DataFrame, *, block: int = BLOCK) -> DataFrame:
    """The fewest ranges that cover the same offsets of each log partition."""
    named = ranges.select(
        *LOG, "first_offset", "last_offset", F.floor(F.col("first_offset") / block).alias("block")
    ).where("first_offset <= last_offset")
    return _merged(_merged(named, *LOG, "block"), *LOG).select(*LOG, "first_offset", "last_offset")


def gaps(merged: DataFrame) -> DataFrame:
    """Offsets between merged ranges that none of them covers, as ranges."""
    order = Window.partitionBy(*LOG).orderBy("first_offset")
    following = F.lead("first_offset").over(order)
    return (
        merged.select(
            *LOG,
            (F.col("last_offset") + 1).alias("first_offset"),
            (following - 1).alias("last_offset"),
        )
        .where("first_offset <= last_offset")
    )


def overlaps(ranges: DataFrame, *, block: int = BLOCK) -> DataFrame:
    """Stretches of offsets that several ranges cover, with the number of them.

    Neighbouring stretches have different numbers. Each range opens at its first offset and
    closes after its last; the running number of open ones is summed up in blocks, each of
    which starts from the total of the blocks before it.
    """
    real = ranges.where("first_offset <= last_offset")
    edges = real.select(
        *LOG,
        F.explode(
            F.array(
                F.struct(F.col("first_offset").alias("at"), F.lit(1).alias("change")),
                F.struct((F.col("last_offset") + 1).alias("at"), F.lit(-1).alias("change")),
            )
        ).alias("edge"),
    )
    changes = (
        edges.groupBy(*LOG, F.col("edge.at").alias("at"))
        .agg(F.sum("edge.change").alias("change"))
        .where("change <> 0")
        .withColumn("block", F.floor(F.col("at") / block))
    )
    before = Window.partitionBy(*LOG).orderBy("block")
    totals = changes.groupBy(*LOG, "block").agg(
        F.sum("change").alias("total"), F.min("at").alias("begin")
    )
    totals = totals.select(
        *LOG,
        "block",
        F.coalesce(F.sum("total").over(before.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("open"),
        F.lead("begin").over(before).alias("next_block"),
    )
    within = Window.partitionBy(*LOG, "block").orderBy("at")
    counted = changes.join(totals, [*LOG, "block"]).select(
        *LOG,
        F.col("at").alias("first_offset"),
        (F.coalesce(F.lead("at").over(within), "next_block") - 1).alias("last_offset"),
        (F.col("open") + F.sum("change").over(within)).alias("times"),
    )
    return counted.where("times > 1")
