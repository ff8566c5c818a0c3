"""Connected components of a link table, by alternating stars.

Every round joins the links with the smallest neighbour of each node. A node of
many links is only ever a group of a combining aggregate or a side of a join that
adaptive execution may split, as the smallest neighbours are stored before they are
joined; nothing is collected. Tables in the shared folder cut the rounds from each
other, so lost executors cost one round.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gaugeline.llm.common import saved

MAX_ROUNDS = 60


def _both_ways(links: DataFrame) -> DataFrame:
    return links.select("a", "b").union(links.select(F.col("b").alias("a"), F.col("a").alias("b")))


def _large_star(links: DataFrame) -> DataFrame:
    """Larger neighbours of each node are linked to the smallest one, or to the node."""
    around = _both_ways(links)
    least = around.groupBy("a").agg(F.min("b").alias("low"))
    least = saved(least.select("a", F.least("a", "low").alias("low")), "least")
    return around.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("low").alias("b"))


def _small_star(links: DataFrame) -> DataFrame:
    """A node and its smaller neighbours are linked to the smallest of them."""
    down = links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = saved(down.groupBy("a").agg(F.min("b").alias("low")), "least")
    moved = down.join(least, "a").where("b <> low").select(F.col("b").alias("a"), F.col("low").alias("b"))
    return moved.union(least.select("a", F.col("low").alias("b")))


def connected_components(links: DataFrame, max_rounds: int = MAX_ROUNDS) -> DataFrame:
    """(node, root) for every node of links (a, b); root is the smallest node reached.

    Works on any ordered type. Loops and repeated links are allowed, links with a
    null end are not links. No links give no rows.
    """
    current = saved(links.where("a <> b").select("a", "b").distinct(), "links")
    mark = None
    for _ in range(max_rounds):
        stepped = _small_star(_large_star(current)).distinct()
        current = saved(stepped, "links")
        seen = current.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if tuple(seen) == mark:
            return current.select(F.col("a").alias("node"), F.col("b").alias("root")).union(
                current.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
            )
        mark = tuple(seen)
    raise RuntimeError(f"components did not settle in {max_rounds} rounds")
