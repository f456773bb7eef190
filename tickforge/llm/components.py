"""Connected components of a link table, by alternating star contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickforge.llm.common import stored


def components(links: DataFrame, low: str = "a", high: str = "b") -> DataFrame:
    """(node, root) for every node with a link; the root is the smallest node of its component.

    Every round first hangs larger neighbours on a node's smallest neighbour, then the smaller
    ones.  Links shrink to stars in a logarithmic number of rounds.  A hub's neighbours are
    only reduced to their minimum, so no task holds a hub's list.  Each round is written to
    the shared folder.
    """
    links = stored(_directed(links.select(F.col(low).alias("u"), F.col(high).alias("v"))), "links")
    state = _state(links)
    while True:
        both = links.union(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.join(least, "u").filter("v > u").select(F.col("v"), F.col("m"))
        large = _directed(large.select(F.col("m").alias("u"), F.col("v")))
        # Now v hangs on several smaller u: keep the smallest, hang the others on it.
        least = large.groupBy("v").agg(F.min("u").alias("m"))
        small = large.join(least, "v").select(F.col("m").alias("u"), F.explode(F.array("u", "v")).alias("v"))
        links = stored(_directed(small), "links")
        new = _state(links)
        if new == state:
            return links.select(F.col("v").alias("node"), F.col("u").alias("root")).union(
                links.select(F.col("u").alias("node"), F.col("u").alias("root")).distinct())
        state = new


def _directed(links: DataFrame) -> DataFrame:
    return links.select(F.least("u", "v").alias("u"), F.greatest("u", "v").alias("v")).filter("u < v").distinct()


def _state(links: DataFrame) -> tuple:
    """Count and order-free checksum of the links; equal when a round changed nothing."""
    return tuple(links.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())
