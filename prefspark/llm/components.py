"""Connected components of a graph given as a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from prefspark.llm.common import drop_written, written


def _state(links: DataFrame) -> tuple:
    return tuple(links.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())


def _large_star(links: DataFrame) -> DataFrame:
    """Every node's larger neighbours are linked to its smallest neighbour or itself."""
    both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min("b").alias("m"))
    joined = both.where("b > a").join(least, "a")
    return joined.select(F.col("b").alias("a"), F.least("a", "m").alias("b")).distinct()


def _small_star(links: DataFrame) -> DataFrame:
    """Every node's smaller neighbours, and the node, are linked to the smallest of them."""
    down = links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = down.groupBy("a").agg(F.min("b").alias("m"))
    joined = down.join(least, "a")
    moved = joined.select(F.col("b").alias("a"), F.col("m").alias("b")).unionByName(joined.select("a", F.col("m").alias("b")))
    return moved.where("a <> b").distinct()


def components(links: DataFrame) -> DataFrame:
    """(node, label) for every node of the links (a, b): its component's smallest node.

    Large and small stars in turn, which keep components as they are and end in one star for each, in a
    number of rounds that grows with the logarithm of the nodes. A round is a few shuffles of two numbers
    per link; stars are made by a minimum per node, combined before the shuffle, and by joins that
    adaptive execution splits at hot nodes. No component is ever brought together.
    """
    links = written(links.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "links")
    state = _state(links)
    while state[0]:
        after = written(_small_star(_large_star(links)), "links")
        drop_written(links)
        links, before, state = after, state, _state(after)
        if state == before:
            break
    stars = links.select(F.col("a").alias("node"), F.col("b").alias("label"))
    return stars.unionByName(stars.select(F.col("label").alias("node"), "label").distinct())
