"""Connected components of a link table by alternating stars, all in DataFrames.

A link's larger end is moved to the smallest neighbour of its smaller end, and the
reverse, until nothing changes; then each node hangs on the least node that it
reaches. A hub is met only by group minima (combined before the shuffle) and by an
equi-join that adaptive execution may split, so no task ever gathers its links.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessel.llm.common import Shared


def _least(pairs: DataFrame) -> DataFrame:
    return pairs.groupBy("a").agg(F.min("b").alias("m"))


def _large_star(links: DataFrame) -> DataFrame:
    """links (a > b): each neighbour above a node goes to the node's least neighbour."""
    both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = _least(both).select("a", F.least("a", "m").alias("m"))
    up = both.where("b > a").join(least, "a")
    return up.select(F.col("b").alias("a"), F.col("m").alias("b")).where("a > b").distinct()


def _small_star(links: DataFrame) -> DataFrame:
    """links (a > b): a node and its smaller neighbours go to the least of them."""
    least = _least(links)
    moved = links.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return moved.unionByName(least.select("a", F.col("m").alias("b"))).where("a > b").distinct()


def components(links: DataFrame, shared: Shared) -> DataFrame:
    """(node, component) of all nodes that have a link; links: two long columns a, b.

    Self links and nulls are ignored; a table without links gives no rows. Rounds go on
    until the links are the same twice, which takes some log of the nodes.
    """
    now = shared.table(
        links.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    )
    seen = None
    while True:
        nxt = shared.table(_small_star(_large_star(now)))
        mark = nxt.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        shared.drop(now)
        now = nxt
        if mark == seen:
            break
        seen = mark
    roots = now.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    return now.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(roots)
