"""Connected components of a graph given as links, by alternating star contractions.

A large star hangs every larger neighbour of a node on the node's smallest neighbour, a small
star does so with the smaller ones; in a logarithmic number of rounds only stars are left.
Every round is two joins with a table of minima: no node's neighbours meet in one task, the
minima are combined before the shuffle, and adaptive execution splits a hub's join key.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusloom.llm.shared import stored


def _round(links: DataFrame) -> DataFrame:
    both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    lowest = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("low"))
    large = (
        both.join(lowest, "a")
        .filter(F.col("b") > F.col("a"))
        .select(F.col("b").alias("a"), F.col("low").alias("b"))
        .distinct()
    )
    smallest = large.groupBy("a").agg(F.min("b").alias("low"))
    others = large.join(smallest, "a").filter(F.col("b") != F.col("low"))
    return others.select(F.col("b").alias("a"), F.col("low").alias("b")).unionByName(
        smallest.select("a", F.col("low").alias("b"))
    ).distinct()


def _mark(links: DataFrame) -> tuple:
    """Two sums that stay the same once the links do."""
    spread = F.xxhash64("a", "b")
    row = links.agg(F.count("*"), F.sum(spread % (1 << 31)), F.bit_xor(spread)).first()
    return tuple(row)


def components(links: DataFrame, name: str = "components") -> DataFrame:
    """(node, root) for every node of the links (a, b) but the roots, the smallest of each."""
    pairs = links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    current = stored(pairs.filter(F.col("a") != F.col("b")).distinct(), name)
    mark = _mark(current)
    while mark[0]:
        current = stored(_round(current), name)
        before, mark = mark, _mark(current)
        if before == mark:
            break
    return current.select(F.col("a").alias("node"), F.col("b").alias("root"))
