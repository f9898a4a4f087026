"""Connected components of a graph that is never held in one place."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martloom.storage import store


def _towards_least(edges: DataFrame, both_ways: bool) -> DataFrame:
    """Point the neighbours of each node at the least of them and it.

    Both ways: the greater neighbours of a node move. Otherwise the node and its lesser neighbours do.
    The least is an aggregate and the move a join, so a node with many neighbours is not gathered.
    """
    pairs = edges.filter("a <> b")
    if both_ways:
        pairs = pairs.unionByName(pairs.select(F.col("b").alias("a"), F.col("a").alias("b")))
    else:
        pairs = pairs.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    pairs = store(pairs.distinct(), "neighbours")
    least = pairs.groupBy("a").agg(F.min("b").alias("least"))
    least = store(least.select("a", F.least("a", "least").alias("least")), "least_neighbours")
    moved = pairs.join(least, "a")
    if both_ways:
        return moved.filter("b > a").select(F.col("b").alias("a"), F.col("least").alias("b"))
    own = least.select("a", F.col("least").alias("b"))
    return moved.select(F.col("b").alias("a"), F.col("least").alias("b")).unionByName(own)


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of `edges` (a, b): root is the least node that can be reached.

    Alternates two steps that turn each component into a star about its least node; the number of
    rounds grows with the logarithm of its diameter. Rows are stored between rounds.
    """
    current = store(edges.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges")
    seen = None
    while True:
        large = _towards_least(current, both_ways=True)
        small = _towards_least(large, both_ways=False)
        current = store(small.filter("a <> b").distinct(), "stars")
        state = current.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if state == seen:
            break
        seen = state
    roots = current.select(F.col("b").alias("node")).distinct().select("node", F.col("node").alias("root"))
    return current.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(roots)
