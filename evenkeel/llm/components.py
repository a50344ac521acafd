"""Connected components of a table of edges, by rounds of joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from evenkeel.llm.common import stored


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of ``edges`` (a, b): root is the least node it can reach.

    In each round a node hands the least of its neighbours and itself to its larger
    neighbours, then to its smaller ones, until every node hangs on its root; the number
    of rounds grows with the logarithm of the longest path. Each round is stored. A node
    with many neighbours is one row after partial aggregation.
    """
    pairs = stored(_distinct(edges.select("a", "b")), "edges")
    while True:
        both = pairs.unionAll(pairs.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        # Larger neighbours of each node go to the least one around it.
        large = both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = _distinct(large)
        down = large.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        least = down.groupBy("a").agg(F.min("b").alias("m"))
        small = down.join(least, "a").select(F.when(F.col("b") == F.col("m"), F.col("a")).otherwise(F.col("b")).alias("a"), F.col("m").alias("b"))
        after = stored(_distinct(small), "edges")
        # A star forest: each node has one root, and no root hangs on another.
        open_ends = after.groupBy("a").agg(F.count("*").alias("n")).where("n > 1").select("a")
        roots = after.select(F.col("b").alias("a")).distinct().join(after.select("a").distinct(), "a", "left_semi")
        if open_ends.unionAll(roots).isEmpty():
            break
        pairs = after
    hung = after.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return hung.unionAll(after.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())


def _distinct(pairs: DataFrame) -> DataFrame:
    return pairs.where("a <> b").distinct()
