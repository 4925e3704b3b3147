"""Connected components of a table of links, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tamiz.llm.shared import materialise


def connected(links: DataFrame) -> DataFrame:
    """``links``: (a, b). Returns (node, label): for each node of a link, the smallest node reachable.

    Each round is two aggregations and two joins; the number of rounds grows with the logarithm of the
    components' width, and each round's links are written to the shared folder. Links between equal
    nodes and null ends say nothing; no links give no rows.
    """
    edges = links.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    edges = materialise(edges, "edges")
    state = _state(edges)
    while state[0]:
        both = edges.union(edges.select("b", "a"))
        # Written before the join, so that both its sides are plain exchanges, of which Spark splits hot ones.
        low = materialise(both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m")), "low")
        large = materialise(both.join(low, "a").filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct(), "large")
        low = materialise(large.groupBy("a").agg(F.min("b").alias("m")), "low")
        small = large.join(low, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).filter("a <> b").union(low.select("a", F.col("m").alias("b")))
        edges = materialise(small.distinct(), "edges")
        after = _state(edges)
        if after == state:
            break
        state = after
    return edges.select(F.col("a").alias("node"), F.col("b").alias("label")).union(edges.select(F.col("b").alias("node"), F.col("b").alias("label")).distinct())


def _state(edges: DataFrame) -> tuple:
    """A digest of the links: their number and sums of two hashes."""
    hashed = (F.shiftright(F.xxhash64("a", "b"), 24), F.shiftright(F.xxhash64("b", "a"), 24))
    return tuple(edges.agg(F.count("*"), *(F.sum(h) for h in hashed)).first())
