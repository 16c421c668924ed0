"""Connected components of an edge list by alternating large-star and small-star steps, each step a written table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlane.sources.publish import store


def connected_components(edges: DataFrame) -> DataFrame:
    """``edges`` (a, b: long) to (node, root): the smallest node reachable from each node that is not itself the smallest.

    A large-star step links the greater neighbours of a node to its smallest one, a small-star step the smaller ones; the number
    of steps grows with the logarithm of the longest chain. Smallest neighbours are partial minima, and the join that hands
    them out has plain equality keys, so a hub's rows are split by the adaptive skew join.
    """
    links = edges.where("a != b").select(F.greatest("a", "b").alias("node"), F.least("a", "b").alias("root"))
    links, seen = store(links.distinct(), "components"), None
    while True:
        state = links.agg(F.count("*"), F.bit_xor(F.xxhash64("node", "root"))).first()
        if state == seen or state[0] == 0:
            return links
        seen = state
        both = links.select("node", F.col("root").alias("other")).union(links.select("root", "node"))
        smallest = both.groupBy("node").agg(F.min("other").alias("least")).withColumn("least", F.least("least", "node"))
        large = both.join(smallest, "node").where("other > node").select(F.col("other").alias("node"), F.col("least").alias("root")).distinct()
        large = store(large, "components")
        smallest = large.groupBy("node").agg(F.min("root").alias("least"))
        small = large.join(smallest, "node").where("root > least").select(F.col("root").alias("node"), F.col("least").alias("root"))
        links = store(small.union(smallest.select("node", "least")).distinct(), "components")
