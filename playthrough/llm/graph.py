"""Connected components of a graph of links, as joins over the edges."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from playthrough.llm.common import store


def _stars(edges: DataFrame) -> DataFrame:
    """One round over edges (node, to) with to < node: neighbours are linked to the least of them.

    First every node links its larger neighbours to the least node around it, then its smaller ones.
    The table of minima is read back, so that the join deals out both sides and can split a hub.
    """
    both = edges.unionByName(edges.select(F.col("to").alias("node"), F.col("node").alias("to")))
    least = store(both.groupBy("node").agg(F.least(F.min("to"), F.first("node")).alias("least")), "least")
    larger = both.filter(F.col("to") > F.col("node")).join(least, "node")
    once = store(larger.select(F.col("to").alias("node"), F.col("least").alias("to")).distinct(), "large")
    least = store(once.groupBy("node").agg(F.min("to").alias("least")), "least")
    smaller = once.join(least, "node").filter(F.col("to") != F.col("least"))
    return (
        least.select("node", F.col("least").alias("to"))
        .unionByName(smaller.select(F.col("to").alias("node"), F.col("least").alias("to")))
        .distinct()
    )


def components(edges: DataFrame) -> DataFrame:
    """node, component (the least node reachable) for every node with an edge to another.

    ``edges`` has columns a and b; direction, repeats and loops do not matter, edges with a null are left out.
    The number of rounds grows with the logarithm of the longest path.
    """
    one_way = edges.select(F.greatest("a", "b").alias("node"), F.least("a", "b").alias("to"))
    now = store(one_way.filter("node != to").distinct(), "edges")
    state = None
    while True:
        known = now.agg(F.count(F.lit(1)), F.sum(F.xxhash64("node", "to").cast("decimal(38,0)"))).first()
        if tuple(known) == state or not known[0]:
            break
        state = tuple(known)
        now = store(_stars(now), "stars")
    roots = now.select("node", F.col("to").alias("component"))
    return roots.unionByName(roots.select(F.col("component").alias("node"), "component").distinct())
