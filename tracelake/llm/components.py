"""Connected components of a graph of links, by contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tracelake.llm.common import stored


def components(links: DataFrame) -> DataFrame:
    """``node, root`` for every node of ``links(a, b)``; a root is a node of its component.

    In a round each node points to the neighbour (or itself) of the smallest
    hash, and the graph is contracted along the pointers; hashes make the rounds
    logarithmic for long chains too. Every round's tables lie in the shared
    folder. The pointers are then followed from the last round back. Minima are
    taken before rows move, so a node with many links costs no task more; the
    joins can be split by adaptive execution.
    """
    order = lambda c: F.struct(F.xxhash64(c).alias("h"), F.col(c).alias("n"))
    edges = stored(
        links.where("a <> b").select("a", "b").union(links.where("a <> b").select("b", "a")).distinct(),
        "edges",
    )
    rounds: list[DataFrame] = []
    while not edges.isEmpty():
        pointers = stored(
            edges.groupBy("a").agg(F.min(order("b")).alias("m"))
            .select(F.col("a").alias("node"), F.least("m", order("a"))["n"].alias("to")),
            "pointers",
        )
        rounds.append(pointers)
        left = pointers.select(F.col("node").alias("a"), F.col("to").alias("a2"))
        right = pointers.select(F.col("node").alias("b"), F.col("to").alias("b2"))
        edges = stored(
            edges.join(left, "a").join(right, "b").where("a2 <> b2")
            .select(F.col("a2").alias("a"), F.col("b2").alias("b")).distinct(),
            "edges",
        )
    if not rounds:
        return links.select(F.col("a").alias("node"), F.col("a").alias("root")).where("false")
    found = rounds[-1].select("node", F.col("to").alias("root"))
    for pointers in reversed(rounds[:-1]):
        after = found.select(F.col("node").alias("to"), "root")
        # a pointer to a node that has no links left is a root
        found = pointers.join(after, "to", "left").select(
            "node", F.coalesce("root", "to").alias("root")
        )
    return found
