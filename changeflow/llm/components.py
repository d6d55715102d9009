"""Connected components by contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from changeflow.llm.common import stage


def components(links: DataFrame) -> DataFrame:
    """(id, component) for every end of ``links`` (a, b); ``component`` is the smallest id that can be reached.

    Each round hooks nodes onto a neighbour that is a local minimum and replaces the links by those between what is left,
    so stars and trees of any size vanish in a few rounds. Minima are folded before they are shuffled, and the tables that
    are joined are written first, so that adaptive execution can split the many links of one node.
    """
    edges = stage(links.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).filter("a < b").distinct(), "edges")
    found = None
    while not edges.isEmpty():
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = stage(both.groupBy("a").agg(F.least("a", F.min("b")).alias("to")), "least")
        roots = least.filter("a = to").select("to")
        moves = stage(least.filter("a <> to").join(roots, "to").select("a", "to"), "moves")
        found = moves if found is None else stage(
            found.join(moves.select(F.col("a").alias("to"), F.col("to").alias("next")), "to", "left")
            .select("a", F.coalesce("next", "to").alias("to")).unionByName(moves), "found")
        for end in ("a", "b"):
            edges = edges.join(moves.select(F.col("a").alias(end), F.col("to").alias("next")), end, "left").withColumn(
                end, F.coalesce("next", end)).drop("next")
        edges = stage(edges.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).filter("a < b").distinct(), "edges")
    if found is None:
        return edges.select(F.col("a").alias("id"), F.col("b").alias("component"))
    roots = found.select(F.col("to").alias("id"), F.col("to").alias("component")).distinct()
    return found.select(F.col("a").alias("id"), F.col("to").alias("component")).unionByName(roots)
