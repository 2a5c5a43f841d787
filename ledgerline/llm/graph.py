"""Components of a graph given as a table of links, by repeated contraction in Spark."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.sources.staging import stage


def components(links: DataFrame) -> DataFrame:
    """``node, root`` for every node with a link; ``root`` is the component's smallest node.

    ``links`` has longs ``a`` and ``b``.  In each round every node points to its smallest
    neighbour; pointers are followed to their ends and the links drawn between the ends
    only.  At least half of the linked nodes go each round, so rounds and written tables
    grow with the logarithm of the largest component.  Each round is written to the shared
    folder, so lost executors cost one round at most.
    """
    edges = stage(links.select("a", "b").where("a <> b").distinct(), "links")
    known: DataFrame | None = None
    while not edges.isEmpty():
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        up = both.groupBy("a").agg(F.min("b").alias("b")).select("a", F.least("a", "b").alias("to"))
        up = stage(_to_roots(stage(up, "up")), "roots")
        if known is None:
            known = up.select(F.col("a").alias("node"), F.col("to").alias("root"))
        else:
            known = known.join(up.withColumnRenamed("a", "root"), "root", "left").select(
                "node", F.coalesce("to", "root").alias("root")
            )
        known = stage(known, "known")
        edges = (
            edges.join(up.select("a", F.col("to").alias("x")), "a")
            .join(up.select(F.col("a").alias("b"), F.col("to").alias("y")), "b")
            .where("x <> y")
            .select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b"))
            .distinct()
        )
        edges = stage(edges, "links")
    return known if known is not None else links.select(F.col("a").alias("node"), F.col("b").alias("root")).limit(0)


def _to_roots(up: DataFrame) -> DataFrame:
    """Follow ``a -> to`` to the end; pointers only go down, so there are no cycles."""
    while True:
        further = up.select(F.col("a").alias("to"), F.col("to").alias("next"))
        ahead = up.join(further, "to", "left").select("a", "to", F.coalesce("next", "to").alias("next"))
        ahead = stage(ahead, "ahead")
        if ahead.where("next <> to").isEmpty():
            return ahead.select("a", "to")
        up = ahead.select("a", F.col("next").alias("to"))
