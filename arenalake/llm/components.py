"""Connected components of a graph of links."""

from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F

from arenalake.llm.store import stored


def components(links: DataFrame) -> DataFrame:
    """``node, component``: the smallest node that links (columns ``a`` and ``b``) lead to.

    Alternates two steps until nothing changes: every node passes the smallest
    neighbour on to its larger neighbours, then to its smaller ones. Each step is a
    grouping by node that is added up before the shuffle and a join; the number of
    rounds grows with the logarithm of the longest path. Each round is written to the
    shared folder, and a checksum of 128 bits tells whether it changed anything. Nodes without
    links do not appear.
    """
    edges = stored(links.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    before = _mark(edges)
    while True:
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        # Larger neighbours move to the smallest neighbour (or the node itself).
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = (
            both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        )
        large = stored(large)
        # Smaller neighbours, and the node, move to the smallest one.
        lowest = large.groupBy("a").agg(F.min("b").alias("m"))
        moved = large.join(lowest, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b")
        following = stored(lowest.select("a", F.col("m").alias("b")).unionByName(moved).distinct())
        mark = _mark(following)
        if mark == before:
            roots = following.select(F.col("a").alias("node"), F.col("b").alias("component"))
            return roots.unionByName(following.select(F.col("b").alias("node"), F.col("b").alias("component"))).distinct()
        edges, before = following, mark


def _mark(edges: DataFrame) -> Row:
    """A checksum of different edges, whatever their order."""
    high, low = (F.xxhash64(F.lit(k), "a", "b") for k in (1, 2))
    return edges.agg(F.count("*"), F.bit_xor(high), F.bit_xor(low)).first()
