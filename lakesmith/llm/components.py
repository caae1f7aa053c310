"""Connected components of an edge table, by alternating large-star and small-star steps.

Each step points nodes at the least node they know of: large-star moves a node's larger neighbours
to that least node, small-star its smaller ones. The components become stars around their least
nodes in a number of rounds that grows with the logarithm of the longest path. Each half-step is one
aggregate (pre-aggregated before the shuffle) and one join with its written result, whose two
sides have exchanges of their own, so the neighbours of a hub are split over tasks. Rounds end in
written tables, so a lost executor costs a part of one round.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import staged

MOST_ROUNDS = 100


def _pointed(edges: DataFrame) -> DataFrame:
    """Each edge once, from its larger node (``u``) to its smaller (``v``)."""
    return edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).where("u != v").distinct()


def _sign(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v")), F.sum(F.xxhash64("v", "u") % 1_000_003)).first())


def connected(edges: DataFrame) -> DataFrame:
    """(node, root) of every node that ``edges`` (u, v; comparable values) link; root is the least node.

    Roots themselves are included. Loops, repeated and reversed edges change nothing; rows with a null end
    are left out; without edges the result is empty.
    """
    own = staged(_pointed(edges.select("u", "v").dropna()), "edges")
    sign = _sign(own)
    if not sign[0]:
        return own.select(F.col("u").alias("node"), F.col("v").alias("root"))
    for _ in range(MOST_ROUNDS):
        both = own.union(own.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = staged(both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m")), "least")
        # the smaller nodes u of an edge hand their larger neighbours v to the least that u knows
        large = own.select(F.col("v").alias("u"), F.col("u").alias("w")).join(least, "u").select(F.col("w").alias("u"), F.col("m").alias("v"))
        large = staged(large.where("u != v").distinct(), "large")
        low = staged(large.groupBy("u").agg(F.min("v").alias("m")), "low")
        small = large.join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u != v")
        own = staged(small.union(low.select("u", F.col("m").alias("v"))).distinct(), "edges")
        last, sign = sign, _sign(own)
        if sign == last:
            stars = own.select(F.col("u").alias("node"), F.col("v").alias("root"))
            return stars.union(own.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
    raise RuntimeError(f"components did not settle in {MOST_ROUNDS} rounds")
