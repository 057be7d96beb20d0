"""Connected components of a large graph: alternating star joins until nothing changes."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import cut


def connected_components(edges: DataFrame) -> DataFrame:
    """Edges ``(a, b)`` to rows ``(node, root)``: the least node of its component, for every node but the roots.

    Each round points the larger neighbours of every node to its least neighbour, then the smaller
    ones; the number of rounds grows with the logarithm of the longest path.  A node's least
    neighbour is a map-side aggregate, and the join that uses it has one row per node on one side,
    so a hub's rows can be split.  Every round is cut into the shared folder.
    """
    pairs = cut(edges.where("a <> b").select(F.greatest("a", "b").alias("node"), F.least("a", "b").alias("root"))
                .distinct())
    state = None
    while True:
        both = pairs.unionByName(pairs.select(F.col("root").alias("node"), F.col("node").alias("root")))
        least = both.groupBy("node").agg(F.min("root").alias("m")).select("node", F.least("node", "m").alias("m"))
        large = (both.join(least, "node").where("root > node")
                 .select(F.col("root").alias("node"), F.col("m").alias("root")).distinct())
        lower = large.groupBy("node").agg(F.min("root").alias("m"))
        small = (large.join(lower, "node").where("root <> m").select(F.col("root").alias("node"), F.col("m").alias("root"))
                 .unionByName(lower.select("node", F.col("m").alias("root"))).distinct())
        pairs = cut(small)
        now = pairs.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("node", "root")),
                        F.bit_xor(F.xxhash64("root", "node"))).first()
        if now == state:
            return pairs
        state = now
