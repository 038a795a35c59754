"""Connected components by alternating large-star and small-star steps (Kiveris et al., 2014)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vibralake.llm.shared import dropped, staged


def components(edges: DataFrame) -> DataFrame:
    """For edges (u, v) of any ordered type, each node that has an edge and its least reachable node: node, root.

    A step sends each neighbour one row, however many neighbours a node has: the least neighbour is
    pre-aggregated before the shuffle and joined back, so a hub's rows can be split over tasks.
    Every step is written to the shared folder.
    """
    current = staged(edges.filter("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "edges")
    before = None
    while True:
        both = current.unionByName(current.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("m", "u").alias("m"))
        large = both.filter("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        small = large.join(large.groupBy("u").agg(F.min("v").alias("m")), "u")
        last, current = current, staged(small.select("u", F.col("m").alias("v")).union(small.filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))).distinct(), "edges")
        dropped(last)
        after = tuple(current.agg(F.count("*"), F.sum(F.hash("u", "v").cast("bigint")), F.bit_xor(F.xxhash64("u", "v"))).first())
        if after == before:
            return current.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(
                current.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
            )
        before = after
