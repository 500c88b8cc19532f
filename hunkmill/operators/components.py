"""Connected components of an undirected graph, by alternating large and small stars.

Each round hangs the larger neighbours of every node, then the smaller ones, on its smallest neighbour,
until nothing changes; the rounds grow with the logarithm of the nodes.  Only a count and a checksum of
the edges reach the driver.  The smallest neighbour is an aggregation that combines on the map side, so a
node with very many neighbours is no row of its own anywhere.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hunkmill import workspace


def components(edges: DataFrame, *within: str) -> DataFrame:
    """(within..., node, root) of every node of the edges (within..., u, v): the smallest node it is connected with.

    Nodes of different ``within`` values are different nodes.  Loops and repeated edges do no harm; nulls are no nodes.
    """
    keys = list(within)
    start = edges.where("u <> v").select(*keys, F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()
    live, seen = workspace.keep(start, "stars"), None
    while True:
        both = live.select(*keys, "u", "v").unionByName(live.select(*keys, F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy(*keys, "u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.where("v > u").join(least, [*keys, "u"]).select(*keys, F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        small_least = large.groupBy(*keys, "u").agg(F.min("v").alias("m"))
        hung = large.join(small_least, [*keys, "u"]).where("v <> m").select(*keys, F.col("v").alias("u"), F.col("m").alias("v"))
        fresh = workspace.keep(hung.unionByName(small_least.select(*keys, "u", F.col("m").alias("v"))).where("u <> v").distinct(), "stars")
        workspace.forget(live)
        live = fresh
        state = tuple(live.agg(F.count("*"), F.sum(F.xxhash64(*keys, "u", "v").cast("decimal(38,0)"))).first())
        if state == seen:
            break
        seen = state
    roots = live.select(*keys, F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    return live.select(*keys, F.col("u").alias("node"), F.col("v").alias("root")).unionByName(roots)
