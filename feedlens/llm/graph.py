"""Connected components of a link table by alternating star contraction.

Each round hangs the larger neighbours of every node on its smallest neighbour, then the
smaller ones, until every component is a star around its least node.  A round is two
grouped minima and joins on the node; minima are combined before the shuffle and the joins
may be split by adaptive execution, so a node with very many links stays harmless.
Rounds are written to the shared folder, and only a count and a checksum reach the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import drop_stored, stored


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.least(F.col("u"), F.min("v")).alias("m"))
    return both.filter("v > u").join(least, "u").filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))


def _small_star(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = down.groupBy("u").agg(F.min("v").alias("m"))
    moved = down.join(least, "u").filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.unionByName(least.select("u", F.col("m").alias("v")))


def components(links: DataFrame) -> DataFrame:
    """(node, component) for every node of ``links`` (two long columns u, v): the component is
    its least node.  Loops and repeated links are harmless; no links give no rows."""
    edges = stored(links.select("u", "v").filter("u <> v").distinct(), "links")
    seen = None
    while True:
        nxt = stored(_small_star(_large_star(edges).distinct()).distinct(), "links")
        mark = nxt.agg(F.count("*").alias("n"), F.expr("bit_xor(xxhash64(u, v))").alias("x"),
                       F.expr("sum(cast(xxhash64(v, u) as decimal(20, 0)))").alias("s")).first()
        drop_stored(edges)
        edges = nxt
        if mark == seen:
            break
        seen = mark
    stars = edges.select(F.col("u").alias("node"), F.col("v").alias("component"))
    return stars.unionByName(stars.select(F.col("component").alias("node"), "component").distinct())
