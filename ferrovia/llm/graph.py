"""Connected components of an edge table by alternating large and small stars.

Every step is a grouped minimum and an equi-join back to the edges, so a node
with very many edges is pre-aggregated by the one and split by AQE's skew join
in the other.  Each step's edges are a stored table; the driver sees two
numbers per round.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ferrovia.llm.common import drop_stored, resting_on, stored


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """One star step over rows (u, v)."""
    if large:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    else:
        both = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    lowest = stored(both.groupBy("u").agg(F.min("v").alias("m"))
                    .select("u", F.least("u", "m").alias("m")), "star-min")
    joined = both.join(lowest, "u")
    if large:
        out = joined.where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    else:
        out = (joined.where("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
               .unionByName(lowest.select("u", F.col("m").alias("v"))))
    out = stored(out.where("u != v").distinct(), "star")
    drop_stored(lowest)
    return out


def roots_of(forest: DataFrame) -> DataFrame:
    """(node, root) from (node, root) links in which each node has one smaller
    parent: paths are halved by joining the links to themselves until no parent
    has a parent."""
    now = stored(forest.select("node", "root"), "forest")
    while True:
        up = now.select(F.col("node").alias("root"), F.col("root").alias("above"))
        after = stored(now.join(up, "root", "left").select(
            "node", F.coalesce("above", "root").alias("root"), F.col("above").isNotNull().alias("moved")), "forest")
        drop_stored(now)
        now = resting_on(after.select("node", "root"), after)
        if after.where("moved").isEmpty():
            return now


def components(edges: DataFrame) -> DataFrame:
    """(node, root) of every node that has an edge to another one; ``root`` is the
    smallest node of its component (a root itself is not listed)."""
    now = stored(edges.where("u != v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
                 .distinct(), "star")
    mark = None
    while True:
        seen = now.agg(F.count("*").alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("s")).first()
        if (seen["n"], seen["s"]) == mark or not seen["n"]:
            return resting_on(now.select(F.col("u").alias("node"), F.col("v").alias("root")), now)
        mark = seen["n"], seen["s"]
        large = _star(now, True)
        small = _star(large, False)
        for x in (now, large):
            drop_stored(x)
        now = small
