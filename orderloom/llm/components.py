"""Connected components of an undirected graph by alternating star operations.

Large and small stars (Kiveris et al., 2014) reconnect every node to the smallest
neighbour it knows; the edges shrink to one star per component in a logarithmic
number of rounds. Each round is joins and grouped minima. A node with many neighbours
is spread over salts: minima are taken per (node, salt) and then per node, and handed
back the same way, so no task gets all its neighbours. Only a count and a checksum
reach the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderloom.llm.common import checkpointed

SALTS = 32


def _with_least(edges: DataFrame) -> DataFrame:
    """Edges (u, v) with ``m``, the least v of the edge's u."""
    salted = edges.withColumn("salt", F.pmod(F.xxhash64("v"), F.lit(SALTS)))
    cells = salted.groupBy("u", "salt").agg(F.min("v").alias("m"))
    least = cells.groupBy("u").agg(F.min("m").alias("m"))
    return salted.join(cells.select("u", "salt").join(least, "u"), ["u", "salt"]).select("u", "v", "m")


def _large_star(edges: DataFrame) -> DataFrame:
    """Every larger neighbour of a node is linked to the smallest of that neighbourhood."""
    both = _with_least(edges.union(edges.select("v", "u")))
    return both.where("v > u").select(F.col("v").alias("u"), F.least("u", "m").alias("v"))


def _small_star(edges: DataFrame) -> DataFrame:
    """Every smaller neighbour of a node, and the node, are linked to the smallest of them."""
    down = _with_least(edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")))
    moved = down.select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.union(down.select("u", F.col("m").alias("v"))).where("u != v").distinct()


def components(edges: DataFrame) -> DataFrame:
    """(node, component) of all nodes with an edge; component is the smallest node.

    ``edges`` has two long columns. Loops and repeated edges don't matter, nulls are
    left out, no edges give no rows.
    """
    first, second = edges.columns
    edges = (
        edges.select(F.greatest(first, second).alias("u"), F.least(first, second).alias("v")).where("u != v").distinct()
    )
    edges, mark = checkpointed(edges), None
    while True:
        edges = checkpointed(_small_star(_large_star(edges)))
        now = edges.agg(
            F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(20,0)"))
        ).first()
        if mark == now:
            break
        mark = now
    smallest = edges.select(F.col("u").alias("node"), F.col("v").alias("component"))
    return smallest.union(edges.select(F.col("v"), F.col("v")).distinct())
