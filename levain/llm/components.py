"""Connected components of a graph given as a table of links, by alternating stars.

Each round replaces the links of a node by links to its smallest neighbour: first those to larger
nodes, then those to smaller ones.  Rounds end when the links no longer change; there are
about as many as the logarithm of the longest chain.  Minima are pre-aggregated, links are rejoined
by node (a hot node is a skewed join side, which Spark splits), and every round is a written table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from levain.llm.common import written


def components(links: DataFrame) -> DataFrame:
    """(node, label): for each node of the links (u, v) the smallest node of its component."""
    now = written(links.filter("u != v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "links")
    before = None
    while (state := _state(now)) != before:
        before = state
        now = written(_small_star(_large_star(now)), "links")
    nodes = now.groupBy(F.col("u").alias("node")).agg(F.min("v").alias("label"))
    return nodes.unionByName(now.select(F.col("v").alias("node"), F.col("v").alias("label")).distinct())


def _state(links: DataFrame) -> tuple:
    return tuple(links.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())


def _large_star(links: DataFrame) -> DataFrame:
    """Each node's larger neighbours are linked to its smallest neighbour (or to it, if that is smaller)."""
    least = links.groupBy("u").agg(F.min("v").alias("m"))
    low = links.select("v").distinct().withColumnRenamed("v", "c")  # centres that may have no smaller neighbour
    centre = low.join(least, low["c"] == least["u"], "left").select("c", F.coalesce("m", "c").alias("m"))
    moved = links.join(centre, links["v"] == centre["c"]).select("u", F.col("m").alias("v"))
    return moved.distinct()


def _small_star(links: DataFrame) -> DataFrame:
    """Each node and its smaller neighbours are linked to the smallest of them."""
    least = links.groupBy("u").agg(F.min("v").alias("m")).withColumnRenamed("u", "c")
    others = links.join(least, links["u"] == least["c"]).select(F.col("v").alias("u"), F.col("m").alias("v"))
    return others.unionByName(least.select(F.col("c").alias("u"), F.col("m").alias("v"))).filter("u != v").distinct()
