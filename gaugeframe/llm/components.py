"""Connected components of a graph of any size, by rounds of joins.

Every round points nodes at smaller nodes: first each node's larger neighbours at its
smallest neighbour, then each node's smaller neighbours at the smallest of them.  Both keep
the components; rounds end when the graph is a forest of stars, after a
number of rounds that grows with the logarithm of the longest path.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gaugeframe.llm.storing import release
from gaugeframe.storage import cut_lineage


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """Nodes of the edges with the smallest node of their component (``node``, ``component``).

    Edges have no direction; loops, repeated edges and edges with a null end add nothing.
    Nodes are whole numbers.  The smallest neighbour of a node comes from a partial
    aggregation and is joined back, so the neighbours of a node never meet in one task.
    """
    ends = edges.select(F.col(a).cast("long").alias("u"), F.col(b).cast("long").alias("v")).dropna()
    pairs = ends.filter("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()
    pairs = cut_lineage(pairs)
    release(pairs.sparkSession)
    while not _stars(pairs):
        pairs = _round(pairs)
        release(pairs.sparkSession)
    nodes = pairs.select(F.col("u").alias("node"), F.col("v").alias("component"))
    roots = pairs.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return nodes.union(roots)


def _stars(pairs: DataFrame) -> bool:
    """Whether every node that points somewhere points at one node that points nowhere."""
    most = pairs.groupBy("u").agg(F.count("*").alias("ends")).filter("ends > 1")
    if not most.isEmpty():
        return False
    return pairs.join(pairs.select(F.col("v").alias("u")).distinct(), "u", "left_semi").isEmpty()


def _round(pairs: DataFrame) -> DataFrame:
    # Large star: a node's larger neighbours are linked to its smallest neighbour or itself.
    both = pairs.union(pairs.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("low")).select("u", F.least("u", "low").alias("low"))
    # Stored, so that the join has two plain shuffles and a node of many edges is split.
    least = cut_lineage(least)
    larger = pairs.select(F.col("v").alias("u"), F.col("u").alias("v"))
    linked = larger.join(least, "u").select(F.col("v").alias("u"), F.col("low").alias("v")).distinct()
    linked = cut_lineage(linked)
    release(linked.sparkSession)
    # Small star: a node and its smaller neighbours are linked to the smallest of them.
    least = cut_lineage(linked.groupBy("u").agg(F.min("v").alias("low")))
    turned = linked.join(least, "u").select(F.col("v").alias("u"), F.col("low").alias("v")).filter("u <> v")
    return cut_lineage(turned.union(least.select("u", F.col("low").alias("v"))).distinct())
