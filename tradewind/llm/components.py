"""Connected components of a link table, by alternating star contractions.

Every round hangs each node's larger neighbours, then its smaller ones, under the
smallest node seen, until nothing changes.  A node's minimum is aggregated on the map side
and joined back, and adaptive joins split nodes with very many links.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tradewind.llm.common import store


def _star(edges: DataFrame, *, larger: bool) -> DataFrame:
    """One contraction of edges (a > b)."""
    if larger:  # both directions: a node's neighbours larger than it move to its smallest neighbour
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        moved = both.join(least, "a").filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    else:  # a node's smaller neighbours, and itself, move to the smallest of them
        least = edges.groupBy("a").agg(F.min("b").alias("m"))
        moved = edges.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        moved = moved.unionByName(least.select("a", F.col("m").alias("b")))
    return moved.filter("a <> b").distinct()


def connected(links: DataFrame) -> DataFrame:
    """(node, component) for every node of the links (a, b); the component is its smallest node."""
    edges = links.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    edges, seen = store(edges, "links"), None
    while True:
        state = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if state == seen or state[0] == 0:
            break
        seen = state
        edges = store(_star(_star(edges, larger=True), larger=False), "links")
    roots = edges.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    return edges.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(roots)
