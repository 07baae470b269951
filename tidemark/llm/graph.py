"""Connected components over an edge table, by joins and grouped minima only."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import save_table


def _minima(directed: DataFrame) -> DataFrame:
    """(u, m): the least of u and its neighbours.  Combined before the shuffle, so a hub is one row per task."""
    return directed.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))


def components(edges: DataFrame) -> DataFrame:
    """(id, root) for every id of ``edges`` (columns ``u``, ``v``): the least id of its component.

    Alternates large-star and small-star steps (Kiveris et al. 2014): every edge is re-hung from the least neighbour, first
    for neighbours above a node, then for those below.  Each step is one grouped minimum and one join on the node, whose hot
    keys adaptive execution splits.  The edge table is written after each round, which cuts the lineage; it never grows by
    more than one edge per node.  Ends when a round changes nothing.  NULL ends are ignored.
    """
    edges = edges.filter("u IS NOT NULL AND v IS NOT NULL AND u <> v").select("u", "v").distinct()
    edges = save_table(edges, "edges")
    seen = None
    while True:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        # large star: neighbours above a node go to its minimum
        large = both.filter("v > u").join(_minima(both), "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = large.filter("u <> v").distinct()
        # small star: a node and its neighbours below go to their minimum (all edges now point down: v < u)
        minima = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(minima, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        small = small.unionByName(minima.select("u", F.col("m").alias("v"))).filter("u <> v").distinct()
        edges = save_table(small, "edges")
        state = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if state == seen:
            break
        seen = state
    roots = edges.select(F.col("u").alias("id"), F.col("v").alias("root"))
    return roots.unionByName(edges.select(F.col("v").alias("id"), F.col("v").alias("root"))).distinct()
