"""Connected components of a graph given by edges, by repeated contraction.

Defined cases: edges with a null end and edges from a vertex to itself say nothing; repeated and turned edges are one; a vertex
in no other edge has no row; further columns of the edges are left out; no edges give no rows. No group is gathered anywhere:
a vertex with a third of all edges is summed up while scanning.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialise


def connected_components(edges: DataFrame) -> DataFrame:
    """(id, component) of every vertex of edges (a, b); component is the smallest id.

    In each round every vertex points to its smallest neighbour, or itself if that is larger; pointers are followed four
    steps up, vertices are replaced by what they reach, and edges within one vertex go. Pointers fall, so this ends; every
    vertex that is not smaller than all of its neighbours disappears, so rounds are few. Neighbourhoods are only ever
    summed up (a minimum), never gathered; rounds are written to the shared folder.
    """
    edges = materialise(edges.where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct())
    where = None
    while not edges.isEmpty():
        both = edges.select("a", "b").unionAll(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        up = both.groupBy(F.col("a").alias("v")).agg(F.min("b").alias("low")).select("v", F.least("v", "low").alias("to"))
        up = materialise(up)
        for _ in range(2):
            step = up.select(F.col("v").alias("w"), F.col("to").alias("next"))
            up = materialise(up.join(step, F.col("to") == F.col("w")).select("v", F.col("next").alias("to")))
        first, second = (up.select(F.col("v").alias(c), F.col("to").alias(f"{c}2")) for c in "ab")
        edges = materialise(
            edges.join(first, "a").join(second, "b").where("a2 <> b2").select(F.least("a2", "b2").alias("a"), F.greatest("a2", "b2").alias("b")).distinct()
        )
        if where is None:
            where = up.select(F.col("v").alias("id"), F.col("to").alias("component"))
        else:
            where = materialise(where.join(up, F.col("component") == F.col("v"), "left").select("id", F.coalesce("to", "component").alias("component")))
    if where is None:
        return edges.select(F.col("a").alias("id"), F.col("b").alias("component"))
    return where
