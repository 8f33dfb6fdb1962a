"""Connected components of an edge table, by alternating stars.

Each round moves every vertex's larger neighbours, then its smaller ones, to
its smallest neighbour, until all vertices point at their component's
smallest. Rounds are written to the shared folder (never collected); the
groups are minima, combined before the shuffle. A round writes its minima as
tables of their own, so that both sides of a join are plain exchanges and
Spark can split the rows of a star's centre over tasks.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kestrel.session import materialize, materialize_counted


def _stars(edges: DataFrame) -> DataFrame:
    """One round on edges (u, v)."""
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    low = materialize(both.groupBy("u").agg(F.min("v").alias("m")).select(
        "u", F.least("u", "m").alias("m")), "least")
    large = (both.join(low, "u").where(F.col("v") > F.col("u"))
             .select(F.col("v").alias("u"), F.col("m").alias("v")).distinct())
    large = materialize(large, "large-stars")
    low = materialize(large.groupBy("u").agg(F.min("v").alias("m")), "least")
    moved = large.join(low, "u").where(F.col("v") != F.col("m")).select(
        F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.unionByName(low.select("u", F.col("m").alias("v"))).distinct()


def components(edges: DataFrame, a: str, b: str) -> DataFrame:
    """(node, component): the smallest node reachable, for every node that
    has an edge to another one. Null ends and self-loops are ignored."""
    e = edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).where(
        F.col(a).isNotNull() & F.col(b).isNotNull() & (F.col(a) != F.col(b))).distinct()
    mark = F.sum(F.xxhash64("u", "v").cast("decimal(20,0)"))
    state, rows, seen = materialize_counted(e, "edges", mark=mark)
    while rows:
        state, rows, now = materialize_counted(_stars(state), "stars", mark=mark)
        if now == seen:
            break
        seen = now
    roots = state.select(F.col("v").alias("node")).distinct()
    return state.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(
        roots.select("node", F.col("node").alias("component")))
