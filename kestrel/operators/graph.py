"""Graph analytics on (src, dst) edge DataFrames: degrees, most connected,
vertex table, hop distances and degrees of separation.

Breadth-first search is a driver loop over *levels*, one Spark job per
level. Edges are written once, bucketed by source; reached vertices are one
table, partitioned by level and bucketed by id in the same number of buckets.
So a level joins the last level's partition with the edges bucket by bucket,
deals the neighbours once by id, drops those in the table (bucketed by id, no
exchange, no union of levels) and appends what is new. Edges and reached
vertices are never shuffled again. Vertices with more than ``hub_edges`` edges
are kept in a table of their own that is not bucketed, so that no task holds a
hub; the few of them in a frontier are broadcast.

Frontiers are never collected; only row counts reach the driver (observed
during the level's write). The tables lie in the session's shared checkpoint
folder, which cuts the lineage, so a lost executor recomputes at most one
level; their names in the catalog are dropped when the loop ends.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from kestrel.session import materialize, materialize_counted, scratch_path


def _ends(edges: DataFrame) -> DataFrame:
    """Both ends of every edge as ``id`` rows, from one scan of the edges."""
    return edges.select(F.explode(F.array("src", "dst")).alias("id"))


def degrees(edges: DataFrame) -> DataFrame:
    """In + out degree per vertex (repeats and both ends counted, D7d)."""
    return _ends(edges).groupBy("id").agg(F.count("*").alias("degree"))


def top_degree(edges: DataFrame, names: DataFrame, k: int = 10) -> DataFrame:
    """The k most connected named vertices: (id, name, degree)."""
    d = degrees(edges).join(names.select("id", "name"), "id")
    return d.orderBy(F.desc("degree"), F.asc("id")).limit(k).select("id", "name", "degree")


def vertices(edges: DataFrame, names: DataFrame, default: str = "Default") -> DataFrame:
    """G1: every named vertex plus every edge end; unnamed ends get ``default``.

    One row per id: a repeated name id keeps its smallest name (a graph
    keeps one attribute per vertex; this makes the choice deterministic).
    The per-id aggregate and the join share the hash partitioning on ``id``.
    """
    one = names.groupBy("id").agg(F.min("name").alias("name"))
    ids = _ends(edges).union(names.select("id")).distinct()
    return ids.join(one, "id", "left").select(
        "id", F.coalesce(F.col("name"), F.lit(default)).alias("name"))


def connection_counts(line_counts: DataFrame) -> DataFrame:
    """Total neighbour entries per vertex over all of its lines."""
    return line_counts.groupBy("id").agg(F.sum("n").alias("n"))


def most_connected(line_counts: DataFrame, names: DataFrame) -> DataFrame:
    """(id, name, n) of the vertex with most entries; ties -> larger id.

    The arg-max is one row, so the name lookup broadcasts that row and
    streams the names table once.
    """
    totals = connection_counts(line_counts)
    m = totals.agg(F.max(F.struct("n", "id")).alias("_m")).select(
        F.col("_m.id").alias("id"), F.col("_m.n").alias("n"))
    return F.broadcast(m).join(names.select("id", "name"), "id").select("id", "name", "n")


# --- level loop ---------------------------------------------------------------

BUCKET_EDGES = 100_000       # edges that a bucket holds, until there are as many
                             # buckets as shuffle partitions
HUB_EDGES = 1_000_000        # edges of a vertex that is not put into a bucket


class Levels:
    """The tables of one search: edges by source, reached vertices by level."""

    def __init__(self, edges: DataFrame, root, hub_edges: int = HUB_EDGES):
        spark = self.spark = edges.sparkSession
        plain, rows = materialize_counted(edges.select("src", "dst"), "bfs-edges")
        most = int(spark.conf.get("spark.sql.shuffle.partitions"))
        self.buckets = max(1, min(most, -(-rows // BUCKET_EDGES)))
        self.hubs, n = materialize_counted(
            plain.groupBy("src").agg(F.count(F.lit(1)).alias("_n"))
            .where(F.col("_n") > hub_edges).select(F.col("src").alias("id")), "bfs-hubs")
        self.hub_edges = None
        if n:                                   # rows / hub_edges ids at most
            named = F.broadcast(self.hubs.select(F.col("id").alias("src")))
            self.hub_edges = materialize(plain.join(named, "src", "left_semi").distinct(),
                                         "bfs-hub-edges")
            plain = plain.join(named, "src", "left_anti")
        name = uuid.uuid4().hex[:12]
        self.edge_table, self.seen_table = f"kestrel_edges_{name}", f"kestrel_seen_{name}"
        self.seen_path = scratch_path(spark, "bfs-seen")
        (plain.repartition(self.buckets, "src").dropDuplicates(["src", "dst"]).write
         .bucketBy(self.buckets, "src").sortBy("src").format("parquet")
         .option("path", scratch_path(spark, "bfs-edges-by-source"))
         .saveAsTable(self.edge_table))
        start = spark.range(1).select(F.lit(root).cast("long").alias("id"))
        self._append(start, 0)

    def _append(self, ids: DataFrame, level: int) -> None:
        (ids.withColumn("level", F.lit(level)).write.mode("append").partitionBy("level")
         .bucketBy(self.buckets, "id").sortBy("id").format("parquet")
         .option("path", self.seen_path).saveAsTable(self.seen_table))

    def edges(self) -> DataFrame:
        return self.spark.table(self.edge_table)

    def seen(self) -> DataFrame:
        return self.spark.table(self.seen_table)

    def frontier(self, level: int) -> DataFrame:
        return self.seen().where(F.col("level") == level).select("id")

    def candidates(self, level: int) -> DataFrame:
        """The distinct neighbours of a level that were not reached before."""
        front = self.frontier(level)
        e = self.edges()
        found = e.join(front, e.src == front.id).select(F.col("dst").alias("id"))
        if self.hub_edges is not None:
            hubs = F.broadcast(front.join(self.hubs, "id", "left_semi"))
            h = self.hub_edges
            found = found.unionAll(h.join(hubs, h.src == hubs.id).select(
                F.col("dst").alias("id")))
        # dealt by id into the table's buckets; the null end of an edge is no vertex
        new = found.where("id IS NOT NULL").repartition(self.buckets, "id").distinct()
        return new.join(self.seen().select("id"), "id", "left_anti")

    def expand(self, level: int, watch=None) -> tuple[int, bool]:
        """Write the level after ``level``: its size, and whether it holds
        ``watch`` (observed in the same job)."""
        obs = Observation(f"bfs-{level}-{uuid.uuid4().hex[:8]}")
        hit = F.lit(0) if watch is None else F.coalesce(
            F.max((F.col("id") == F.lit(watch)).cast("int")), F.lit(0))
        self._append(self.candidates(level).observe(
            obs, F.count(F.lit(1)).alias("rows"), hit.alias("hit")), level + 1)
        return int(obs.get["rows"]), bool(obs.get["hit"])

    def levels(self) -> DataFrame:
        """(id, level) of all reached vertices, from the files alone."""
        return self.spark.read.schema("id long, level int").parquet(self.seen_path)

    def close(self) -> None:
        for name in (self.edge_table, self.seen_table):
            self.spark.sql(f"DROP TABLE IF EXISTS {name}")   # external: the files stay


def _bfs(edges: DataFrame, root, max_hops: int | None, on_level=None, watch=None,
         hub_edges: int = HUB_EDGES) -> tuple[DataFrame, int | None]:
    """Expand levels from ``root``: ((id, level) of the reached vertices, the
    level of ``watch`` if it was reached). ``on_level(level, frontier, size)``
    runs before a level is expanded and may return True to stop; the loop also
    stops at the level that holds ``watch``, at an empty level and after
    ``max_hops``."""
    at = Levels(edges, root, hub_edges)
    try:
        size, level, found = 1, 0, watch is not None and watch == root
        while size and not found and (max_hops is None or level < max_hops):
            if on_level is not None and on_level(level, at.frontier(level), size):
                break
            size, found = at.expand(level, watch)
            level += 1
        return at.levels(), level if found else None
    finally:
        at.close()


def hop_levels(edges: DataFrame, root, max_hops: int | None = 10) -> DataFrame:
    """(id, level) for every vertex reachable from ``root`` within ``max_hops``."""
    return _bfs(edges, root, max_hops)[0]


def hop_distances(edges: DataFrame, root, max_hops: int | None = 10,
                  vertex_ids: DataFrame | None = None) -> DataFrame:
    """(id, distance double) for every vertex; ``Infinity`` when not
    reached within ``max_hops`` directed hops (the Pregel cap, D7e).

    ``vertex_ids`` (column ``id``) is the vertex set; by default every edge
    end plus the root.
    """
    lv = hop_levels(edges, root, max_hops)
    if vertex_ids is None:
        vertex_ids = (_ends(edges)
                      .union(edges.sparkSession.range(1).select(F.lit(root).cast("long").alias("id")))
                      .distinct())
    return vertex_ids.select("id").join(lv, "id", "left").select(
        "id", F.coalesce(F.col("level").cast("double"), F.lit(float("inf"))).alias("distance"))


def nearest(edges: DataFrame, root, k: int, max_hops: int | None = 10,
            vertex_ids: DataFrame | None = None) -> DataFrame:
    """The k vertices nearest to ``root``, ordered by (distance, id),
    as ``hop_distances(...).orderBy("distance", "id").limit(k)`` returns
    them, but the level loop stops once k vertices are reached: every vertex
    not reached yet is further away. With ``vertex_ids`` only those vertices
    count and are returned. If fewer than k are reachable, unreached vertices
    (``Infinity``) fill up by id."""
    spark = edges.sparkSession
    state = {"seen": 0}
    if vertex_ids is not None:
        vertex_ids = vertex_ids.select("id").distinct()

    def enough(level, frontier, size):
        if vertex_ids is not None:
            size = frontier.join(vertex_ids, "id", "left_semi").count()
        state["seen"] += size
        return state["seen"] >= k

    lv = _bfs(edges, root, max_hops, on_level=enough)[0]
    if vertex_ids is None:
        vertex_ids = _ends(edges).union(
            spark.range(1).select(F.lit(root).cast("long").alias("id"))).distinct()
    kind = "inner" if state["seen"] >= k else "left"
    return vertex_ids.join(lv, "id", kind).select(
        "id", F.coalesce(F.col("level").cast("double"), F.lit(float("inf"))).alias("distance")
    ).orderBy("distance", "id").limit(k)


def hop_distance_to(edges: DataFrame, root, target, max_hops: int | None = 10,
                    vertex_ids: DataFrame | None = None) -> DataFrame:
    """(id, distance) of one vertex, the value ``hop_distances`` gives
    it, but the level loop stops at the level that first reaches ``target``.
    No row when ``target`` is not a vertex (a filter on the vertex set, as
    in the reference)."""
    spark = edges.sparkSession
    level = _bfs(edges, root, max_hops, watch=target)[1]
    dist = float("inf") if level is None else float(level)
    if vertex_ids is None:
        vertex_ids = _ends(edges).union(
            spark.range(1).select(F.lit(root).cast("long").alias("id")))
    one = vertex_ids.select("id").where(F.col("id") == F.lit(target)).distinct()
    return one.select("id", F.lit(dist).alias("distance"))


def degrees_of_separation(edges: DataFrame, start, target, max_hops: int | None = None) -> DataFrame:
    """One row (start, target, degree, hits).

    Levels expand from ``start``; before the level-d frontier is expanded,
    its edge entries into ``target`` are counted (``hits``, with repeats,
    D7c) against the target's in-edges, pre-aggregated per source and
    written once. The first level with hits gives degree = d + 1. Stops with
    degree NULL and hits 0 when the frontier empties (unreachable) or
    ``max_hops`` levels were searched (D7b); edges of a vertex listed on
    several lines are all kept (D7).
    """
    spark = edges.sparkSession
    into = materialize(edges.where(F.col("dst") == F.lit(target)).groupBy("src").agg(
        F.count("*").alias("_h")), "bfs-into-target")
    found = {}

    def probe(level, frontier, size):
        hits = into.join(frontier, into.src == frontier.id).agg(F.sum("_h")).first()[0]
        if hits:
            found["degree"], found["hits"] = level + 1, int(hits)
            return True
        return max_hops is not None and level + 1 >= max_hops

    _bfs(edges, start, None, on_level=probe)
    return spark.createDataFrame(
        [(int(start), int(target), found.get("degree"), found.get("hits", 0))],
        "start long, target long, degree int, hits long")
