"""The level loop on bucketed tables: no exchange of edges or reached vertices,
hubs outside the buckets, early stop, names dropped from the catalog."""

import contextlib
import io
import random

import pytest

from kestrel.operators import graph


def edges(spark, pairs):
    return spark.createDataFrame(pairs, "src long, dst long")


def plan(df):
    out = io.StringIO()
    with contextlib.redirect_stdout(out):
        df.explain("simple")
    return out.getvalue()


@pytest.fixture
def no_broadcast(spark):
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield spark
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def test_a_level_deals_only_the_neighbours(no_broadcast, monkeypatch):
    spark = no_broadcast
    monkeypatch.setattr(graph, "BUCKET_EDGES", 50)
    rng = random.Random(1)
    pairs = [(rng.randrange(80), rng.randrange(80)) for _ in range(300)]
    at = graph.Levels(edges(spark, pairs), 0)
    try:
        assert at.buckets == 6
        for level in range(3):
            at.expand(level)
            text = plan(at.candidates(level + 1))
            # one exchange: the neighbours by id; edges, frontier and the table
            # of reached vertices are read bucket by bucket
            assert text.count("Exchange") == 1 and text.count("Bucketed: true") == 3, text
    finally:
        at.close()
    assert not [t for t in spark.catalog.listTables() if t.name.startswith("kestrel_")]


def test_hubs_stay_out_of_the_buckets(spark):
    rng = random.Random(2)
    pairs = [(0, n) for n in range(1, 60)] + [(rng.randrange(100), rng.randrange(200))
                                              for _ in range(300)] + [(0, 1)] * 5 + [(5, 0)]
    want = {r.id: r.level for r in graph.hop_levels(edges(spark, pairs), 5).collect()}
    lv, _ = graph._bfs(edges(spark, pairs), 5, 10, hub_edges=8)
    assert {r.id: r.level for r in lv.collect()} == want and len(want) > 50


def test_search_stops_when_enough_named_vertices_are_reached(spark, monkeypatch):
    pairs = [(n, n + 1) for n in range(9)] + [(n, 100 + n) for n in range(9)]
    names = spark.createDataFrame([(n,) for n in [*range(100, 109), 0, 0, 777]], "id long")
    levels = []
    expand = graph.Levels.expand

    def counted(self, level, watch=None):
        levels.append(level)
        return expand(self, level, watch)

    monkeypatch.setattr(graph.Levels, "expand", counted)
    got = [tuple(r) for r in graph.nearest(edges(spark, pairs), 0, 3, vertex_ids=names).collect()]
    assert got == [(0, 0.0), (100, 1.0), (101, 2.0)] and levels == [0, 1]
    got = [tuple(r) for r in graph.nearest(edges(spark, pairs), 0, 99, vertex_ids=names).collect()]
    assert len(got) == 11 and got[-1] == (777, float("inf"))
    levels.clear()
    assert graph.hop_distance_to(edges(spark, pairs), 0, 2).first().distance == 2.0
    assert levels == [0, 1]


def test_null_ends_and_failed_searches(spark):
    pairs = [(0, 1), (None, 2), (1, None), (1, 3)]
    assert {r.id: r.level for r in graph.hop_levels(edges(spark, pairs), 0).collect()} == {
        0: 0, 1: 1, 3: 2}

    def stop(level, frontier, size):
        raise RuntimeError("stop")

    with pytest.raises(RuntimeError):
        graph._bfs(edges(spark, pairs), 0, None, on_level=stop)
    assert not [t for t in spark.catalog.listTables() if t.name.startswith("kestrel_")]
