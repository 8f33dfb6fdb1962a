"""Graph operators against brute force on small generated graphs (D7-D7e)."""

from collections import deque

from kestrel.operators import graph


def _edges(spark, pairs):
    return spark.createDataFrame(pairs, "src long, dst long")


def _bfs(pairs, root):
    adj = {}
    for s, d in pairs:
        adj.setdefault(s, []).append(d)
    dist, q = {root: 0}, deque([root])
    while q:
        u = q.popleft()
        for v in adj.get(u, []):
            if v not in dist:
                dist[v] = dist[u] + 1
                q.append(v)
    return dist


def test_hop_distances_match_bfs_and_cap(spark):
    chain = [(i, i + 1) for i in range(14)]              # 0 -> 1 -> ... -> 14
    extra = [(0, 20), (20, 21), (21, 5), (3, 3), (1, 2), (30, 31)]  # repeat, loop, island
    pairs = chain + extra
    got = {r.id: r.distance for r in graph.hop_distances(_edges(spark, pairs), 0, 10).collect()}
    ref = _bfs(pairs, 0)
    for v, d in got.items():
        want = ref.get(v)
        assert d == (float(want) if want is not None and want <= 10 else float("inf")), v
    assert got[14] == float("inf")      # 11+ hops stay unreached (Pregel cap)
    assert got[30] == float("inf") and got[31] == float("inf")
    # child distance <= parent distance + 1 on every edge
    for s, d in pairs:
        if got[s] < 10:             # inside the cap
            assert got[d] <= got[s] + 1


def test_degrees_vertices_and_most_connected(spark):
    e = _edges(spark, [(1, 2), (1, 2), (2, 3), (4, 1)])
    deg = {r.id: r.degree for r in graph.degrees(e).collect()}
    assert deg == {1: 3, 2: 3, 3: 1, 4: 1}
    names = spark.createDataFrame([(1, "A"), (2, "B"), (3, "C"), (9, "Z")], "id long, name string")
    v = {r.id: r.name for r in graph.vertices(e, names).collect()}
    assert v == {1: "A", 2: "B", 3: "C", 4: "Default", 9: "Z"}
    dup = names.unionByName(spark.createDataFrame([(1, "AA")], "id long, name string"))
    rows = graph.vertices(e, dup).collect()
    assert len(rows) == 5 and {r.id: r.name for r in rows}[1] == "A"
    top = [tuple(r) for r in graph.top_degree(e, names, 2).collect()]
    assert top == [(1, "A", 3), (2, "B", 3)]
    counts = spark.createDataFrame([(1, 2), (2, 3), (1, 1)], "id long, n long")
    assert [tuple(r) for r in graph.most_connected(counts, names).collect()] == [(2, "B", 3)]


def test_degrees_of_separation(spark):
    # start 0; target 9 reached at level 3 through two frontier nodes, one of
    # them listing the target twice (hits count entries, D7c)
    pairs = [(0, 1), (0, 2), (1, 3), (2, 4), (3, 9), (4, 9), (4, 9), (9, 0)]
    r = graph.degrees_of_separation(_edges(spark, pairs), 0, 9).first()
    assert (r.degree, r.hits) == (3, 3)
    # unreachable target: stops on the empty frontier
    r = graph.degrees_of_separation(_edges(spark, pairs), 0, 77).first()
    assert (r.degree, r.hits) == (None, 0)
    # start == target: found when an edge leads back to the start
    r = graph.degrees_of_separation(_edges(spark, pairs), 0, 0).first()
    assert (r.degree, r.hits) == (4, 1)
    # hop cap
    r = graph.degrees_of_separation(_edges(spark, pairs), 0, 9, max_hops=2).first()
    assert (r.degree, r.hits) == (None, 0)


def test_search_goes_on_past_ten_levels_and_keeps_self_loops(spark):
    e = _edges(spark, [(i, i + 1) for i in range(14)] + [(3, 3)])
    r = graph.degrees_of_separation(e, 0, 13).first()
    assert (r.degree, r.hits) == (13, 1)
    assert {x.id: x.degree for x in graph.degrees(e).collect()}[3] == 4


def test_frontier_broadcast_and_shuffle_agree(spark):
    pairs = [(i, (i * 7 + 3) % 50) for i in range(50)] + [(i, (i * 11 + 1) % 50) for i in range(50)]
    e = _edges(spark, pairs)
    a = sorted(tuple(r) for r in graph.hop_distances(e, 0, 10).collect())
    held = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        b = sorted(tuple(r) for r in graph.hop_distances(e, 0, 10).collect())
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", held)
    assert a == b


def test_hop_distance_to_stops_early_and_agrees(spark):
    chain = [(i, i + 1) for i in range(14)] + [(0, 20), (20, 5), (30, 31)]
    e = _edges(spark, chain)
    full = {r.id: r.distance for r in graph.hop_distances(e, 0, 10).collect()}
    for target in (0, 1, 5, 10, 12, 31):
        got = [tuple(r) for r in graph.hop_distance_to(e, 0, target, 10).collect()]
        assert got == [(target, full[target])], target
    assert graph.hop_distance_to(e, 0, 999, 10).count() == 0    # not a vertex


def test_nearest_matches_full_distances(spark):
    pairs = [(i, (i * 7 + 3) % 60) for i in range(60)] + [(0, 1), (1, 2), (70, 71)]
    e = _edges(spark, pairs)
    full = sorted((r.distance, r.id) for r in graph.hop_distances(e, 0, 10).collect())
    for k in (1, 3, 10, 61, 200):
        got = [(r.distance, r.id) for r in graph.nearest(e, 0, k, 10).collect()]
        assert got == full[:k], k
