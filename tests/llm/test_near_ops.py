"""Jaccard join, embedding near-dedup, components: brute force."""

import random
from itertools import combinations

import numpy as np
import pytest

from kestrel.llm.components import components
from kestrel.llm.embed_dedup import embed_dedup
from kestrel.llm.jaccard_join import SignatureTree, jaccard_join, links
from tests.llm.common import documents, empty, plain, prose


def united(nodes, pairs):
    label = {v: v for v in nodes}
    for a, b in pairs:
        x, y = sorted((label[a], label[b]))
        label = {k: x if v == y else v for k, v in label.items()}
    return label


def test_components(spark):
    rng = random.Random(1)
    pairs = [(rng.randrange(300), rng.randrange(300)) for _ in range(200)] + [(7, 7)]
    pairs += [(1000 + i, 1001 + i) for i in range(40)] + [(2000, 2001 + i) for i in range(200)]
    e = spark.createDataFrame([*pairs, (None, 3)], "a long, b long")
    got = {r.node: r.component for r in components(e, "a", "b").collect()}
    nodes = {v for p in pairs if p[0] != p[1] for v in p}
    assert got == united(nodes, [p for p in pairs if p[0] != p[1]])
    assert components(e.where("false"), "a", "b").count() == 0


def test_components_of_a_hot_centre(spark):
    """Half of all edges meet in one vertex, whose rows Spark may split."""
    small = {"spark.sql.autoBroadcastJoinThreshold": "-1",
             "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
             "spark.sql.adaptive.advisoryPartitionSizeInBytes": "4k",
             "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "4k",
             "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5"}
    pairs = [(5, 10 + i) for i in range(4000)]
    pairs += [(10_000 + 3 * i, 10_001 + 3 * i) for i in range(3000)]
    pairs += [(10_001 + 3 * i, 10_002 + 3 * i) for i in range(0, 3000, 3)] + [(4009, 10_000)]
    before = {k: spark.conf.get(k, None) for k in small}
    for k, v in small.items():
        spark.conf.set(k, v)
    try:
        e = spark.createDataFrame(pairs, "a long, b long")
        got = {r.node: r.component for r in components(e, "a", "b").collect()}
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    want = {}
    for a, b in pairs[4000:-1]:
        want[a] = want.get(a, a)
        want[b] = want[a]
    want |= {v: 5 for v, root in list(want.items()) if root == 10_000}
    want |= {v: 5 for v in (5, *range(10, 4010))}
    assert got == want


def shingle_set(text, n):
    w = text.encode().lower().split()
    k = min(n, len(w))
    return {tuple(w[i:i + k]) for i in range(len(w) - k + 1)} if w else set()


@pytest.mark.parametrize("n,threshold,piece", [(4, 85, 6000), (4, 85, 2), (5, 80, 3)])
def test_jaccard_by_brute_force(spark, n, threshold, piece):
    rng = random.Random(piece)
    rows = []
    for g in range(9):
        base = prose(rng, rng.choice([1, 3, 5, 60, 200, 250])).split()
        for _ in range(9):
            w = list(base)
            for _ in range(rng.randrange(3)):
                w[rng.randrange(len(w))] = f"new{rng.randrange(3)}"
            rows.append((1000 + 100 * g + len(rows), " ".join(w[:len(w) - rng.randrange(3)])))
    rng.shuffle(rows)
    d = documents(spark).select("doc_id", "text", "c", "part").where("doc_id <> 13 or doc_id is null")
    d = d.unionByName(spark.createDataFrame(rows, "doc_id long, text string"),
                      allowMissingColumns=True)
    docs = [(i, shingle_set(t, n)) for i, t in plain(d) if i is not None]
    pairs = [(a, b) for (a, s), (b, t) in combinations(docs, 2)
             if s and t and 100 * len(s & t) >= threshold * len(s | t)]
    want = united([i for i, _ in docs], pairs)
    got = jaccard_join(d, n=n, threshold=threshold, piece_rows=piece, block_bytes=3000).collect()
    assert len(got) == d.count() and len(pairs) > 40
    size = dict(docs)
    for r in got:
        if r.id is None:
            assert r.component_id is None
        else:
            assert (r.n_shingles, r.component_id) == (len(size[r.id]), want[r.id])


def test_jaccard_empty_table(spark):
    assert jaccard_join(empty(spark)).count() == 0


def test_tree_traversal_loses_no_link():
    rng = np.random.default_rng(2)
    base = rng.integers(0, 1 << 62, (30, 80), dtype=np.uint64)
    sets = [np.unique(np.r_[rng.choice(b, 72, replace=False),
                            rng.integers(0, 1 << 62, 4, dtype=np.uint64)])
            for b in base for _ in range(6)]
    ids = list(range(len(sets)))
    linked = [(a, b) for a, b in combinations(ids, 2)
              if 100 * len(np.intersect1d(sets[a], sets[b])) >= 75 * len(np.union1d(sets[a], sets[b]))]
    t = SignatureTree(ids, sets)
    assert len(t.levels) > 2
    assert united(ids, links(t, t, 75)) == united(ids, linked)
    x, y = SignatureTree(ids[:50], sets[:50]), SignatureTree(ids[50:], sets[50:])
    across = [(a, b) for a, b in linked if a < 50 <= b]
    found = united(ids, links(x, y, 75))
    assert found == united(ids, across)


@pytest.mark.parametrize("params", [{}, {"leaf_rows": 20, "sample_rows": 200, "cell_rows": 30}])
def test_embeddings_against_brute_force(spark, params):
    rng = np.random.default_rng(4)
    centre = rng.standard_normal((400, 16))
    x = [c + 0.08 * rng.standard_normal(16) for c in centre for _ in range(int(rng.integers(1, 4)))]
    x += [centre[0] + 0.02 * rng.standard_normal(16) for _ in range(150)] + [x[5]] * 60
    rows = [(i, [float(np.float32(v)) for v in e]) for i, e in enumerate(x)]
    odd = [(90001, None), (90002, [0.0] * 16), (90003, [float("nan")] * 16), (90004, [1.0, None]),
           (90005, [1.0] * 3), (90006, [2.0] * 3), (None, rows[0][1]), (90007, []),
           (90008, [float("inf")] + [0.0] * 15)]
    d = spark.createDataFrame([(i, e, "x", "y") for i, e in rows + odd],
                              "vec_id long, embedding array<float>, id string, code string")
    got = {r.id: r for r in embed_dedup(d, **params).collect()}
    assert len(got) == len(rows) + len(odd)
    m = np.array([e for _, e in rows])
    m /= np.linalg.norm(m, axis=1, keepdims=True)
    near = m @ m.T >= 0.9
    degree = near.sum(1) - 1
    mine = np.array([got[i].n_links for i, _ in rows])
    assert (mine <= degree).all() and mine.sum() >= 0.9 * degree.sum()
    for i in (90001, 90002, 90003, 90004, 90007, 90008):
        assert (got[i].n_links, got[i].component_id, got[i].kept) == (0, i, True)
    assert got[90006].component_id == 90005 and got[90006].n_links == 1
    assert got[None].component_id is None and not got[None].kept
    assert embed_dedup(d.where("false")).count() == 0


def _deep_clustered(rng, n=3000, dims=32):
    """Vectors around one mean (share 0.3 of the variance is left), each third
    with a partner at cosine 0.9 to 0.92."""
    mean = rng.standard_normal(dims)
    mean /= np.linalg.norm(mean)
    x = np.sqrt(0.7) * mean + np.sqrt(0.3 / dims) * rng.standard_normal((n, dims))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    u = rng.standard_normal((n // 3, dims))
    u -= (u * x[:n // 3]).sum(1, keepdims=True) * x[:n // 3]
    u /= np.linalg.norm(u, axis=1, keepdims=True)
    c = rng.uniform(0.901, 0.92, (n // 3, 1))
    return np.vstack([x, c * x[:n // 3] + np.sqrt(1 - c * c) * u])


def test_embeddings_near_the_threshold_in_deep_trees(spark):
    x = _deep_clustered(np.random.default_rng(6))
    d = spark.createDataFrame([(i, [float(np.float32(v)) for v in e]) for i, e in enumerate(x)],
                              "vec_id long, embedding array<float>")
    m = np.array([r.embedding for r in d.sort("vec_id").collect()])
    m /= np.linalg.norm(m, axis=1, keepdims=True)
    degree = (m @ m.T >= 0.9).sum(1) - 1
    got = {r.id: r.n_links for r in embed_dedup(d, trees=2, leaf_rows=32, sample_rows=600).collect()}
    mine = np.array([got[i] for i in range(len(x))])
    assert (mine <= degree).all() and mine.sum() >= 0.9 * degree.sum() > 0


@pytest.mark.parametrize("n", [40, 500])
def test_small_tables_go_through_the_forest(spark, monkeypatch, n):
    from kestrel.llm import embed_dedup as module
    rng = np.random.default_rng(n)
    x = rng.standard_normal((n, 64))
    x[n // 2:] = x[:n - n // 2] + 0.3 * rng.standard_normal((n - n // 2, 64))   # cosine ~0.96
    seen, leaves = [], module._leaves

    def spy(*args):
        got = leaves(*args)
        seen.extend(r["count"] for r in got.where("probe = 0").groupBy("code").count().collect())
        return got

    monkeypatch.setattr(module, "_leaves", spy)
    d = spark.createDataFrame([(i, [float(v) for v in e]) for i, e in enumerate(x)],
                              "vec_id long, embedding array<float>")
    got = {r.id: r.n_links for r in embed_dedup(d).collect()}
    assert len(seen) >= 16 and max(seen) < n              # 8 trees of two leaves or more
    m = np.float32(x).astype(float)
    m /= np.linalg.norm(m, axis=1, keepdims=True)
    degree = (m @ m.T >= 0.9).sum(1) - 1
    mine = np.array([got[i] for i in range(n)])
    assert (mine <= degree).all() and mine.sum() >= 0.9 * degree.sum() > 0


def test_jaccard_pieces_are_cut_by_bytes(spark):
    from kestrel.llm.jaccard_join import _cells
    # one part of 100 sets of 8 MB, and 3,000 parts of one set of 32 MB
    large = spark.createDataFrame([(i, -1, 1_000_000) for i in range(100)],
                                  "c long, part long, size long")
    small = spark.createDataFrame([(i, i, 4_000_000) for i in range(1000, 4000)],
                                  "c long, part long, size long")
    got = _cells(large.unionByName(small), 80, 6000).collect()
    sides = {}
    for r in got:
        if r.part == -1:
            sides.setdefault(r.piece, set()).add(r.c)
    assert len(sides) > 1 and max(map(len, sides.values())) * 8e6 < 400e6
    pairs = {}
    for r in got:
        if r.part == -1:
            pairs.setdefault((r.i, r.j), set()).add(r.c)
    met = {(a, b) for s in pairs.values() for a in s for b in s}
    assert len(met) == 100 * 100                          # every pair meets in a cell
    assert len({r.deal for r in got if r.part != -1}) > 512
