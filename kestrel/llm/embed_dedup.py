"""Embedding near-dedup by a forest of random-projection trees.

Every tree splits the vectors by random directions at the median, again and
again; vectors close to a split go to both sides (spill overlap). Vectors
are compared within the leaves, pairs at or above the threshold are links,
and links are united to components.

Trees lose more pairs the deeper they are, so their number follows from a
measurement: the share of pairs that meet in a leaf, for partners planted at
the threshold and for the links of a query set, found by comparing it with
all vectors. Trees are added until both shares reach ``recall``. Tables of all
sizes go through the forest: a leaf has about ``4 * sqrt(rows)`` rows, 32 at
least and ``leaf_rows`` at most.

The trees are fitted on a bounded sample (``sample_rows`` vectors, and again
as many of each leaf that is still too large), every vector is routed. A leaf
that cannot be split, because its vectors are all alike, is compared in
blocks, so that no task holds it whole. A pair that meets in several leaves
counts in the smallest leaf number that both share; so counts are summed
without listing pairs. Equal vectors are one vector with a multiplicity.

Defined results: a null, zero or non-finite vector, or one with a null
component, links with nothing; vectors of different lengths don't link; a row
with a null id gets no links and no component; repeated rows count as
vectors of their own that link; other columns are ignored; empty table,
empty result. Pairs are found with a probability (see README for the
recall); none below the threshold is linked.
"""

from __future__ import annotations

import math
import pickle
from collections import Counter

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from kestrel.llm.components import components
from kestrel.session import materialize


# ---------------------------------------------------------------- the trees

def unit(vectors) -> np.ndarray:
    x = np.array([np.asarray(v, np.float64) for v in vectors])
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def fit_tree(x: np.ndarray, leaf: int, margin: float, rng) -> list:
    """Nodes (direction, median, left, right); None is a leaf. A node that a
    split leaves nearly whole on either side is a leaf."""
    nodes: list = [None]
    todo = [(0, np.arange(len(x)))]
    while todo:
        node, rows = todo.pop()
        if len(rows) <= leaf:
            continue
        for _ in range(3):                       # a few directions to choose from
            d = rng.standard_normal(x.shape[1])
            d /= np.linalg.norm(d)
            p = x[rows] @ d
            cut = float(np.median(p))
            left, right = rows[p <= cut + margin], rows[p >= cut - margin]
            if max(len(left), len(right)) <= 0.85 * len(rows):
                break
        else:
            continue
        nodes[node] = (d, cut, len(nodes), len(nodes) + 1)
        todo += [(len(nodes), left), (len(nodes) + 1, right)]
        nodes += [None, None]
    return nodes


def route(x: np.ndarray, nodes: list, margin: float):
    """(row, leaf) pairs; a row near a split goes both ways."""
    todo = [(0, np.arange(len(x)))]
    while todo:
        node, rows = todo.pop()
        if not len(rows):
            continue
        if nodes[node] is None:
            for r in rows.tolist():
                yield r, node
            continue
        d, cut, a, b = nodes[node]
        p = x[rows] @ d
        todo += [(a, rows[p <= cut + margin]), (b, rows[p >= cut - margin])]


def _leaf_code(parent: int, tree: int, leaf: int) -> int:
    return xxhash.xxh3_64_intdigest(f"{parent}/{tree}/{leaf}") >> 1


# ------------------------------------------------------- comparing in leaves

def _leaf_links(threshold: float):
    """One cell of a leaf -> (id, links found here, id that it is tied to)."""
    def run(rows: pd.DataFrame) -> pd.DataFrame:
        code, (i, j) = rows["code"].iat[0], (rows["i"].iat[0], rows["j"].iat[0])
        rows = rows.sort_values("id")
        x, block = unit(rows["vector"]), rows["block"].to_numpy()

        def near(at):
            """Links of 512 rows in this cell."""
            part = slice(at, min(at + 512, len(x)))
            got = x[part] @ x.T >= threshold
            got[np.arange(part.stop - at), np.arange(at, part.stop)] = False
            return got if i == j else got & (block[part, None] != block[None, :])

        some = np.concatenate([near(at).any(axis=1) for at in range(0, len(x), 512)])
        rows, x, block = rows[some], x[some], block[some]       # the others link with nothing
        n, ids, m = len(rows), rows["id"].to_numpy(), rows["copies"].to_numpy()
        earlier = [[c for c in cs if c < code] for cs in rows["codes"]]
        times = Counter(c for cs in earlier for c in cs)
        names = {c: k for k, c in enumerate(sorted(c for c, t in times.items() if t > 1))}
        held = [(r, names[c]) for r, cs in enumerate(earlier) for c in cs if c in names]
        held = np.array(held, np.int64).reshape(-1, 2)

        def met(at):
            """Whether 512 rows share an earlier leaf with the others."""
            out = np.zeros((min(at + 512, n) - at, n), bool)
            for k in range(0, len(names), 2048):
                h = held[(held[:, 1] >= k) & (held[:, 1] < k + 2048)]
                seen = np.zeros((n, min(2048, len(names) - k)), np.float32)
                seen[h[:, 0], h[:, 1] - k] = 1
                out |= seen[at:at + 512] @ seen.T > 0
            return out

        counts, label = np.zeros(n, np.int64), np.arange(n)
        for at in range(0, n, 512):
            links = near(at)
            counts[at:at + 512] = (links & ~met(at)) @ m
            for r, row in enumerate(links, at):
                tied = np.flatnonzero(row[:r])
                if len(tied):
                    old = np.unique(label[np.r_[tied, r]])
                    if len(old) > 1:
                        label[np.isin(label, old)] = old[0]
        linked = (counts > 0) | (label != np.arange(n))
        return pd.DataFrame({"id": ids[linked], "n": counts[linked], "tie": ids[label[linked]]})
    return run


# ------------------------------------------------------------- the operator

def _leaves(every: DataFrame, x: np.ndarray, n: int, trees: range, draw, margin: float,
            leaf_rows: int, seed: int, rounds: int) -> DataFrame:
    """(id, probe, code): the leaves of these trees, fitted on ``x``, that each
    row of ``every`` (id, probe, vector) falls into. Planted rows (probe 1) are
    routed only."""
    spark = every.sparkSession
    leaf = max(24, int(leaf_rows * len(x) / max(n, 1)))
    forest = spark.sparkContext.broadcast(
        [(t, fit_tree(x, leaf, margin, np.random.default_rng([seed, t]))) for t in trees])

    def route_all(batches):
        for b in batches:
            v, out = unit(b["vector"]) if len(b) else [], []
            ids, probe = b["id"].tolist(), b["probe"].tolist()
            for t, nodes in forest.value if len(b) else ():
                names: dict = {}
                for r, at in route(v, nodes, margin):
                    if at not in names:
                        names[at] = _leaf_code(0, t, at)
                    out.append((ids[r], probe[r], names[at]))
            yield pd.DataFrame(out, columns=["id", "probe", "code"])

    made = "id long, probe int, code long"
    assign = materialize(every.mapInPandas(route_all, made), "leaves")
    fresh = assign
    for _ in range(rounds):                    # leaves that are still too large
        large = fresh.where("probe = 0").groupBy("code").agg(
            F.count(F.lit(1)).alias("rows")).where(F.col("rows") > 4 * leaf_rows)
        if large.isEmpty():
            break
        part = assign.join(large, "code").join(every, ["id", "probe"])

        def refit(rows: pd.DataFrame) -> pd.DataFrame:
            v, code = unit(rows["vector"]), int(rows["code"].iat[0])
            least = max(24, int(leaf_rows * len(v) / max(int(rows["rows"].iat[0]), 1)))
            nodes = fit_tree(v, least, margin, np.random.default_rng(code))
            return pd.DataFrame({"code": [code], "split": [len(nodes) > 1],
                                 "tree": [pickle.dumps(nodes)]})

        subtrees = materialize(
            part.where((F.col("probe") == 0) & draw(F.col("rows")))
            .select("code", "rows", "vector")
            .groupBy("code").applyInPandas(refit, "code long, split boolean, tree binary")
            .where("split"), "subtrees")

        def route_part(batches):
            for b in batches:
                out = []
                for code, g in b.groupby("code"):
                    nodes = pickle.loads(g["tree"].iat[0])
                    ids, probe = g["id"].tolist(), g["probe"].tolist()
                    out += [(ids[r], probe[r], _leaf_code(code, 0, at))
                            for r, at in route(unit(g["vector"]), nodes, margin)]
                yield pd.DataFrame(out, columns=["id", "probe", "code"])

        fresh = materialize(
            part.join(subtrees, "code").select("code", "id", "probe", "vector", "tree")
            .mapInPandas(route_part, made), "leaves")
        assign = materialize(assign.join(subtrees.select("code"), "code", "left_anti")
                             .select("id", "probe", "code").unionByName(fresh), "leaves")
    return assign


def _partners(threshold: float, seed: int):
    """Planted partners: one vector at the threshold for each vector."""
    t = min(1.0, max(-1.0, threshold))

    def run(batches):
        for b in batches:
            out = []
            for i, x in zip(b["id"], unit(b["vector"]) if len(b) else [], strict=True):
                u = np.random.default_rng([seed, int(i) % (1 << 63)]).standard_normal(len(x))
                u -= (u @ x) * x
                size = np.linalg.norm(u)
                out.append(t * x + math.sqrt(1 - t * t) * u / size if size > 1e-9 else x)
            yield pd.DataFrame({"id": b["id"], "probe": 1, "vector": out})
    return run


def _query_links(ids: np.ndarray, q: np.ndarray, threshold: float, most: int = 16):
    """Links of the queries, for each the ``most`` nearest to the threshold."""
    def run(batches):
        kept = np.zeros((0, 3))                  # query, place in ``other``, cosine
        other = np.zeros(0, np.int64)
        for b in batches:
            for at in range(0, len(b), 1024):
                part = b.iloc[at:at + 1024]
                cos, own = unit(part["vector"]) @ q.T, part["id"].to_numpy()
                r, k = np.nonzero((cos >= threshold) & (own[:, None] != ids[None, :]))
                kept = np.vstack([kept, np.column_stack(
                    [k, np.arange(len(r)) + len(other), cos[r, k]])])
                other = np.r_[other, own[r]]
                order = np.lexsort((kept[:, 2], kept[:, 0]))
                kept = kept[order]
                first = np.searchsorted(kept[:, 0], kept[:, 0])
                kept = kept[np.arange(len(kept)) - first < most]
                other = other[kept[:, 1].astype(np.int64)]
                kept[:, 1] = np.arange(len(kept))
        yield pd.DataFrame({"a": ids[kept[:, 0].astype(np.int64)], "b": other, "cos": kept[:, 2]})
    return run


def _one_length(reps: DataFrame, dims: int, threshold, trees, leaf_rows, cell_rows,
                sample_rows, spill, seed, rounds, recall, query_rows):
    """(id, n) link counts and (id, tie) edges among distinct vectors."""
    spark = reps.sparkSession
    n = reps.count()
    # half the typical difference of a threshold pair along one direction
    margin = spill * float(np.sqrt(max(0.0, 2 - 2 * threshold) / dims))
    leaf_rows = min(leaf_rows, max(32, math.ceil(4 * math.sqrt(n))))

    def draw(rows, most=sample_rows, salt=seed):
        """Hash sample of about ``most`` of so many rows."""
        u = F.pmod(F.xxhash64(F.lit(salt), "id"), F.lit(1 << 30)) / F.lit(float(1 << 30))
        return u < F.least(F.lit(1.0), F.lit(float(most)) / rows)

    def forest():
        """(id, code) of as many trees as the recall takes."""
        queries = reps.where(draw(F.lit(n), query_rows, f"queries {seed}")).select("id", "vector")
        if queries.isEmpty():                        # the hash drew none of a few rows
            queries = reps.select("id", "vector").orderBy("id").limit(1)
        asked = queries.collect()                                        # bounded
        planted = queries.mapInPandas(_partners(threshold, seed),
                                      "id long, probe int, vector array<double>")
        every = materialize(reps.select("id", F.lit(0).alias("probe"),
                                        F.col("vector").cast("array<double>"))
                            .unionByName(planted), "vectors")
        near = reps.select("id", "vector").mapInPandas(
            _query_links(np.array([r["id"] for r in asked]), unit([r["vector"] for r in asked]),
                         threshold), "a long, b long, cos double")
        rank = F.row_number().over(Window.partitionBy("a").orderBy("cos", "b"))
        near = materialize(near.withColumn("rank", rank).where("rank <= 16").select("a", "b"),
                           "query-links")
        linked = near.count()
        sample = [r["vector"] for r in reps.where(draw(F.lit(n))).select("vector").collect()]
        if not sample:
            sample = [r["vector"] for r in reps.select("vector").limit(sample_rows).collect()]
        x, assign, total, more = unit(sample), None, 0, trees
        while True:
            got = _leaves(every, x, n, range(total, total + more), draw, margin, leaf_rows, seed,
                          rounds)
            assign, total = got if assign is None else assign.unionByName(got), total + more
            real = assign.where("probe = 0").select("id", "code")
            met = (assign.where("probe = 1").select("id", "code").join(real, ["id", "code"])
                   .select("id").distinct().count())
            share = met / len(asked)
            if linked:
                mine = near.join(real.select(F.col("id").alias("a"), "code"), "a")
                met = mine.join(real.select(F.col("id").alias("b"), "code"),
                                ["b", "code"]).select("a", "b").distinct().count()
                share = min(share, met / linked)
            if share >= recall:
                return real
            want = 2 * total
            if share > 0:
                want = min(want, math.ceil(total * math.log(1 - recall) / math.log(1 - share)))
            more = max(want, total + 1) - total

    if recall >= 1:                              # asked for: all pairs, in cells
        assign = reps.select("id", F.lit(0).cast("long").alias("code"))
    else:
        assign = forest()
    counts = assign.groupBy("code").agg(F.count(F.lit(1)).alias("rows"))
    large = counts.where(F.col("rows") > cell_rows).select(
        "code", F.ceil(F.col("rows") / cell_rows).cast("int").alias("k"))
    codes = assign.groupBy("id").agg(F.collect_list("code").alias("codes"))
    rows = reps.join(codes, "id").withColumn("code", F.explode("codes"))
    rows = rows.join(large, "code", "left").withColumn("k", F.coalesce("k", F.lit(1)))
    rows = rows.withColumn("block", F.pmod(F.xxhash64("id"), F.col("k")).cast("int"))
    cells = rows.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("k") - 1))).select(
        "code", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"),
        "block", "id", "copies", "vector", "codes")
    return materialize(cells.groupBy("code", "i", "j").applyInPandas(
        _leaf_links(threshold), "id long, n long, tie long"), "leaf-links")


def embed_dedup(vectors: DataFrame, *, threshold: float = 0.9, trees: int = 8,
                leaf_rows: int = 512, cell_rows: int = 4096, sample_rows: int = 20_000,
                spill: float = 0.3, seed: int = 5, rounds: int = 8,
                recall: float = 0.95, query_rows: int = 1000, id_col: str = "vec_id",
                vector_col: str = "embedding") -> DataFrame:
    """One row per input row: id, n_links, component_id, kept. ``trees`` is the
    number to start with; ``recall`` 1 compares all pairs, the only way to do so."""
    v = vectors.select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).alias("vector"))
    big = F.transform("vector", lambda c: c.cast("double"))
    finite = F.forall(big, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    some = F.exists(big, lambda c: c != 0)
    ok = F.coalesce(finite & some, F.lit(False)) & F.col("id").isNotNull()
    good = v.where(ok)
    same = good.groupBy("vector").agg(F.min("id").alias("rep"), F.count(F.lit(1)).alias("copies"))
    same = materialize(same, "distinct-vectors")
    members = materialize(good.join(same, "vector").select("id", "rep", "copies"), "members")
    found = None
    lengths = same.groupBy(F.size("vector").alias("dims")).agg(F.count(F.lit(1)).alias("n"))
    for r in lengths.collect():                  # vectors of one table have few lengths
        reps = same.where(F.size("vector") == r["dims"]).select(
            F.col("rep").alias("id"), "copies", "vector")
        got = _one_length(reps, r["dims"], threshold, trees, leaf_rows, cell_rows, sample_rows,
                          spill, seed, rounds, recall, query_rows)
        found = got if found is None else found.unionByName(got)
    if found is None:
        links = v.sparkSession.createDataFrame([], "rep long, n long")
        joined = v.sparkSession.createDataFrame([], "rep long, component long")
    else:
        links = found.groupBy(F.col("id").alias("rep")).agg(F.sum("n").alias("n"))
        joined = components(found, "id", "tie").withColumnRenamed("node", "rep")
    linked = (members.join(links, "rep", "left").join(joined, "rep", "left")
              .select("id", (F.coalesce("n", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
                      F.coalesce("component", "rep").alias("component_id")))
    alone = v.where(~ok).select("id", F.lit(0).cast("long").alias("n_links"),
                                F.col("id").alias("component_id"))
    return linked.unionByName(alone).withColumn(
        "kept", F.coalesce(F.col("id") == F.col("component_id"), F.lit(False)))
