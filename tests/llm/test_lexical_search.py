"""The ranked search against brute force over all documents and items."""

import math
import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from kestrel.llm import lexical_search as L
from tests.llm.common import documents, empty, prose

ITEMS = "item_id long, text string"
UPPER = {c: c + 32 for c in range(65, 91)}


def split(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", (text or "").translate(UPPER))


def brute(docs, items, k):
    """Rows (item row, rank, id, score) by scoring everything."""
    tf = [(i, Counter(split(t))) for i, t in docs]
    sizes = [sum(c.values()) for _, c in tf]
    n, total = sum(s > 0 for s in sizes), sum(sizes)
    df = Counter(t for _, c in tf for t in c)
    out = []
    for name, text in items:
        scored = []
        for (i, c), size in zip(tf, sizes, strict=True):
            s = 0
            for t, times in Counter(split(text)).items():
                if c[t]:
                    w = math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1)))
                    m = 75 + 25 * size * n // total
                    s += times * w * (10 ** 9 * c[t] // (1000 * c[t] + 12 * m))
            if s > 0:
                scored.append((-s, i is None, i or 0))
        out += [(name, r, None if none else i, -s)
                for r, (s, none, i) in enumerate(sorted(scored)[:k], 1)]
    return out


def test_search_of_edge_rows_equals_brute_force(spark):
    rng = random.Random(8)
    docs = documents(spark)
    rows = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    items = [(n, prose(rng, rng.choice((1, 3, 30)))) for n in range(12)]
    items += [(20, None), (21, ""), (22, "nowhere"), (23, "same SAME"), (24, rows[0][1]),
              (25, "ünï 漢字"), (25, "one two"), (None, "one three"), (26, "1234-aaa")]
    frame = spark.createDataFrame(items, ITEMS).withColumn("score", F.lit("x"))
    for k, block, bucket in ((20, 5000, 4096), (3, 4, 2)):
        got = L.lexical_search(docs.repartition(3), frame, k=k, block_items=block,
                               bucket_rows=bucket).collect()
        assert sorted(map(str, map(tuple, got))) == sorted(map(str, brute(rows, items, k)))
    assert L.lexical_search(empty(spark), frame).count() == 0
    assert L.lexical_search(docs, frame.where(F.lit(False))).count() == 0


def test_ids_of_strings_and_many_ties(spark):
    rng = random.Random(2)
    text = prose(rng, 40)
    rows = [(f"é{n:03}", text) for n in range(300)] + [("a", prose(rng, 50)), (None, text)]
    d = spark.createDataFrame(rows, "doc_id string, text string")
    items = [(1, text[:60]), (2, rows[300][1])]
    got = L.lexical_search(d.repartition(4), spark.createDataFrame(items, ITEMS), k=5,
                           bucket_rows=64, seeds=0.2).collect()
    want = []
    for name, t in items:                      # brute force needs comparable ids
        number = {i: n for n, i in enumerate(sorted(i for i, _ in rows if i))}
        back = {n: i for i, n in number.items()}
        want += [(q, r, back.get(i), s) for q, r, i, s in brute(
            [(number.get(i), x) for i, x in rows], [(name, t)], 5)]
    assert sorted(map(str, map(tuple, got))) == sorted(map(str, want))


@pytest.mark.parametrize("seed", range(6))
def test_bucket_bounds_lose_nothing(seed):
    rng = np.random.default_rng(seed)
    found = [np.sort(rng.choice(60, rng.integers(1, 30), replace=False)) for _ in range(500)]
    values = [(rng.pareto(1.2, len(f)) * 1000 + 1).astype(np.int64) for f in found]
    lengths = [math.sqrt((v.astype(float) ** 2).sum()) for v in values]
    order = np.argsort(lengths)[::-1]
    found, values = [found[i] for i in order], [values[i] for i in order]
    bucket = L.Bucket([lengths[i] for i in order], found, values)
    looked = 0
    for _ in range(40):
        query = rng.choice(80, rng.integers(1, 12), replace=False)
        counts = rng.integers(1, 4, len(query))
        exact = np.array([sum(int(c) * int(v[f == t][0]) for t, c in zip(query, counts)
                              if t in f) for f, v in zip(found, values)])
        length = math.sqrt((counts.astype(float) ** 2).sum())
        for least in (0, int(np.sort(exact)[-20]), int(exact.max()), int(exact.max()) + 1):
            rows, scores = bucket.candidates(query, counts, length, least)
            want = np.flatnonzero(exact >= max(least, 1))
            assert rows.tolist() == want.tolist() and scores.tolist() == exact[want].tolist()
            looked += len(rows)
    assert looked


def test_long_texts_are_cut_between_terms(monkeypatch):
    text = prose(random.Random(1), 3000) + " É" * 50 + "x" * 5000
    whole = Counter(w.encode() for w in split(text))
    for size in (1, 7, 100, 1 << 20):
        monkeypatch.setattr(L, "SLICE", size)
        assert L.count_terms(text) == whole
