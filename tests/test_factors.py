"""The fit on packed blocks against plain least squares, for any blocks and ids."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from kestrel.operators import factors, ml


def _ratings():
    rnd = random.Random(5)
    rows = [(u, i, float(rnd.randint(1, 9))) for u in range(25) for i in range(12) if rnd.random() < 0.5]
    return rows + [(3, 4, 2.0), (3, 4, 7.0)] + [(30, i, 5.0) for i in range(12) for _ in range(9)]


def _plain(rows, of_users, rank, max_iter, reg):
    u, i, r = (np.array(x) for x in zip(*rows))
    r = r.astype(float)

    def step(x, y, known):
        out = np.zeros((x.max() + 1, rank), np.float32)
        for k in np.unique(x):
            a = known[y[x == k]].astype(float)
            out[k] = np.linalg.solve(a.T @ a + reg * len(a) * np.eye(rank), a.T @ r[x == k])
        return out

    for _ in range(max_iter):
        of_items = step(i, u, of_users)
        of_users = step(u, i, of_items)
    return of_users, of_items


@pytest.mark.parametrize("blocks", [1, 3, 7])
def test_fit_equals_plain_least_squares(spark, monkeypatch, blocks):
    monkeypatch.setattr(factors, "CHUNK_RATINGS", 50)
    monkeypatch.setattr(factors, "CHECKPOINT_INTERVAL", 2)
    rows = _ratings()
    df = spark.createDataFrame([(u - 7, i + 2 ** 40, r) for u, i, r in rows],
                               "user_id long, item_id long, rating double")
    monkeypatch.setattr(ml, "dense_ids", None)           # ids without gaps are not numbered anew
    start = np.zeros((31, 4), np.float32)
    near = df.withColumn("item_id", F.col("item_id") - 2 ** 40)
    for r in ml.als_model(near, 4, 0, seed=9, blocks=blocks).userFactors.collect():
        start[r.id + 7] = r.features
    want_users, want_items = _plain(rows, start, 4, 5, ml.ALS_REG)
    model = ml.als_model(near, 4, 5, seed=9, blocks=blocks)
    users, items = ml.als_factors(df, rank=4, max_iter=5, seed=9, blocks=blocks)
    for got, want, spark_ml, first in ((users, want_users, model.userFactors, -7),
                                       (items, want_items, model.itemFactors, 2 ** 40)):
        got = {r.id - first: r.features for r in got.collect()}
        same = {r.id + 7 * (first < 0): r.features for r in spark_ml.collect()}
        assert got.keys() == same.keys()
        assert all(np.allclose(f, want[k], rtol=1e-3, atol=1e-3) for k, f in got.items())
        assert all(np.allclose(f, same[k], rtol=1e-3, atol=1e-3) for k, f in got.items())


def test_chunks_stay_where_they_are(spark):
    df = spark.createDataFrame(_ratings(), "user int, item int, r float")
    by_user = factors._chunks(df, "user", "item", 200, 3)
    by_item = factors._chunks(df, "item", "user", 200, 3)
    assert by_user.union(by_item).getNumPartitions() == 3


def test_rows_of_very_many_ratings_are_added_up_in_pieces(monkeypatch):
    from concurrent.futures import ThreadPoolExecutor
    rng = np.random.default_rng(2)
    size, known = np.array([3, 3, 40, 90], np.int32), rng.normal(size=(30, 4)).astype(np.float32)
    y, r = rng.integers(0, 30, 136).astype(np.int32), rng.normal(size=136).astype(np.float32)
    with ThreadPoolExecutor(2) as pool:
        want = factors._solved(size, y, r, known, 0.1, pool)
        monkeypatch.setattr(factors, "SOLVED_RATINGS", 16)
        monkeypatch.setattr(factors, "SOLVED_ROWS", 2)
        assert np.allclose(factors._solved(size, y, r, known, 0.1, pool), want, atol=1e-5)


@pytest.mark.parametrize("bad", [None, float("nan"), float("inf")])
def test_ratings_that_are_no_numbers_are_an_error(spark, bad):
    df = spark.createDataFrame([(1, 1, 2.0), (1, 2, bad)], "user_id long, item_id long, rating double")
    with pytest.raises(Exception, match="MUST NOT be null"):
        ml.als_factors(df, max_iter=1)


def test_ids_with_gaps_are_numbered(spark, monkeypatch):
    monkeypatch.setattr(ml, "ALS_CODES", 10)
    df = spark.createDataFrame([(u * 10 ** 9, i, float(u + i)) for u in range(6) for i in range(5)],
                               "user_id long, item_id long, rating double")
    users, items = ml.als_factors(df, max_iter=2)
    assert {r.id for r in users.collect()} == {u * 10 ** 9 for u in range(6)}
    assert items.agg(F.sum("id")).first()[0] == 10
