"""Windowed tags (batch = stream, D8) and the ML operators."""

import datetime as dt
import os

from pyspark.ml.feature import VectorAssembler

from kestrel.operators import ml
from kestrel.streaming import tags


def _messages(spark):
    base = dt.datetime(2024, 1, 1, 0, 0, 0)
    rows = [
        (base + dt.timedelta(seconds=0), "hi #spark #spark"),
        (base + dt.timedelta(seconds=10), "#spark on a slide boundary"),
        (base + dt.timedelta(seconds=300), "#end at a window end #Spark"),
        (base + dt.timedelta(seconds=612, microseconds=5), "bare # and #x"),
        (base + dt.timedelta(seconds=45), "no tags here"),
    ]
    return spark.createDataFrame(rows, "ts timestamp_ntz, text string")


def _brute(msgs, length=300, slide=10):
    out = {}
    for ts, text in msgs:
        secs = int(ts.timestamp()) if ts.tzinfo else int((ts - dt.datetime(1970, 1, 1)).total_seconds())
        for tok in text.split(" "):
            if not tok.startswith("#"):
                continue
            first = secs - secs % slide
            for k in range(length // slide):
                start = first - k * slide
                key = (start, tok)
                out[key] = out.get(key, 0) + 1
    return out


def test_window_counts_match_brute_force(spark):
    df = _messages(spark)
    got = tags.window_tag_counts(df).collect()
    epoch = dt.datetime(1970, 1, 1)
    g = {(int((r.window_start - epoch).total_seconds()), r.tag): r.cnt for r in got}
    want = _brute([(r.ts, r.text) for r in df.collect()])
    assert g == want
    n_tags = sum(1 for r in df.collect() for t in r.text.split(" ") if t.startswith("#"))
    assert sum(g.values()) == 30 * n_tags
    for r in got:
        assert (r.window_end - r.window_start).total_seconds() == 300


def test_stream_equals_batch(spark, tmp_dir):
    df = _messages(spark)
    src_dir = os.path.join(tmp_dir, "in")
    df.write.parquet(src_dir)
    stream = spark.readStream.schema(df.schema).parquet(src_dir)
    out = os.path.join(tmp_dir, "out")
    q = tags.run_trending_stream(stream, out, os.path.join(tmp_dir, "ck"),
                                 watermark="1 day", trigger={"availableNow": True},
                                 top_dir=os.path.join(tmp_dir, "top"), top=2)
    q.awaitTermination()
    s = sorted(tuple(r) for r in tags.read_trending_table(spark, out).collect())
    b = sorted(tuple(r) for r in tags.window_tag_counts(df).collect())
    assert s == b
    top = sorted(tuple(r) for r in tags.read_top_table(spark, os.path.join(tmp_dir, "top")).collect())
    assert top == sorted(tuple(r) for r in tags.top_tags(tags.window_tag_counts(df), 2).collect())


def test_top_tags_rank_every_window_over_micro_batches(spark, tmp_dir):
    """Two files, one micro-batch each: the second changes one tag of the
    first's windows; the others keep their counts in the ranking."""
    at = dt.datetime(2024, 1, 1, 12, 0, 3)
    schema = "ts timestamp_ntz, text string"
    src, out, top = (os.path.join(tmp_dir, x) for x in ("in", "out", "top"))
    files = [[(at, "#big")] * 5 + [(at, "#mid")] * 3 + [(at, "#low")], [(at, "#low")] * 3]
    for rows in files:
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(src)
        stream = spark.readStream.schema(schema).parquet(src)
        tags.run_trending_stream(stream, out, os.path.join(tmp_dir, "ck"), watermark="1 day",
                                 trigger={"availableNow": True}, top_dir=top,
                                 top=2).awaitTermination()
    want = tags.top_tags(tags.window_tag_counts(spark.read.parquet(src)), 2).collect()
    assert len(want) == 60 and {(r.tag, r.cnt) for r in want} == {("#big", 5), ("#low", 4)}
    got = tags.read_top_table(spark, top).collect()
    assert sorted(map(tuple, got)) == sorted(map(tuple, want))


def test_events_table_of_several_files_streams_like_the_batch(spark, tmp_dir):
    from kestrel.plans import catalog
    ev = spark.read.parquet("/root/testdata/sf0.001/events.parquet")
    ev.repartition(3).write.parquet(os.path.join(tmp_dir, "events.parquet"))
    s = sorted(map(tuple, catalog.stream_trending_tags(spark, tmp_dir).collect()))
    assert s == sorted(map(tuple, catalog.window_trending_tags(spark, tmp_dir).collect()))


def test_ridge_is_the_exact_penalised_solution(spark):
    rows = [(0.5 * x + (0.1 if x % 2 else -0.1), float(x)) for x in range(-10, 11)]
    df = spark.createDataFrame(rows, "label double, x double")
    data = VectorAssembler(inputCols=["x"], outputCol="features").transform(df)
    w = ml.ridge_fit(data, reg=0.01).coefficients[0]
    n = len(rows)
    sxy = sum(y * x for y, x in rows) / n
    sxx = sum(x * x for _, x in rows) / n
    assert abs(w - sxy / (sxx + 0.01)) < 1e-9


def test_split_by_key_is_deterministic_and_complete(spark):
    df = spark.range(100).withColumnRenamed("id", "k")
    tr, te = ml.split_by_key(df, "k")
    assert tr.count() + te.count() == 100
    assert tr.join(te, "k").count() == 0
    a, _ = ml.random_split(df, seed=3)
    b, _ = ml.random_split(df, seed=3)
    assert sorted(r.k for r in a.collect()) == sorted(r.k for r in b.collect())


def test_als_recommend_shape_and_repeatability(spark):
    rows = [(u, i, float((u * 7 + i * 3) % 5 + 1)) for u in range(20) for i in range(15) if (u + i) % 3]
    df = spark.createDataFrame(rows, "user_id long, item_id long, rating double")
    a = ml.als_recommend(df, 4, k=5, max_iter=5)
    b = ml.als_recommend(df, 4, k=5, max_iter=5)
    ra = [(r.item_id, round(r.rating, 5)) for r in a.orderBy("rank").collect()]
    rb = [(r.item_id, round(r.rating, 5)) for r in b.orderBy("rank").collect()]
    assert len(ra) == 5 and ra == rb
    ranked = a.orderBy("rank").collect()
    assert [r.rank for r in ranked] == [1, 2, 3, 4, 5]
    assert all(x.rating >= y.rating for x, y in zip(ranked, ranked[1:]))
    assert len({r.item_id for r in ranked}) == 5
    assert "CartesianProduct" not in a._jdf.queryExecution().toString()
    assert ml.als_recommend(df, 99, k=5, max_iter=2).count() == 0     # no ratings, no rows


def test_hash_split_follows_its_fraction_and_seed(spark):
    df = spark.range(4000).withColumnRenamed("id", "k")
    tr, te = ml.split_by_key(df, "k", 0.8)
    assert 3050 < tr.count() < 3350 and tr.count() + te.count() == 4000
    other, _ = ml.split_by_key(df, "k", 0.8, seed=7)
    assert other.join(tr, "k").count() < tr.count()
    assert ml.split_by_key(df, "k", 1.0)[0].count() == 4000


def test_stream_restarts_from_checkpoint(spark, tmp_dir):
    """T5: a second run on the same checkpoint processes only the new file,
    and the merged sink table equals the batch result over both files."""
    df = _messages(spark)
    later = spark.createDataFrame(
        [(dt.datetime(2024, 1, 1, 0, 0, 20), "#spark again"),
         (dt.datetime(2024, 1, 1, 0, 4, 0), "#x #new")], "ts timestamp_ntz, text string")
    src_dir = os.path.join(tmp_dir, "in")
    df.write.parquet(os.path.join(src_dir, "part1"))
    schema = df.schema
    out, ck = os.path.join(tmp_dir, "out"), os.path.join(tmp_dir, "ck")

    def run():
        stream = spark.readStream.schema(schema).option("recursiveFileLookup", "true").parquet(src_dir)
        tags.run_trending_stream(stream, out, ck, trigger={"availableNow": True},
                                 watermark="1 day").awaitTermination()

    run()
    first_batches = spark.read.parquet(out).select("batch_id").distinct().count()
    later.write.parquet(os.path.join(src_dir, "part2"))
    run()
    assert spark.read.parquet(out).select("batch_id").distinct().count() > first_batches
    got = sorted(tuple(r) for r in tags.read_trending_table(spark, out).collect())
    want = sorted(tuple(r) for r in tags.window_tag_counts(df.unionByName(later)).collect())
    assert got == want


def test_elastic_net_zeroes_weight_under_large_penalty(spark):
    rows = [(float(x % 3), float(x)) for x in range(60)]
    df = spark.createDataFrame(rows, "label double, x double")
    data = VectorAssembler(inputCols=["x"], outputCol="features").transform(df)
    m = ml.elastic_net_fit(data, reg=100.0)
    assert m.coefficients[0] == 0.0
    assert abs(m.intercept - sum(r[0] for r in rows) / len(rows)) < 1e-9


def test_ridge_with_constant_feature(spark):
    rows = [(float(y), 2.0) for y in range(10)]
    df = spark.createDataFrame(rows, "label double, x double")
    data = VectorAssembler(inputCols=["x"], outputCol="features").transform(df)
    w = ml.ridge_fit(data, reg=0.01).coefficients[0]
    n = len(rows)
    assert abs(w - (sum(2.0 * y for y, _ in rows) / n) / (4.0 + 0.01)) < 1e-9


def test_stream_drops_events_behind_the_watermark(spark, tmp_dir):
    """An event older than the watermark (max event time - delay) that
    arrives in a later micro-batch no longer updates closed windows."""
    base = dt.datetime(2024, 1, 1, 1, 0, 0)
    first = spark.createDataFrame([(base, "#a"), (base + dt.timedelta(hours=1), "#a")],
                                  "ts timestamp_ntz, text string")
    late = spark.createDataFrame([(base - dt.timedelta(minutes=30), "#late")],
                                 "ts timestamp_ntz, text string")
    src_dir = os.path.join(tmp_dir, "in")
    first.write.parquet(os.path.join(src_dir, "p1"))
    out, ck = os.path.join(tmp_dir, "out"), os.path.join(tmp_dir, "ck")

    def run():
        stream = spark.readStream.schema(first.schema).option("recursiveFileLookup", "true").parquet(src_dir)
        tags.run_trending_stream(stream, out, ck, trigger={"availableNow": True},
                                 watermark="10 minutes").awaitTermination()

    run()
    late.write.parquet(os.path.join(src_dir, "p2"))
    run()
    got = {r.tag for r in tags.read_trending_table(spark, out).collect()}
    assert got == {"#a"}


def test_ids_beyond_32_bits_and_of_strings(spark):
    rows = [(u, i, float((u * 7 + i * 3) % 5 + 1)) for u in range(20) for i in range(15) if (u + i) % 3]
    far = spark.createDataFrame([(u + 2 ** 40, f"item {i:02}", r) for u, i, r in rows] + [
        (None, "item 00", 1.0)], "user_id long, item_id string, rating double")
    users, items = ml.als_factors(far, max_iter=5)
    assert {r.id for r in users.collect()} == {u + 2 ** 40 for u in range(20)}
    assert sorted(r.id for r in items.collect()) == [f"item {i:02}" for i in range(15)]
    top = ml.als_rank(users, items, 2 ** 40 + 4, 5).orderBy("rank").collect()
    f = {r.id: r.features for r in items.collect()}
    me = next(r.features for r in users.collect() if r.id == 2 ** 40 + 4)
    want = sorted(f, key=lambda i: -sum(a * b for a, b in zip(me, f[i])))[:5]
    assert [r.item_id for r in top] == want
    fit = ml.als_rmse(far, users, items).first()
    assert fit.n == len(rows) and fit.rmse < fit.spread


def test_als_factors_read_the_ratings_once(spark):
    from pyspark.sql import functions as F
    seen = spark.sparkContext.accumulator(0)

    def far(u):
        seen.add(1)
        return u + 2 ** 40

    rows = [(u, i, float((u * 7 + i * 3) % 5 + 1)) for u in range(20) for i in range(15) if (u + i) % 3]
    df = spark.createDataFrame(rows, "user_id long, item_id long, rating double").withColumn(
        "user_id", F.udf(far, "long").asNondeterministic()("user_id"))
    users, _ = ml.als_factors(df, max_iter=2)
    assert users.count() == 20 and seen.value == len(rows)


def test_als_blocks_follow_the_ratings(spark):
    rows = [(u, i, float((u * 7 + i * 3) % 5 + 1)) for u in range(20) for i in range(15)]
    df = spark.createDataFrame(rows, "user_id long, item_id long, rating double")
    least = min(ml.ALS_BLOCKS, spark.sparkContext.defaultParallelism)
    assert ml.als_blocks(df) == least
    assert ml.als_blocks(df, 10 * ml.ALS_BLOCK_RATINGS) == 10
    assert ml.als_model(df, max_iter=2).userFactors.rdd.getNumPartitions() == least


def test_dense_ids_follow_the_order(spark):
    ids = [5 * n - 2 ** 45 for n in range(500)]
    d = spark.createDataFrame([(i,) for i in ids + ids[:50] + [None]], "id long").repartition(7)
    got = {r.id: r["index"] for r in ml.dense_ids(d).collect()}
    assert got == {i: n for n, i in enumerate(ids)}
    assert ml.dense_ids(d.where("id IS NULL")).count() == 0


def test_wide_ridge_equals_numpy(spark):
    import numpy as np
    rng = np.random.default_rng(3)
    x, w = rng.normal(size=(900, 300)), rng.normal(size=300)
    y = x @ w + rng.normal(size=900)
    from pyspark.ml.linalg import Vectors
    df = spark.createDataFrame([(float(b), Vectors.dense(a)) for a, b in zip(x, y)],
                               ["label", "features"]).repartition(5)
    got = ml.ridge_fit(df, reg=0.05).coefficients
    want = np.linalg.solve(x.T @ x / 900 + 0.05 * np.eye(300), x.T @ y / 900)
    assert np.allclose(got, want, atol=1e-8)
