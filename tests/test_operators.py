"""Aggregates, lookups, text and collection functions on hand-made rows
(D1-D6, D15; F1-F42). Expected values are worked out by hand."""

import pytest
from pyspark.sql import functions as F

from kestrel.functions import arrays as A
from kestrel.functions import text as T
from kestrel.operators import basic


def test_truncating_mean_toward_zero(spark):
    df = spark.createDataFrame([(1, 7), (1, 8), (2, -7), (2, -8), (3, 5)], "k int, v int")
    got = {r.k: r.avg_value for r in basic.mean_by_key(df, "k", "v").collect()}
    assert got == {1: 7, 2: -7, 3: 5}           # 15/2 -> 7, -15/2 -> -7
    exact = {r.k: r.avg_value for r in basic.mean_by_key(df, "k", "v", mode="exact").collect()}
    assert exact == {1: 7.5, 2: -7.5, 3: 5.0}


def test_histogram_count_sum_extremes(spark):
    df = spark.createDataFrame([("a", 1.0), ("a", 3.0), ("b", 2.0), ("b", 2.0)], "k string, v double")
    assert {r.value: r.cnt for r in basic.value_histogram(df, "v").collect()} == {1.0: 1, 3.0: 1, 2.0: 2}
    assert {r.k: r.cnt for r in basic.count_by_key(df, "k").collect()} == {"a": 2, "b": 2}
    s = {r.k: str(r.total) for r in basic.sum_by_key(df, "k", "v").collect()}
    assert s == {"a": "4.00", "b": "4.00"}
    assert {r.k: r.value for r in basic.extreme_by_key(df, "k", "v", "min").collect()} == {"a": 1.0, "b": 2.0}
    assert {r.k: r.value for r in basic.extreme_by_key(df, "k", "v", "max").collect()} == {"a": 3.0, "b": 2.0}


def test_argmax_ties_go_to_larger_key(spark):
    df = spark.createDataFrame([(1, 5), (9, 5), (4, 3)], "id long, n long")
    assert [tuple(r) for r in basic.argmax(df, "n", "id").collect()] == [(9, 5)]


def test_top_k_is_deterministic_on_ties(spark):
    df = spark.createDataFrame([(i, 10 if i in (3, 7, 5) else i) for i in range(1, 9)], "id int, cnt int")
    for parts in (1, 3, 8):
        top = basic.top_k(df.repartition(parts), [F.desc("cnt"), F.asc("id")], 3)
        assert [r.id for r in top.collect()] == [3, 5, 7]


def test_lookup_missing_policies(spark):
    facts = spark.createDataFrame([(1, 5), (2, 6)], "item_id long, cnt long")
    dim = spark.createDataFrame([(1, "one")], "item_id long, title string")
    got = {r.item_id: r.title for r in basic.lookup(facts, dim, "item_id", "title").collect()}
    assert got == {1: "one", 2: None}
    assert basic.lookup(facts, dim, "item_id", "title", on_missing="drop").count() == 1
    with pytest.raises(Exception):
        basic.lookup(facts, dim, "item_id", "title", on_missing="error").collect()
    small = basic.lookup(facts, dim, "item_id", "title", broadcast="left")
    assert small.count() == 2


def test_sql_range_view(spark):
    df = spark.createDataFrame([(i,) for i in range(10, 25)], "age int")
    assert sorted(r.age for r in basic.sql_range(df, "age", 13, 19).collect()) == list(range(13, 20))


def test_words_drop_and_java_empties(spark):
    rows = ["Hello, hello world!", "", ",,,", ",lead", "trail,,", "café x_1"]
    df = spark.createDataFrame([(r,) for r in rows], "text string")
    dropped = sorted(r.word for r in T.words(df).collect())
    assert dropped == sorted(["hello", "hello", "world", "lead", "trail", "caf", "x_1"])
    java = sorted(r.word for r in T.words(df, empty_tokens="java").collect())
    # Java keeps one leading empty and the empty line; drops trailing empties
    assert java == sorted(["hello", "hello", "world", "", "", "lead", "trail", "caf", "x_1"])
    wc = {r.word: r.cnt for r in T.word_count(df).collect()}
    assert wc["hello"] == 2 and sum(wc.values()) == 7


def test_hashtags_and_formatting(spark):
    df = spark.createDataFrame([("a #x b #y #x", 1), ("# #", 2)], "text string, ts int")
    assert sorted(r.tag for r in T.hashtags(df, ts=None).collect()) == ["#", "#", "#x", "#x", "#y"]
    r = spark.range(1).select(T.format_reading(T.fahrenheit_from_tenths(F.lit(-75))).alias("s")).first()
    assert r.s == "18.50 F"
    tie = spark.range(1).select(T.format_reading(F.lit(33.125)).alias("s")).first()
    assert tie.s == "33.13 F"   # Java formatter: half-up on the decimal form


def test_collection_functions(spark):
    df = spark.createDataFrame([([1, 2, 3, 4, 5, 1],)], "arr array<int>")
    r = df.select(
        F.transform("arr", A.square).alias("sq"),
        F.transform("arr", lambda x: A.apply_fn(x, A.cube)).alias("cu"),
        F.transform("arr", A.halve).alias("half"),
        A.array_sum(F.col("arr")).alias("sum"),
        F.filter("arr", lambda x: x != 5).alias("no5"),
        F.array_sort(F.array_distinct("arr")).alias("dist"),
        F.array_max("arr").alias("mx"),
        F.array_contains("arr", 3).alias("has3"),
        A.head(F.col("arr")).alias("head"),
        A.tail(F.col("arr")).alias("tail"),
    ).first()
    assert r.sq == [1, 4, 9, 16, 25, 1]
    assert r.cu == [1, 8, 27, 64, 125, 1]
    assert r.half == [0, 1, 1, 2, 2, 0]
    assert r.sum == 16 and r.no5 == [1, 2, 3, 4, 1] and r.dist == [1, 2, 3, 4, 5]
    assert r.mx == 5 and r.has3 is True and r.head == 1 and r.tail == [2, 3, 4, 5, 1]


def test_match_and_map_lookup(spark):
    df = spark.createDataFrame([(1,), (3,), (9,)], "n int")
    lab = [r.l for r in df.orderBy("n").select(
        A.match_label(F.col("n"), {1: "low", 2: "mid", 3: "high"}, "none of them").alias("l")).collect()]
    assert lab == ["low", "high", "none of them"]
    m = A.literal_map({"plum": "stone", "pear": "core"})
    keys = spark.createDataFrame([("pear",), ("fig",)], "k string")
    got = {r.k: (r.has, r.inside) for r in keys.select(
        "k", F.map_contains_key(m, F.col("k")).alias("has"),
        A.lookup_or(m, F.col("k"), "none").alias("inside")).collect()}
    assert got == {"pear": (True, "core"), "fig": (False, "none")}


def _java_split(s):
    """Java's String.split("\\W+") with limit 0: ASCII \\W, no match -> [s],
    trailing empty strings removed."""
    import re
    if s == "":
        return [""]
    parts = re.split(r"\W+", s, flags=re.ASCII)
    while parts and parts[-1] == "":
        parts.pop()
    return parts


def test_java_split_rules_on_random_text(spark):
    import random
    rnd = random.Random(11)
    alphabet = ["a", "B", "z", "0", "7", "_", " ", ",", ".", "!", "é", "ß", "\t", "-"]
    texts = ["".join(rnd.choice(alphabet) for _ in range(rnd.randint(0, 12))) for _ in range(300)]
    df = spark.createDataFrame(list(enumerate(texts)), "rid int, text string")
    toks = df.select("rid", F.posexplode(F.split("text", r"\W+")).alias("_i", "w"),
                     F.col("text").rlike(r"^(?:\W+)$").alias("_s"))
    # the same rule words() applies, kept per row to compare row by row
    got = {}
    for r in toks.where((F.col("w") != "") | ((F.col("_i") == 0) & ~F.col("_s"))).collect():
        got.setdefault(r.rid, []).append((r._i, r.w))
    for rid, text in enumerate(texts):
        assert [w for _, w in sorted(got.get(rid, []))] == _java_split(text), repr(text)
    # and words() yields exactly these tokens (lower-cased) as a multiset
    expect = sorted(w.lower() for t in texts for w in _java_split(t))
    assert sorted(r.word for r in T.words(df, empty_tokens="java").collect()) == expect


def test_mean_counts_values_only(spark):
    df = spark.createDataFrame([("a", 10), ("a", None)], "k string, v int")
    for mode in ("truncate", "exact"):
        assert basic.mean_by_key(df, "k", "v", mode=mode).first().avg_value == 10


def test_range_takes_dates_and_leaves_no_view(spark):
    import datetime as dt
    df = spark.createDataFrame([(dt.date(2024, 1, i),) for i in range(1, 6)], "day date")
    got = basic.sql_range(df, "day", dt.date(2024, 1, 2), dt.date(2024, 1, 3)).collect()
    assert len(got) == 2 and not spark.catalog.listTables()


@pytest.mark.parametrize("key,order", [
    ("count_by_key", ["age"]), ("rating_histogram", ["rating"]),
    ("spend_by_customer", ["total", "customer_id"]), ("item_popularity", ["cnt", "item_id"]),
    ("exact_avg_by_key", ["user_id"]), ("min_reading_by_station", ["station"])])
def test_results_come_sorted(spark, key, order):
    from kestrel.plans import catalog
    rows = [tuple(r[c] for c in order)
            for r in catalog.QUERIES[key](spark, "/root/testdata/sf0.001").collect()]
    assert len(rows) > 3 and rows == sorted(rows)
