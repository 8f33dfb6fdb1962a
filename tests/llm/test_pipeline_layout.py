"""The pipeline in two layouts, and its groups and targets by brute force."""

import os
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

import corpus_pipeline as P
from kestrel.llm.exact_dedup import distinct_documents
from kestrel.llm.mix import mixed_documents
from kestrel.llm.rows import ordinals, row_digest
from tests.llm.common import documents

SF = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def rows(df):
    return sorted(str(tuple(r)) for r in df.collect())


@pytest.fixture
def many_partitions(spark):
    old = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "23")
    yield spark
    spark.conf.set("spark.sql.shuffle.partitions", old)


def test_stages_do_not_depend_on_the_layout(many_partitions, tmp_dir):
    spark = many_partitions
    docs = spark.read.parquet(f"{SF}/documents.parquet").unionByName(
        documents(spark, clash=False))
    other = os.path.join(tmp_dir, "documents.parquet")
    docs.repartition(9).sortWithinPartitions(F.xxhash64("text")).write.parquet(other)
    other = spark.read.parquet(other)
    for name, stage in P.STAGES[:4]:
        a = stage(spark, docs, SF)
        spark.conf.set("spark.sql.shuffle.partitions", "5")
        b = stage(spark, other, SF)
        spark.conf.set("spark.sql.shuffle.partitions", "23")
        assert rows(a) == rows(b), name


def test_every_group_and_every_target_is_met(spark):
    docs = [(r.doc_id, r.text, r.source) for r in
            spark.read.parquet(f"{SF}/documents.parquet").collect()]
    docs = [d for d in docs if any(c.isalpha() for c in d[1] or "")]
    best = {}
    for d in docs:
        best[d[1]] = max(best.get(d[1], d), d)
    left = {d[0]: d for d in best.values()}
    sets = {}
    for i, t, _ in left.values():
        w = t.encode().lower().split()
        k = min(5, len(w))
        sets[i] = {tuple(w[j:j + k]) for j in range(len(w) - k + 1)}
    group = {i: i for i in sets}
    for i in sorted(sets):
        for j in sorted(sets):
            if j < i and 10 * len(sets[i] & sets[j]) >= 8 * len(sets[i] | sets[j]):
                old, new = max(group[i], group[j]), min(group[i], group[j])
                group = {k: new if v == old else v for k, v in group.items()}
    frame = spark.createDataFrame([(*left[i], ) for i in left], "doc_id long, text string, "
                                  "source string").withColumn("lang", F.lit("en"))
    kept = P.near(spark, frame, SF).collect()
    assert {r.doc_id for r in kept} == set(group.values())      # the smallest of each group
    size = Counter()
    for r in kept:
        size[r.source] += len(WORD.findall(r.text))
    taken = Counter()
    for r in P.mixed(spark, spark.createDataFrame(kept), SF).collect():
        taken[r.source] += len(WORD.findall(r.text))
    names, total = sorted(size), sum(size.values()) * 1.5
    weight = {s: (3, 1, 2)[n % 3] for n, s in enumerate(names)}
    want, open_ = {}, set(names)
    while True:                                                 # reshare what is above 2 x
        level = (total - sum(want.values())) / sum(weight[s] for s in open_)
        full = {s for s in open_ if level * weight[s] > 2 * size[s]}
        if not full:
            break
        want |= {s: 2.0 * size[s] for s in full}
        open_ -= full
        if not open_:
            break
    want |= {s: level * weight[s] for s in open_}
    assert all(abs(taken[s] - want[s]) <= 1 for s in names)


def test_ordinals_number_equal_rows_once(spark):
    d = spark.createDataFrame([(n % 3,) for n in range(50)], "a int").repartition(7)
    d = d.withColumn("row", F.monotonically_increasing_id()).withColumn("g", row_digest(["a"]))
    got = d.join(ordinals(d, "row", "g"), "row").collect()
    for a in range(3):
        own = sorted(r.ordinal for r in got if r.a == a)
        assert own == list(range(1, len(own) + 1))


def test_repeated_rows_are_mixed_one_by_one(spark):
    d = spark.createDataFrame([(1, "a b c d", "s")] * 10 + [(None, "x y", "s")] * 4,
                              "doc_id long, text string, source string")
    got = mixed_documents(d, weights=(1,), share=0.5, max_epochs=2).collect()
    assert sum(len(r.text.split()) for r in got) == 24
    assert len(distinct_documents(d).collect()) == 2


def test_clashing_hashes_give_the_same_groups(spark):
    from kestrel.llm.exact_dedup import exact_dedup
    d = spark.read.parquet(f"{SF}/documents.parquet")
    plain = {r.id: r.keep_id for r in exact_dedup(d).collect()}
    assert plain == {r.id: r.keep_id for r in exact_dedup(d, hash_bits=3).collect()}
