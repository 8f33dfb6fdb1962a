"""The pipeline against a brute-force version of its stages."""

import hashlib
import re
from collections import Counter

from pyspark.sql import functions as F

import corpus_pipeline as P
from tests.llm.common import documents

SF = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def test_stages_on_edge_rows(spark):
    d = documents(spark)
    a = P.language(spark, d, SF)
    assert a.columns == d.columns
    kept = {r.doc_id for r in a.collect()}
    assert not kept & {4, 5, 6, 14} and {1, 7, 9, 11, 12} <= kept
    b = P.exact(spark, a, SF)
    texts = [r.text for r in a.collect()]
    assert sorted(r.text for r in b.collect()) == sorted(set(texts)) and b.columns == d.columns
    c = P.near(spark, b, SF)
    left = [r.text for r in c.collect()]
    assert len(left) == len(set(texts)) - 2 and c.columns == d.columns   # 1 and 2, 7 and 8
    m = P.mixed(spark, c, SF)
    assert m.columns == d.columns and {r.text for r in m.collect()} & set(left)
    out = P.tokens(spark, m, SF).collect()
    assert sorted(r.decoded_sha256 for r in out) == sorted(
        hashlib.sha256(r.text.encode()).hexdigest() for r in m.collect())
    for _, stage in P.STAGES:
        assert stage(spark, d.where(F.lit(False)), SF).count() == 0


def test_run_against_brute_force(spark):
    docs = [(r.doc_id, r.text, r.source) for r in
            spark.read.parquet(f"{SF}/documents.parquet").collect()]
    docs = [d for d in docs if any(c.isalpha() for c in d[1] or "")]
    best = {}
    for d in docs:
        best[d[1]] = max(best.get(d[1], d), d)
    sets = {}
    for i, t, _ in best.values():
        w = t.encode().lower().split()
        k = min(5, len(w))
        sets[i] = {tuple(w[j:j + k]) for j in range(len(w) - k + 1)}
    ids, group = sorted(sets), {}
    for n, i in enumerate(ids):
        group[i] = i
        for j in ids[:n]:
            if 10 * len(sets[i] & sets[j]) >= 8 * len(sets[i] | sets[j]):
                old, new = sorted((group[i], group[j]))[::-1]
                group = {k: new if v == old else v for k, v in group.items()}
    size = Counter()
    out = P.run(spark, SF).collect()
    for r in out:
        size[r.doc_id] += 1
    assert len({group[i] for i in size}) == len(size)     # one document of each group at most
    text = {i: t for i, t, _ in best.values()}
    whole = sum(hashlib.sha256(text[r.doc_id].encode()).hexdigest() == r.decoded_sha256
                for r in out)
    sources = len({s for *_, s in docs})
    assert whole >= len(out) - sources                    # one cut document a source at most
    assert max(size.values()) <= 2


def test_language_stage_rejects_by_the_model(spark):
    d = spark.createDataFrame(
        [(i, "the sea and the stone", "en", "a", 21) for i in range(12)]
        + [(20, "ΩΨΦ ЖЩ", "en", "a", 6), (24, "12 34", "en", "a", 5)],
        "doc_id long, text string, lang string, source string, n_chars long")
    learn = P.langid.crc_mod(F.col("doc_id"), 4) != 2
    d = d.withColumn("lang", F.when(learn & (F.col("doc_id") < 20), F.col("lang")))
    assert {r.doc_id for r in P.language(spark, d, SF).collect()} == set(range(12))
    none = d.withColumn("lang", F.lit(None).cast("string"))
    assert {r.doc_id for r in P.language(spark, none, SF).collect()} == {*range(12), 20}
