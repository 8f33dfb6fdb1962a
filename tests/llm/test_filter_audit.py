"""The filter audit against brute force over every order."""

import itertools
import random
import re

import numpy as np
from pyspark.sql import functions as F

from kestrel.llm import filter_audit as A
from kestrel.llm.queries import AUDIT_FILTERS, AUDIT_FLAGS
from tests.llm.common import documents, empty, prose

LABELS = "doc_id long, quality int, toxic int"


def brute(docs, labels):
    """{(part, order, step): counts} by running every order document by document."""
    good = {i for i, q, _ in labels if q == 1 and i is not None}
    toxic = {i for i, _, t in labels if t == 1 and i is not None}
    least = {}
    for i, text, _ in docs:
        if i is not None:
            least[text or ""] = min(i, least.get(text or "", i))
    parts = {}
    for i, text, lang in docs:
        t = text or ""
        w = re.findall(r"[^\x20\x09-\x0D]+", t)
        fails = {"A": len(w) < 200, "B": 100 * len(set(w)) < 50 * len(w),
                 "C": 100 * len(re.findall("[A-Z]", t)) > 3 * len(t),
                 "D": bool(re.search("[#$%&*|]", t)),
                 "E": i is not None and least[t] < i}
        parts.setdefault(lang or "", []).append((i, {f for f in fails if fails[f]}))
    out = {}
    for part, rows in parts.items():
        alone = dict.fromkeys("ABCDE", 0)
        for order in map("".join, itertools.permutations("ABCDE")):
            left = rows
            for step, f in enumerate(order, 1):
                gone = [i for i, x in left if f in x]
                left = [r for r in left if f not in r[1]]
                alone[f] += len(gone)
                out[part, order, step] = [
                    len(left), len(gone), sum(f in x for _, x in rows) - len(gone),
                    sum(x == {f} for _, x in rows), sum(i in good for i in gone),
                    sum(i in toxic for i in gone)]
        for key in out:
            if key[0] == part:
                out[key].append(alone[key[1][key[2] - 1]])
    return {k: tuple(v) for k, v in out.items()}


def run(spark, docs, labels):
    rows = A.document_failures(docs, labels, AUDIT_FLAGS)
    got = A.audit(rows, AUDIT_FILTERS, tuple(AUDIT_FLAGS)).collect()
    return {(r.part, r.filter_order, r.step): (
        r.kept, r.removed, r.redundant, r.unique_fails, r.good_lost, r.toxic_lost, r.shapley)
        for r in got}, len(got)


def test_audit_of_edge_rows_equals_brute_force(spark):
    rng = random.Random(5)
    docs = documents(spark)
    more = [(100 + n, prose(rng, rng.choice((150, 250, 400)), words=rng.choice(
        (("a", "b"), ("sea", "stone", "cold", "Ship"), ("x#", "y", "NORTH")))), "fr", "s", 1)
        for n in range(60)]
    more += [(200 + n, more[n][1], more[n][2], "t", 1) for n in range(0, 60, 3)]
    more += [(150, more[3][1], "fr", "s", 1), (99, "Hi " * 5000, "", "s", 1)]
    docs = docs.select("doc_id", "text", "lang", "source", "n_chars").unionByName(
        spark.createDataFrame(more, docs.select(
            "doc_id", "text", "lang", "source", "n_chars").schema)).withColumn("id", F.lit("x"))
    labels = [(n, n % 2, n % 3 % 2) for n in range(95, 210)] + [
        (100, None, 1), (None, 1, 1), (1, 1, 0), (1, 0, 1), (13, 1, 1), (9999, 1, 1)]
    frame = spark.createDataFrame(labels, LABELS).withColumn("flags", F.lit("x"))
    got, rows = run(spark, docs, frame)
    want = brute([(r.doc_id, r.text, r.lang) for r in docs.collect()], labels)
    assert got == want and rows == len(want) == 600 * len({k[0] for k in want})


def test_audit_of_empty_tables(spark):
    none = spark.createDataFrame([], LABELS)
    assert run(spark, empty(spark), none) == ({}, 0)
    got, _ = run(spark, documents(spark), none)
    assert got and all(v[4] == v[5] == 0 for v in got.values())


def test_many_parts_leave_a_task_in_pieces(spark, monkeypatch):
    rows = spark.range(3000).select((F.col("id") % 700).cast("string").alias("part"),
                                    (F.col("id") % 4).cast("int").alias("flags"),
                                    (F.col("id") % 32).cast("int").alias("fails")).coalesce(1)
    monkeypatch.setattr(A, "HELD", 50)
    got = A.audit(rows, "ABCDE").where("step = 5").groupBy().agg(
        F.countDistinct("part"), F.sum("kept")).first()
    fine = sum(n % 32 == 0 for n in range(3000))
    assert tuple(got) == (700, fine * 120)


def test_positional_popcounts():
    rng = np.random.default_rng(1)
    for n in (0, 1, 2, 3, 7, 64, 1000, 54321):
        words = rng.integers(0, 1 << 32, n, dtype=np.uint32)
        want = [int(((words >> np.uint32(b)) & 1).sum()) for b in range(32)]
        assert A.positional_popcounts(words, 32).tolist() == want


def test_survival_words():
    words = A.survival_words(5)
    assert len(words) == 32 and words[0] == 0xFFFFFFFF and words[31] == 1
    assert all(bool(words[m] >> s & 1) == (m & s == 0) for m in range(32) for s in range(32))
    assert A.survival_words(1).tolist() == [3, 1]
