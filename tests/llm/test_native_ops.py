"""Mixing, exact dedup and URL rules: edge rows and brute force."""

import hashlib
import re
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from kestrel.llm.exact_dedup import exact_dedup
from kestrel.llm.mix import mix, mixed_documents, targets
from kestrel.llm.url_filter import judge_urls
from tests.llm.common import documents, empty, plain

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def water_fill(sizes, weights, share, cap):
    """Targets by repeated resharing, source by source."""
    total = sum(sizes.values()) * share
    names = sorted((s for s in sizes if s is not None)) + ([None] if None in sizes else [])
    w = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    out, free, left = {}, set(names), total
    while free:
        level = left / sum(w[s] for s in free)
        full = {s for s in free if sizes[s] * cap < level * w[s]}
        if not full:
            return out | {s: level * w[s] for s in free}
        for s in full:
            out[s] = sizes[s] * cap
            left -= out[s]
        free -= full
    return out


def test_targets_are_the_reshared_ones(spark):
    sizes = {"a": 10, "b": 1000, "c": 0, "ä": 40, None: 300, "z": 7}
    t = spark.createDataFrame(list(sizes.items()), "source string, source_size long")
    got = {r.source: r.target for r in targets(t, (3, 1, 2), 1.5, 2).collect()}
    assert got == pytest.approx(water_fill(sizes, (3, 1, 2), 1.5, 2))


@pytest.mark.parametrize("bucket_rows", [2, 50_000])
def test_mix_takes_the_exact_budget(spark, bucket_rows):
    d = documents(spark)
    rows = mix(d, bucket_rows=bucket_rows).collect()
    assert len(rows) == d.count()
    size = Counter()
    for r in d.select("source", "text").collect():
        size[r.source] += len(WORD.findall(r.text or ""))
    goal = water_fill(size, (3, 1, 2), 1.5, 2)
    taken = Counter()
    for r in rows:
        taken[r.source] += r.taken
        assert 0 <= r.taken <= 2 * r["size"] and r.source_size == size[r.source]
    assert taken == {s: int(t + 1e-9) for s, t in goal.items()}
    again = mix(d, bucket_rows=7).select("id", "taken")
    assert sorted(map(str, again.collect())) == sorted(
        map(str, mix(d).select("id", "taken").collect()))


def test_mixed_documents_hold_the_words(spark):
    d = documents(spark)
    plan = mix(d).agg(F.sum("taken")).first()[0]
    out = mixed_documents(d)
    assert out.columns == d.columns
    words = sum(len(WORD.findall(r.text)) for r in out.collect())
    assert abs(words - plan) <= 2          # ids differ, so the cuts do; budgets don't


def test_exact_dedup_by_brute_force(spark):
    d = documents(spark)
    want = defaultdict(list)
    for i, t in plain(d):
        want[t].append(i)
    for bits in (64, 3):                   # three bits: every hash clashes
        rows = exact_dedup(d, hash_bits=bits).collect()
        assert len(rows) == d.count()
        text_of = {hashlib.sha256(t.encode()).hexdigest(): t for t in want}
        kept = Counter()
        for r in rows:
            group = want[text_of[r.text_sha256]]
            assert r.group_size == len(group)
            assert r.keep_id == max((i for i in group if i is not None), default=None)
            kept[r.text_sha256] += r.kept
        assert set(kept.values()) == {1} and len(kept) == len(want)


def test_empty_tables(spark):
    e = empty(spark)
    assert mix(e).count() == 0 and exact_dedup(e).count() == 0
    assert mixed_documents(e).count() == 0


def test_url_rules(spark):
    rules = [("block", "net", "/"), ("allow", "example.net", "/en/"),
             ("block", "example.com", "/de/"), ("allow", "org", "/fr/"),
             ("block", "Example.ORG", "/fr/x")]
    urls = [None, "", "no scheme", "http://a.example.net/en/1", "http://a.example.net/de/1",
            "HTTP://X.EXAMPLE.COM/de/?q", "http://example.com?x=/de/", "http://example.com#/de/",
            "http://notexample.com/de/1", "http://example.org/fr/x1", "http://b.org/fr/y",
            "http://net/", "http://net", "a://b://net/", "http://a.net?u=c://net/x",
            "://net/x", "http://a.net/", "http://a.net/", "http:///x"]
    pages = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string")
    pages = pages.withColumn("host", F.lit("clash")).withColumn("rule", F.lit("clash"))
    got = judge_urls(pages, spark.createDataFrame(rules, "action string, host string, path string"))
    got = {r.id: r for r in got.collect()}
    assert len(got) == len(urls)
    for i, u in enumerate(urls):
        rest = u.split("://", 1)[1] if u and "://" in u else ""
        host = re.match(r"[^/?#]*", rest)[0]
        path = re.match(r"[^?#]*", rest[len(host):])[0]
        host = host.lower()
        fits = [(len(h + p), len(h), a, (h + p)) for a, h, p in
                ((a, h.lower(), p) for a, h, p in rules)
                if (host == h or host.endswith("." + h)) and path.startswith(p)]
        best = max(fits, default=None)
        assert (got[i].host, got[i].path) == (host, path)
        assert got[i].rule == (best[3] if best else None)
        assert got[i].verdict == (best[2] if best else "allow")
    few = spark.createDataFrame([], "page_id long, url string")
    assert judge_urls(few, spark.createDataFrame(rules, "action string, host string, path string")
                      ).count() == 0


def test_one_url_and_null_urls_hold_most_rows(spark):
    pages = spark.range(6000).select(F.col("id").alias("page_id"), F.expr(
        "CASE WHEN id % 2 = 0 THEN 'http://hot.net/a' WHEN id % 3 = 0 THEN NULL "
        "ELSE concat('http://h', id % 50, '.org/fr/', id) END").alias("url"))
    rules = spark.createDataFrame([("block", "net", "/"), ("allow", "org", "/fr/")],
                                  "action string, host string, path string")
    got = judge_urls(pages, rules, default="block")
    by = {r.rule: (r.n, r.ids, r.verdicts) for r in got.groupBy("rule").agg(
        F.count("*").alias("n"), F.countDistinct("id").alias("ids"),
        F.collect_set("verdict").alias("verdicts")).collect()}
    assert by == {"net/": (3000, 3000, ["block"]), None: (1000, 1000, ["block"]),
                  "org/fr/": (2000, 2000, ["allow"])}
    # pages without a host aren't shuffled, the join's right side is a plain scan
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert "Union" in plan and "Aggregate" not in plan
