"""Results do not depend on the number of shuffle partitions (1, 4, 200)
or on AQE; checked on the queries with the most shuffles."""

import pytest

import __spark_entry__ as E

from .conftest import SF_SMALL

KEYS = ["item_similarity", "window_trending_tags", "word_count", "top_degree",
        "degrees_of_separation", "spend_by_customer", "similar_items", "most_connected"]


def _rows(df):
    return sorted(tuple(r) for r in df.collect())


@pytest.mark.parametrize("key", KEYS)
def test_partition_count_invariance(spark, key):
    q = E.queries()[key]
    old = spark.conf.get("spark.sql.shuffle.partitions")
    old_aqe = spark.conf.get("spark.sql.adaptive.enabled")
    try:
        results = []
        for parts, aqe in ((1, "true"), (4, "false"), (200, "true")):
            spark.conf.set("spark.sql.shuffle.partitions", str(parts))
            spark.conf.set("spark.sql.adaptive.enabled", aqe)
            results.append(_rows(q(spark, SF_SMALL)))
        assert results[0] == results[1] == results[2]
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)
        spark.conf.set("spark.sql.adaptive.enabled", old_aqe)
