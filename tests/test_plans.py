"""Plan-shape checks: the scale properties the README claims, read from
``explain()`` with the broadcast threshold lowered so the small test tables
plan like large ones."""

import contextlib
import io

import pytest

import __spark_entry__ as E

from .conftest import SF_SMALL


@pytest.fixture
def big_tables(spark):
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "1k")
    yield spark
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def _plan(df, mode="formatted"):
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain(mode)
    return buf.getvalue()


def test_filters_and_columns_reach_the_scan(big_tables):
    plan = _plan(E.queries()["user_ratings"](big_tables, SF_SMALL))
    assert "EqualTo(o_custkey,23)" in plan
    assert "ReadSchema: struct<o_orderkey:bigint,o_custkey:bigint>" in plan
    wc = _plan(E.queries()["word_count"](big_tables, SF_SMALL))
    assert "ReadSchema: struct<text:string>" in wc


def test_aggregates_combine_before_the_shuffle(big_tables):
    for key in ("word_count", "spend_by_customer", "rating_histogram", "top_degree"):
        plan = _plan(E.queries()[key](big_tables, SF_SMALL), "extended")
        assert "partial_" in plan, key


def test_top_k_broadcasts_only_the_k_keys(big_tables):
    plan = _plan(E.queries()["top_items"](big_tables, SF_SMALL), "extended")
    phys = plan.split("== Physical Plan ==")[1]
    assert "TakeOrderedAndProject" in phys
    # the titles scan is streamed through a hash join whose build side is the
    # broadcast top-k keys, never broadcast itself
    assert "BroadcastHashJoin" in phys and "BuildRight" in phys


def test_windows_pre_aggregate_panes(big_tables):
    plan = _plan(E.queries()["window_trending_tags"](big_tables, SF_SMALL), "extended")
    phys = plan.split("== Physical Plan ==")[1]
    # two partial/final aggregate pairs around the 30-window expansion
    assert phys.count("partial_count") == 1 and phys.count("partial_sum") == 1
    assert "Generate explode(" in phys
