"""The operators' queries: registration, and SQL where there is one."""

import re

import duckdb
import pytest

import __spark_entry__ as E
from kestrel.llm import queries
from kestrel.sources.tables import TABLES
from tests.conftest import SF_SMALL
from tools.oracle_check import compare


def test_all_operators_are_registered():
    got = E.queries()
    assert {int(m[1]) for k in got if (m := re.match(r"op(\d+)_", k))} == set(range(1, 14))
    assert "pipeline" in got and set(queries.ORACLE) < set(E.oracle_sql())


@pytest.mark.parametrize("key", sorted(queries.ORACLE))
def test_query_matches_sql(spark, key):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    r = compare(spark, con, SF_SMALL, key, queries.QUERIES[key], queries.ORACLE[key])
    assert r["cols"] and r["equal"], r
