"""Parsers and bad-row policy."""

import os

import pytest
from pyspark.errors import PySparkException
from py4j.protocol import Py4JJavaError

from kestrel.sources import text as src

from .conftest import lines

ERRORS = (PySparkException, Py4JJavaError, Exception)


def test_people_failfast_and_modes(spark):
    good = ["7,Ada,31,12", "8,Bo,19,3"]
    assert [tuple(r) for r in src.parse_people(lines(spark, good)).collect()] == [
        (7, "Ada", 31, 12), (8, "Bo", 19, 3)]
    bad = good + ["9,Cy,notanumber,4", "10,Di"]
    with pytest.raises(ERRORS):
        src.parse_people(lines(spark, bad)).collect()
    perm = src.parse_people(lines(spark, bad), mode="PERMISSIVE").orderBy("id").collect()
    assert [tuple(r) for r in perm][2:] == [(9, "Cy", None, 4), (10, "Di", None, None)]
    drop = src.parse_people(lines(spark, bad), mode="DROPMALFORMED").collect()
    assert sorted(r.id for r in drop) == [7, 8]


def test_ratings_tab_separated(spark):
    df = src.parse_ratings(lines(spark, ["1\t10\t4\t880000000", "2\t11\t3\t880000001"]))
    assert [tuple(r) for r in df.orderBy("user_id").collect()] == [
        (1, 10, 4.0, 880000000), (2, 11, 3.0, 880000001)]


def test_customer_orders_money_is_exact(spark):
    df = src.parse_customer_orders(lines(spark, ["44,8602,37.19", "44,1,0.10", "44,2,0.20"]))
    assert str(df.schema["amount"].dataType) == "DecimalType(18,2)"
    total = df.groupBy("customer_id").sum("amount").first()[1]
    assert str(total) == "37.49"


def test_titles_pipe_is_literal_and_short_rows_dropped(spark):
    rows = ["10|Blue Door (1990)|x||", "11| Red Box |y", "12", "13|"]
    df = src.parse_titles(lines(spark, rows))
    got = {r.item_id: r.title for r in df.collect()}
    # "13|" has a trailing empty field: Java's split drops it, Spark keeps it;
    # either way a title exists only when there are two fields
    assert got[10] == "Blue Door (1990)"
    assert got[11] == " Red Box "
    assert 12 not in got
    trimmed = {r.item_id: r.title for r in src.parse_titles(lines(spark, rows), trim=True).collect()}
    assert trimmed[11] == "Red Box"


def test_titles_invalid_utf8_is_replaced(spark, tmp_dir):
    path = os.path.join(tmp_dir, "titles.txt")
    with open(path, "wb") as f:
        f.write(b"1|Caf\xe9 Noir|x\n2|Plain|y\n")
    df = src.parse_titles(src.read_lines(spark, path))
    got = {r.item_id: r.title for r in df.collect()}
    assert got[1] == "Caf� Noir"
    assert got[2] == "Plain"


def test_titles_duplicates(spark):
    rows = lines(spark, ["1|A", "2|B", "1|C"])
    with pytest.raises(ERRORS):
        src.parse_titles(rows, on_duplicate="error").collect()
    from pyspark.sql import functions as F
    withpos = rows.withColumn("pos", F.monotonically_increasing_id())
    last = src.parse_titles(withpos, on_duplicate="last", ordinal="pos")
    assert {r.item_id: r.title for r in last.collect()} == {1: "C", 2: "B"}


def test_quoted_names(spark):
    rows = ['1 "ADA, THE FIRST"', "2 NO QUOTES", ' 3 "BO"', '7000 "DUMMY"', ""]
    df = src.parse_quoted_names(lines(spark, rows))
    assert {r.id: r.name for r in df.collect()} == {1: "ADA, THE FIRST", 3: "BO", 7000: "DUMMY"}
    cut = src.parse_quoted_names(lines(spark, rows), max_id=6487)
    assert sorted(r.id for r in cut.collect()) == [1, 3]
    with pytest.raises(ERRORS):
        src.parse_quoted_names(lines(spark, ['x1 "BAD"'])).collect()
    assert src.parse_quoted_names(lines(spark, ['x1 "BAD"']), mode="DROPMALFORMED").count() == 0


def test_adjacency_multi_line_nodes_and_counts(spark):
    rows = ["1 2 3 3", "1 4", "5", "2  1 ", "6 6"]
    edges = src.parse_adjacency(lines(spark, rows))
    got = sorted(tuple(r) for r in edges.collect())
    assert got == [(1, 2), (1, 3), (1, 3), (1, 4), (2, 1), (6, 6)]
    counts = src.adjacency_counts(lines(spark, rows))
    assert sorted(tuple(r) for r in counts.collect()) == [(1, 1), (1, 3), (2, 1), (5, 0), (6, 1)]


def test_render_then_parse_round_trip(spark):
    from pyspark.sql import functions as F
    e = spark.createDataFrame([(1, 2, 10), (1, 3, 11), (1, 4, 200), (2, 1, 12)],
                              "src long, dst long, eid long")
    text = src.render_adjacency(e, F.floor(F.col("eid") / 64))
    assert text.count() == 3  # node 1 spreads over two lines
    back = sorted(tuple(r) for r in src.parse_adjacency(text).collect())
    assert back == [(1, 2), (1, 3), (1, 4), (2, 1)]


def test_labelled_points(spark):
    df = src.parse_labelled_points(lines(spark, ["0.50,-0.47", "-1.74,1.66"]))
    assert [tuple(r) for r in df.collect()] == [(0.5, -0.47), (-1.74, 1.66)]


def test_file_readers_match_line_parsers(spark, tmp_dir):
    people = os.path.join(tmp_dir, "people.csv")
    with open(people, "w", newline="") as f:
        f.write("0,Ada,33,385\r\n1,Bo,26,2\r\n2,Cy,55,221\r\n")
    a = sorted(tuple(r) for r in src.read_people(spark, people).collect())
    b = sorted(tuple(r) for r in src.parse_people(src.read_lines(spark, people)).collect())
    assert a == b == [(0, "Ada", 33, 385), (1, "Bo", 26, 2), (2, "Cy", 55, 221)]
    ratings = os.path.join(tmp_dir, "ratings.tsv")
    with open(ratings, "w") as f:
        f.write("1\t10\t4\t880000000\n2\t11\t3\t880000001\n")
    assert src.read_ratings(spark, ratings).select("item_id").count() == 2
    bad = os.path.join(tmp_dir, "bad.csv")
    with open(bad, "w") as f:
        f.write("0,Ada,33,385\n1,Bo,x,2\n")
    with pytest.raises(ERRORS):
        src.read_people(spark, bad).collect()
    # collect, not count(): a pruned count parses no field, so drops nothing
    assert len(src.read_people(spark, bad, mode="DROPMALFORMED").collect()) == 1


def test_file_readers_for_line_formats(spark, tmp_dir):
    titles = os.path.join(tmp_dir, "titles.txt")
    with open(titles, "w") as f:
        f.write("1|First|x\n2|Second|y\n1|First again|z\n")
    last = {r.item_id: r.title for r in src.read_titles(spark, titles, on_duplicate="last").collect()}
    assert last == {1: "First again", 2: "Second"}
    names = os.path.join(tmp_dir, "names.txt")
    with open(names, "w") as f:
        f.write('1 "ONE"\n2 "TWO"\n7000 "DUMMY"\n')
    assert src.read_quoted_names(spark, names, max_id=6487).count() == 2
    graph = os.path.join(tmp_dir, "graph.txt")
    with open(graph, "w") as f:
        f.write("1 2 3\n2 1\n")
    assert sorted(tuple(r) for r in src.read_adjacency(spark, graph).collect()) == [(1, 2), (1, 3), (2, 1)]


def test_trailing_empty_fields_are_no_fields(spark):
    t = src.parse_titles(lines(spark, ["5|", "6||", "7|x||", "8||y"])).collect()
    assert [tuple(r) for r in t] == [(7, "x"), (8, "")]
    n = src.parse_quoted_names(lines(spark, ['5 "', '6 "Ann"', '7 ""'])).collect()
    assert [tuple(r) for r in n] == [(6, "Ann")]


def test_failfast_raises_without_ansi(spark):
    held = spark.conf.get("spark.sql.ansi.enabled")
    spark.conf.set("spark.sql.ansi.enabled", "false")
    try:
        for bad in ("1,Ann", "1,Ann,old,3"):
            with pytest.raises(Exception, match="malformed"):
                src.parse_people(lines(spark, [bad])).collect()
    finally:
        spark.conf.set("spark.sql.ansi.enabled", held)


def test_java_split_of_any_pattern(spark):
    from kestrel.functions.text import words
    for text, want in ((",,", []), ("a,,b", ["a", "", "b"]), (",a,", ["", "a"]), ("", [""])):
        got = words(lines(spark, [text]), "value", pattern=",", empty_tokens="java").collect()
        assert [r.word for r in got] == want
