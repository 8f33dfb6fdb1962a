"""Text files with a table of rejected lines: every reject is found again at
its file and offset, every line is in one of the two tables."""

import os
from urllib.parse import unquote, urlparse

import pytest

from kestrel.sources import files

FIELDS = [("id", 0, "int"), ("name", 1, "string"), ("amount", 2, "decimal(18,2)")]


def _write(folder, name, raw):
    with open(os.path.join(folder, name), "wb") as f:
        f.write(raw)


def _at(reject, size):
    with open(unquote(urlparse(reject.file).path), "rb") as f:
        f.seek(reject.offset)
        return f.read(size)


def test_rejects_with_file_offset_and_reason(spark, tmp_dir):
    _write(tmp_dir, "a b.csv", b"1,Ann,2.50\r\nx,Bo,1\r\n\r\n3,Caf\xe9\r\n4,Di,7")
    _write(tmp_dir, "b.csv", "5,Zoë,n/a\n6,,1.005\n7,Eve, 8 \n,Fay,1\n".encode())
    _write(tmp_dir, "c.csv", b"")
    good, rejects = files.read_checked(spark, tmp_dir, ",", FIELDS, trim=True)
    assert sorted((r.id, r.name, str(r.amount)) for r in good.collect()) == [
        (1, "Ann", "2.50"), (4, "Di", "7.00"), (6, "", "1.01"), (7, "Eve", "8.00")]
    got = rejects.collect()
    assert sorted((bytes(r.line), r.reason) for r in got) == [
        (b"", "id is not int"), (b",Fay,1", "id is not int"), (b"3,Caf\xe9", "no amount"),
        ("5,Zoë,n/a".encode(), "amount is not decimal(18,2)"), (b"x,Bo,1", "id is not int")]
    for r in got:
        assert _at(r, len(r.line)) == bytes(r.line)


@pytest.mark.parametrize("end", [b"\n", b"\r\n"])
def test_offsets_over_the_pieces_of_a_file(spark, tmp_dir, end):
    rows = [(b"%d,n%s,1.25" if i % 7 else b"%d;n%s") % (i, b"x" * (i % 53)) for i in range(4000)]
    _write(tmp_dir, "one.csv", end.join(rows) + end)
    held = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "7001")
    try:
        assert files.read_places(spark, tmp_dir).select("piece").distinct().count() > 10
        good, rejects = files.read_checked(spark, tmp_dir, ",", FIELDS)
        assert sorted(r.id for r in good.collect()) == [i for i in range(4000) if i % 7]
        got = rejects.collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", held)
    assert sorted(bytes(r.line) for r in got) == sorted(rows[i] for i in range(0, 4000, 7))
    for r in got:
        assert _at(r, len(r.line) + len(end)) == bytes(r.line) + end


def test_no_rejects(spark, tmp_dir):
    _write(tmp_dir, "a.csv", b"1,Ann,2\n")
    good, rejects = files.read_checked(spark, tmp_dir, ",", FIELDS)
    assert good.count() == 1 and rejects.count() == 0
