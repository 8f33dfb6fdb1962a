"""ARC and WARC archives: round trips, hand-made legacy files, brute force."""

import base64
import glob
import gzip
import hashlib
import os

import pytest
from pyspark.sql import functions as F

from kestrel.llm import warc as W

SCHEMA = "page_id long, url string, html string"
LONG = "<p>é</p>" * 150
NASTY = "WARC/1.0\r\nContent-Length: 3\r\n\r\nabc\r\n\r\nhttp://x 1.1.1.1 20240101000000 a/b 5\n" * 20


def pages(spark):
    rows = [(1, "http://a.example/", LONG), (2, "http://b.example/x y\n", LONG), (3, None, None),
            (4, "", ""), (5, "http://c.example/?q=%20", "short"), (6, "http://d.example", "short"),
            (7, "http://e.example", NASTY), (8, "http://f.example", NASTY), (9, "u", LONG),
            (10, "http://g", "x" * 1000), (11, "http://h", "x" * 1000), (12, "i", "y" * 999),
            (13, "i", "y" * 999), (14, "http://漢字.example/", "z" * 3_000_000), (None, "n", LONG),
            (None, None, None), (15, "http://r", "r" * 2000), (15, "http://r", "r" * 2000),
            (16, "http://s", "\r\n\r\n\x00\n" * 300)]
    d = spark.createDataFrame(rows, SCHEMA)
    for name in ("key", "file", "offset", "payload", "record", "id", "block", "http"):
        d = d.withColumn(name, F.lit("x"))
    return d


def brute(rows):
    """(id, bytes, digest, type, refers) of (id, payload) rows."""
    groups = {}
    for n, (i, t) in enumerate(rows):
        if len(t) >= 1000:
            groups.setdefault(t, []).append((-1 if i is None else i, n))
    last = {t: max(g) for t, g in groups.items()}
    out = []
    for n, (i, t) in enumerate(rows):
        keep, at = last.get(t, (None, n))
        same = keep == (-1 if i is None else i)
        out.append((i, len(t), hashlib.sha1(t).hexdigest(),
                    "response" if at == n else "revisit",
                    None if at == n else keep, same))
    return out


def test_pages_come_back_from_archives(spark):
    d = pages(spark).repartition(3)
    got = W.convert_pages(d)
    assert got.columns == ["key", "payload_bytes", "payload_digest", "record_type", "refers_to"]
    want = brute([(r.page_id, (r.html or "").encode()) for r in d.collect()])
    # which of the rows with the same id is the response is not told
    assert sorted(map(str, ((r.key, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to)
                            for r in got.collect()))) == sorted(str(w[:5]) for w in want)
    assert sum(w[3] == "revisit" for w in want) == 6
    assert W.convert_pages(d.where(F.lit(False))).count() == 0


def test_every_file_starts_anew(spark, tmp_dir, monkeypatch):
    monkeypatch.setattr(W, "FILE_BYTES", 5000)
    d = spark.range(40).select(F.col("id").alias("page_id"), F.lit("http://x/").alias("url"),
                               F.repeat(F.lit("w"), 1500).alias("html")).coalesce(2)
    arc, out = os.path.join(tmp_dir, "arc"), os.path.join(tmp_dir, "warc")
    W.write_arc(d, arc, key_col="page_id", url_col="url", payload_col="html")
    files = glob.glob(arc + "/part*")
    firsts = {gzip.open(f).read().split(b"\n")[1] for f in files}
    assert len(files) >= 20 and firsts == {b"1 0 kestrel", b"2 0 kestrel"}
    read = W.read_arc(spark, arc)
    assert read.where("url NOT LIKE 'filedesc:%' AND problem IS NULL").count() == 40
    W.arc_to_warc(spark, arc, out)
    for f in glob.glob(out + "/part*"):
        assert gzip.open(f).read().startswith(b"WARC/1.0\r\nWARC-Type: warcinfo\r\n")
    back = W.page_records(spark, out).collect()
    assert {r.refers_to for r in back} == {None, 39} and len(back) == 40


def arc(version, records, end=b"\n"):
    body = f"{version} 0 test\n{W.ARC_FIELDS[version]}\n".encode()
    more = b" 200 - - 0 f.arc" if version == 2 else b""
    out = [b"filedesc://f.arc 0.0.0.0 19970101000000 text/plain" + more
           + b" %d\n" % len(body) + body]
    for url, date, mime, content in records:
        out.append(url + b" 1.2.3.4 " + date + b" " + mime + more + b" %d\n" % len(content)
                   + content)
    return out if end is None else end.join(out) + end


HTML = b"HTTP/1.0 200 OK\r\nContent-Type: text/html\r\n\r\n<b>caf\xe9</b>\n"
RECORDS = [(b"http://old.example/a b", b"19961231235959", b"text/html", HTML),
           (b"dns:old.example", b"199612", b"text/dns", b"20240101\nold.example A 1.2.3.4\n"),
           (b"http://old.example/none", b"19970101", b"image/gif", b"")]


@pytest.mark.parametrize("version", [1, 2])
@pytest.mark.parametrize("packed", ["plain", "whole", "members"])
def test_legacy_files(spark, tmp_dir, version, packed):
    data = arc(version, RECORDS)
    if packed == "whole":
        data = gzip.compress(data)
    if packed == "members":
        data = b"".join(gzip.compress(r + b"\n") for r in arc(version, RECORDS, None))
    path = os.path.join(tmp_dir, "in")
    os.mkdir(path)
    with open(os.path.join(path, "f.arc"), "wb") as f:
        f.write(data)
    out = os.path.join(tmp_dir, "out")
    W.arc_to_warc(spark, path, out)
    got = [r for r in W.read_warc(spark, out).collect() if r.headers["warc-type"] != "warcinfo"]
    got.sort(key=lambda r: r.offset)
    assert [(r.headers["warc-type"], r.headers["warc-target-uri"], r.headers["warc-date"])
            for r in got] == [
        ("response", "http://old.example/a b", "1996-12-31T23:59:59Z"),
        ("resource", "dns:old.example", "1996-12-01T00:00:00Z"),
        ("resource", "http://old.example/none", "1997-01-01T00:00:00Z")]
    assert bytes(got[0].payload) == b"<b>caf\xe9</b>\n" and got[0].problem is None
    for r, (*_, content) in zip(got, RECORDS, strict=True):
        payload = content.partition(b"\r\n\r\n")[2] if content.startswith(b"HTTP") else content
        for name, block in (("payload", payload), ("block", content)):
            assert r.headers[f"warc-{name}-digest"] == "sha1:" + base64.b32encode(
                hashlib.sha1(block).digest()).decode()
        assert int(r.headers["content-length"]) == len(content)
    assert len({r.headers["warc-record-id"] for r in got}) == 3


def test_damaged_files_are_marked(spark, tmp_dir):
    path = os.path.join(tmp_dir, "in")
    os.mkdir(path)
    whole = arc(1, RECORDS[:1])
    for name, data in (("cut", whole[:-5]), ("junk", whole + b"no header here\nmore\n"),
                       ("empty", b"")):
        with open(os.path.join(path, name), "wb") as f:
            f.write(data)
    got = {(r.file.rsplit("/", 1)[1], r.problem): bytes(r.payload)
           for r in W.read_arc(spark, path).where("problem IS NOT NULL").collect()}
    assert got == {("cut", "4 bytes missing"): b"<b>caf\xe9</b>\n"[:-4],
                   ("junk", "no record line"): b"no header here\nmore\n"}
    out = os.path.join(tmp_dir, "out")
    W.arc_to_warc(spark, path, out)
    kinds = [r.headers["warc-type"] for r in W.read_warc(spark, out).collect()]
    assert kinds.count("metadata") == 1 and kinds.count("response") == 2


def test_digests_and_dates(spark):
    texts = [b"", b"a", b"hello" * 50]
    d = spark.createDataFrame([(bytearray(t),) for t in texts], "b binary")
    for r in d.select("b", W.base32(F.sha1("b")).alias("d"),
                      W.from_base32(W.base32(F.sha1("b"))).alias("back")).collect():
        raw = hashlib.sha1(bytes(r.b))
        assert r.d == base64.b32encode(raw.digest()).decode() and r.back == raw.hexdigest()
    dates = spark.createDataFrame([("1997",), ("19970203",), ("199702030405",)], "d string")
    assert [r[0] for r in dates.select(W.warc_date(F.col("d"))).collect()] == [
        "1997-01-01T00:00:00Z", "1997-02-03T00:00:00Z", "1997-02-03T04:05:00Z"]
