"""Legacy web archives: writing and reading ARC files, converting them to WARC.

An ARC file starts with a version block, whose first line says how long the
block is and whose second line which version of record lines follows. A
record is one line of fields, the last of them the length of the content, and
that many bytes. Version 1 has five fields a line, version 2 ten; a URL may
hold spaces in old files, so fields are counted from the right.

The converter walks the archives by the declared lengths (never by looking
for something that resembles a header), and synthesises what WARC asks for and
ARC does not have: record identifiers (a UUID of the file and offset),
timestamps (14 digits or fewer to ISO 8601), types and SHA-1 digests in base 32.
Records of equal payloads from a length on are written once: that with the
largest key is a response, the others revisit it and keep their HTTP header.

Archives are written with Spark's text writer (the line separator is the
format's record end), gzip compressed, and read with its binary reader, so
they may live in any store that Spark reaches. A file is read by one task: a
file that this module writes has at most ``FILE_BYTES`` of average records
and never more than ``LARGEST_FILE``; Spark's binary reader takes 2 GB at most.
Payloads are not shuffled unless the list of revisits is too large to
broadcast; only an index (file, offset, digests) is.

Defined results: a null payload is empty; a null key is written without a key
line and comes back null (smallest of its group); of repeated rows with the
largest key one is the response; white space and control characters of a URL
are percent-encoded, a null or empty URL becomes
``unknown:``; an empty table gives
archives without records. A record that declares more bytes than the file has
is cut there and marked in ``problem``; a line that is no record line ends the
file with a record of the type ``unparsed``, which holds the rest.
"""

from __future__ import annotations

import zlib

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from kestrel.session import materialize, scratch_path

FILE_BYTES = 64 << 20        # uncompressed, of records of average size
LARGEST_FILE = 1 << 30
PIECE = 1 << 20              # compressed bytes that a reader takes at once
BATCH = 8 << 20              # parsed bytes that a reader hands on at once

#: Fixed values of the two formats: the field line of each ARC version, the
#: first words of a version block, and the revisit profile of WARC 1.0.
ARC_FIELDS = {
    1: "URL IP-address Archive-date Content-type Archive-length",
    2: "URL IP-address Archive-date Content-type Result-code Checksum Location Offset "
       "Filename Archive-length"}
ARC_ORIGIN = "kestrel"
REVISIT = "http://netpreserve.org/warc/1.0/revisit/identical-payload-digest"
KEY_LINE = "X-Record-Key"
HTTP_END = b"\r\n\r\n"


# ------------------------------------------------------------------- writing

def _records_per_file(sizes: DataFrame, size: Column) -> int:
    """How many records go into a file, from the sizes of all."""
    size = size + 1024                          # header lines
    s = sizes.agg(F.avg(size).alias("mean"), F.max(size).alias("most")).first()
    if not s["most"]:
        return 1
    return max(1, min(int(FILE_BYTES / s["mean"]), LARGEST_FILE // int(s["most"])))


def _write(rows: DataFrame, path: str, per_file: int, head: Column, end: str) -> None:
    """Write the binary column ``record`` of ``rows``, each followed by
    ``end``, with ``head`` before the first record of every file."""
    # a partition is written in order, a new file every per_file rows; the
    # lower bits of the id count the rows of a partition
    at = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))
    rows = rows.withColumn("__first", at % per_file == 0)
    record = F.when(F.col("__first"), F.concat(head, F.col("record"))).otherwise(F.col("record"))
    (rows.select(record.cast("string").alias("value")).write
     .option("lineSep", end).option("maxRecordsPerFile", per_file)
     .option("compression", "gzip").text(path))


def safe_url(url: Column) -> Column:
    """``url`` without white space and control characters; null: ``unknown:``."""
    coded = url
    for c in [*map(chr, range(33)), "\x7f"]:
        coded = F.replace(coded, F.lit(c), F.lit(f"%{ord(c):02X}"))
    coded = F.when(url.rlike(r"[\x00-\x20\x7F]"), coded).otherwise(url)
    return F.when(F.coalesce(url, F.lit("")) == "", F.lit("unknown:")).otherwise(coded)


def write_arc(pages: DataFrame, path: str, *, key_col: str, url_col: str, payload_col: str,
              fetched: str = "20240101000000", ip: str = "0.0.0.0",
              version: int | None = None) -> None:
    """Write every row as an HTTP response into ARC files under ``path``.

    ``version`` is 1 or 2; by default partitions take turns."""
    d = pages.select(F.col(key_col).cast("string").alias("key"), F.col(url_col).alias("url"),
                     F.coalesce(F.col(payload_col).cast("binary"), F.lit(b"")).alias("payload"))
    per_file = _records_per_file(d, F.octet_length("payload"))
    turn = F.lit(version) if version else F.spark_partition_id() % 2 + 1
    d = d.withColumn("version", turn)
    key = F.coalesce(F.concat(F.lit(f"{KEY_LINE}: "), F.col("key"), F.lit("\r\n")), F.lit(""))
    http = F.concat(F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"),
                    F.lit("Content-Length: "), F.octet_length("payload"), F.lit("\r\n"),
                    key, F.lit("\r\n"))
    length = F.octet_length(http) + F.octet_length("payload")
    start = F.concat_ws(" ", safe_url(F.col("url")), F.lit(ip), F.lit(fetched),
                        F.lit("text/html"))
    more = F.when(F.col("version") == 2, F.lit(" 200 - - 0 -")).otherwise("")
    line = F.concat(start, more, F.lit(" "), length, F.lit("\n"))
    record = F.concat(line.cast("binary"), http.cast("binary"), F.col("payload"))

    def block(v: int) -> str:
        body = f"{v} 0 {ARC_ORIGIN}\n{ARC_FIELDS[v]}\n"
        more = " 200 - - 0 -" if v == 2 else ""
        return f"filedesc://pages.arc {ip} {fetched} text/plain{more} {len(body)}\n{body}\n"

    head = F.when(F.col("version") == 2, F.lit(block(2))).otherwise(F.lit(block(1)))
    _write(d.select("version", record.alias("record")), path, per_file, head.cast("binary"), "\n")


# ------------------------------------------------------------------- reading

class Bytes:
    """The decompressed bytes of one file, read by length; gzip members, plain
    bytes too, are taken piece by piece."""

    def __init__(self, pieces):
        self.raw, self.held, self.at = pieces, bytearray(), 0
        self.inflate, self.plain = None, None

    def more(self) -> bool:
        piece = next(self.raw, None)
        if piece is None:
            return False
        if self.plain is None:
            self.plain = piece[:2] != b"\x1f\x8b"
        if self.at:
            del self.held[:self.at]
            self.at = 0
        while piece and not self.plain:
            if self.inflate is None:
                self.inflate = zlib.decompressobj(31)
            self.held += self.inflate.decompress(piece)
            piece = self.inflate.unused_data
            if self.inflate.eof:
                self.inflate = None
        self.held += piece if self.plain else b""
        return True

    def take(self, n: int) -> bytes:
        """The next ``n`` bytes, fewer at the end."""
        while len(self.held) - self.at < n and self.more():
            pass
        got = bytes(self.held[self.at:self.at + n])
        self.at += len(got)
        return got

    def line(self) -> bytes:
        """The next line with its end; empty at the end of the file."""
        seen = self.at
        while (end := self.held.find(b"\n", seen)) < 0:
            searched = len(self.held) - self.at
            if not self.more():
                return self.take(searched)
            seen = self.at + searched
        return self.take(end + 1 - self.at)


def arc_records(data: Bytes):
    """(offset, version, url, date, mime, status, content, problem) of every
    record of an ARC file, the version block included."""
    offset, version = 0, 1
    while line := data.line():
        if not line.strip():                    # the line between records
            offset += len(line)
            continue
        fields = line.decode("utf-8", "replace").rstrip("\r\n")
        first = fields.startswith("filedesc:")
        parts = fields.rsplit(" ", 9 if version == 2 and not first else 4)
        if first and fields.count(" ") >= 9:    # a version block of version 2
            parts = fields.rsplit(" ", 9)
        wanted = 10 if len(parts) == 10 else 5
        if (len(parts) != wanted or not parts[-1].isdecimal()
                or not parts[2].isdecimal() or (wanted == 5 and version == 2 and not first)):
            rest = line
            while data.more():
                pass
            rest += data.take(1 << 62)
            yield offset, version, None, None, None, None, rest, "no record line"
            return
        size = int(parts[-1])
        content = data.take(size)
        if first:
            named = content.split(b" ", 1)[0]
            version = 2 if named == b"2" else 1
        status = parts[4] if wanted == 10 else None
        problem = None if len(content) == size else f"{size - len(content)} bytes missing"
        yield offset, version, parts[0], parts[2], parts[3], status, content, problem
        offset += len(line) + len(content)


def warc_records(data: Bytes):
    """(offset, headers, content, problem) of every record of a WARC file."""
    offset = 0
    while line := data.line():
        if not line.strip():                    # the two line ends after a record
            offset += len(line)
            continue
        head, headers = len(line), {}
        if line.startswith(b"WARC/"):
            name = None
            while (field := data.line()).strip():
                head += len(field)
                text = field.decode("utf-8", "replace").rstrip("\r\n")
                if text[0] in " \t" and name:   # a folded line goes on
                    headers[name] += " " + text.strip()
                else:
                    name, _, value = text.partition(":")
                    name = name.strip().lower()
                    headers[name] = value.strip()
            head += len(field)
        size = headers.get("content-length", "")
        if not size.isdecimal():
            while data.more():
                pass
            yield offset, {}, line + data.take(1 << 62), "no record line"
            return
        content = data.take(int(size))
        missing = int(size) - len(content)
        yield offset, headers, content, f"{missing} bytes missing" if missing else None
        offset += head + len(content)


def split_http(content: bytes) -> tuple[str | None, bytes]:
    """(HTTP header with its empty line, payload); no header: (None, all)."""
    if not content.startswith(b"HTTP/"):
        return None, content
    head, end, payload = content.partition(HTTP_END)
    return (head + end).decode("latin-1"), payload


def _pieces(spark: SparkSession, path: str) -> DataFrame:
    """(file, n, piece): the compressed bytes of every file, in order."""
    d = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
    n = F.ceil(F.col("length") / PIECE).cast("int")
    d = d.select(F.col("path").alias("file"), "content",
                 F.explode(F.sequence(F.lit(0), F.greatest(n - 1, F.lit(0)))).alias("n"))
    return d.select("file", "n", F.substring("content", F.col("n") * PIECE + 1,
                                             F.lit(PIECE)).alias("piece"))


def _files(batches):
    """(file, its pieces one by one), whatever batches they come in."""
    rows = ((f, n, p) for b in batches
            for f, n, p in zip(b["file"], b["n"], b["piece"], strict=True))
    ahead = next(rows, None)
    while ahead is not None:
        name = ahead[0]

        def own():
            nonlocal ahead
            while ahead is not None and ahead[0] == name:
                piece, ahead = ahead[2], next(rows, None)
                yield piece

        pieces = own()
        yield name, pieces
        for _ in pieces:                        # what the reader left
            pass


def _table(spark: SparkSession, path: str, parse, fields: dict[str, str]) -> DataFrame:
    """The rows that ``parse(file, Bytes)`` gives for every file; each row
    ends with how many bytes it holds, which is not among the fields."""
    names, schema = list(fields), ", ".join(f"{n} {t}" for n, t in fields.items())

    def run(batches):
        rows, held = [], 0
        for name, pieces in _files(batches):
            for *row, size in parse(name, Bytes(pieces)):
                rows.append(row)
                held += size + 512
                if held > BATCH:
                    yield pd.DataFrame(rows, columns=names, dtype=object)
                    rows, held = [], 0
        if rows:
            yield pd.DataFrame(rows, columns=names, dtype=object)

    return _pieces(spark, path).mapInPandas(run, schema)


def read_arc(spark: SparkSession, path: str) -> DataFrame:
    """One row per ARC record: file, offset, version, url, date, mime, status,
    http (the HTTP header, null without one), payload, problem."""
    def parse(name, data):
        for at, version, url, date, mime, status, content, problem in arc_records(data):
            http, payload = split_http(content)
            yield name, at, version, url, date, mime, status, http, payload, problem, len(content)

    return _table(spark, path, parse, {
        "file": "string", "offset": "long", "version": "int", "url": "string", "date": "string",
        "mime": "string", "status": "string", "http": "string", "payload": "binary",
        "problem": "string"})


def read_warc(spark: SparkSession, path: str) -> DataFrame:
    """One row per WARC record: file, offset, headers (names in lower case),
    http, payload, problem."""
    def parse(name, data):
        for at, headers, content, problem in warc_records(data):
            http, payload = split_http(content)
            yield name, at, headers, http, payload, problem, len(content)

    return _table(spark, path, parse, {
        "file": "string", "offset": "long", "headers": "map<string, string>", "http": "string",
        "payload": "binary", "problem": "string"})


# ---------------------------------------------------------------- converting

#: Base-32 digits of RFC 4648, and those of ``conv``.
DIGITS, CONV_DIGITS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567", "0123456789ABCDEFGHIJKLMNOPQRSTUV"


def base32(sha1_hex: Column) -> Column:
    """The 32 base-32 digits of a SHA-1 in hex: four for every five of hex."""
    parts = [F.lpad(F.conv(F.substring(sha1_hex, 5 * i + 1, 5), 16, 32), 4, "0")
             for i in range(8)]
    return F.translate(F.concat(*parts), CONV_DIGITS, DIGITS)


def from_base32(digest: Column) -> Column:
    """The SHA-1 in lower-case hex of 32 base-32 digits."""
    plain = F.translate(digest, DIGITS, CONV_DIGITS)
    parts = [F.lpad(F.conv(F.substring(plain, 4 * i + 1, 4), 32, 16), 5, "0") for i in range(8)]
    return F.lower(F.concat(*parts))


def warc_date(date: Column) -> Column:
    """ISO 8601 in UTC of 4 to 14 digits; what is missing is the start of it."""
    full = F.rpad(date, 14, "00000101000000")
    full = F.concat(F.substring(full, 1, 4), *[
        F.when(F.length(date) >= at + 1, F.substring(full, at, 2)).otherwise(F.lit(least))
        for at, least in ((5, "01"), (7, "01"), (9, "00"), (11, "00"), (13, "00"))])
    return F.concat(F.substring(full, 1, 4), F.lit("-"), F.substring(full, 5, 2), F.lit("-"),
                    F.substring(full, 7, 2), F.lit("T"), F.substring(full, 9, 2), F.lit(":"),
                    F.substring(full, 11, 2), F.lit(":"), F.substring(full, 13, 2), F.lit("Z"))


def record_id(file: Column, offset: Column) -> Column:
    """A UUID (version 8) of where the record was found."""
    h = F.sha2(F.concat_ws(" ", file, offset.cast("string")), 256)
    return F.concat(F.lit("urn:uuid:"), F.substring(h, 1, 8), F.lit("-"), F.substring(h, 9, 4),
                    F.lit("-8"), F.substring(h, 14, 3), F.lit("-a"), F.substring(h, 18, 3),
                    F.lit("-"), F.substring(h, 21, 12))


def http_field(http: Column, name: str) -> Column:
    """The value of a line of an HTTP header; null without one."""
    found = F.regexp_extract(http, rf"(?im)^{name}:[ \t]*([^\r\n]*)", 1)
    return F.when(F.coalesce(http.rlike(rf"(?im)^{name}:"), F.lit(False)), found)


def _with_types(arc: DataFrame) -> DataFrame:
    """Adds the WARC type before dedup, identifier, digest and key."""
    kind = (F.when(F.col("url").isNull(), "unparsed")
            .when(F.col("url").startswith("filedesc:"), "warcinfo")
            .when(F.col("http").isNotNull(), "response").otherwise("resource"))
    return arc.withColumn("type", kind).withColumn("id", record_id(F.col("file"), F.col("offset"))) \
        .withColumn("sha1", F.sha1("payload")).withColumn("key", http_field(F.col("http"), KEY_LINE))


def arc_to_warc(spark: SparkSession, arc_path: str, warc_path: str, *,
                key_type: str = "bigint", min_bytes: int = 1000) -> None:
    """Convert every ARC file under ``arc_path`` to WARC files.

    Responses of equal payloads of at least ``min_bytes`` become one response
    (largest key, read as ``key_type``) and revisits of it.
    """
    arc = _with_types(read_arc(spark, arc_path))
    long_enough = (F.col("type") == "response") & (F.octet_length("payload") >= min_bytes)
    index = materialize(arc.select(
        "file", "offset", "id", F.col("key").cast(key_type).alias("key"), "url", "date",
        "type", F.octet_length("payload").alias("bytes"),
        F.when(long_enough, F.sha2("payload", 256)).alias("same")), "arc-index")
    last = F.max(F.struct("key", "id")).alias("last")
    groups = materialize(                        # a table of its own: Spark can split a
        index.where("same IS NOT NULL").groupBy("same")     # hot payload in the join
        .agg(F.count(F.lit(1)).alias("n"), last).where("n > 1")
        .select("same", F.col("last.id").alias("refers")), "arc-copies")
    revisits = materialize(index.where("same IS NOT NULL").join(groups, "same").where(
        F.col("id") != F.col("refers")).select("file", "offset", "refers"), "arc-revisits")
    d = arc.join(revisits, ["file", "offset"], "left")

    revisit = F.col("refers").isNotNull()
    head = F.coalesce(F.col("http"), F.lit(""))
    # the HTTP header holds bytes: back by the same code that read it
    block = F.concat(F.encode(head, "ISO-8859-1"),
                     F.when(revisit, F.lit(b"")).otherwise(F.col("payload")))
    kind = F.when(revisit, "revisit").when(F.col("type") == "unparsed", "metadata").otherwise(
        F.col("type"))
    content_type = (F.when(F.col("http").isNotNull(), "application/http; msgtype=response")
                    .otherwise(F.coalesce(F.col("mime"), F.lit("application/octet-stream"))))

    def line(name: str, value: Column) -> Column:
        return F.coalesce(F.concat(F.lit(f"{name}: "), value, F.lit("\r\n")), F.lit(""))

    lines = F.concat(
        F.lit("WARC/1.0\r\n"), line("WARC-Type", kind),
        line("WARC-Record-ID", F.concat(F.lit("<"), F.col("id"), F.lit(">"))),
        line("WARC-Date", warc_date(F.coalesce("date", F.lit("1970")))),
        line("WARC-Target-URI", F.when(~F.col("type").isin("warcinfo", "unparsed"), F.col("url"))),
        line("WARC-Filename", F.when(F.col("type") == "warcinfo", F.col("url"))),
        line("WARC-Payload-Digest", F.concat(F.lit("sha1:"), base32(F.col("sha1")))),
        line("WARC-Block-Digest", F.concat(F.lit("sha1:"), base32(F.sha1("block")))),
        line("WARC-Profile", F.when(revisit, F.lit(REVISIT))),
        line("WARC-Refers-To", F.concat(F.lit("<"), F.col("refers"), F.lit(">"))),
        line("WARC-Truncated", F.when(revisit | F.col("problem").isNotNull(),
                                      F.when(revisit, "length").otherwise("disconnect"))),
        line("Content-Type", content_type),
        line("Content-Length", F.octet_length("block").cast("string")), F.lit("\r\n"))
    per_file = _records_per_file(index, F.col("bytes"))
    out = d.withColumn("block", block).select(
        F.concat(lines.cast("binary"), F.col("block")).alias("record"))
    body = f"software: {ARC_ORIGIN}\r\nformat: WARC File Format 1.0\r\n"
    info = ("WARC/1.0\r\nWARC-Type: warcinfo\r\nWARC-Date: 1970-01-01T00:00:00Z\r\n"
            "WARC-Record-ID: <urn:uuid:00000000-0000-8000-a000-000000000000>\r\n"
            f"Content-Type: application/warc-fields\r\nContent-Length: {len(body)}\r\n\r\n{body}")
    _write(out, warc_path, per_file, F.lit(info + "\r\n\r\n").cast("binary"), "\r\n\r\n")


def page_records(spark: SparkSession, warc_path: str, key_type: str = "bigint") -> DataFrame:
    """(key, payload_bytes, payload_digest, record_type, refers_to) of every
    response and revisit read back. A revisit has the size of its payload
    from the response that it refers to, found by its identifier."""
    kind = F.col("headers")["warc-type"]
    read = materialize(
        read_warc(spark, warc_path).where(kind.isin("response", "revisit")).select(
            kind.alias("record_type"), F.col("headers")["warc-record-id"].alias("id"),
            F.col("headers")["warc-refers-to"].alias("refers"),
            from_base32(F.substring(F.col("headers")["warc-payload-digest"], 6, 32)).alias("named"),
            http_field(F.col("http"), KEY_LINE).cast(key_type).alias("key"),
            F.octet_length("payload").cast("long").alias("bytes"),
            F.sha1("payload").alias("sha1")), "warc-index")
    responses = read.where("record_type = 'response'")
    wanted = materialize(responses.join(
        read.where("refers IS NOT NULL").select(F.col("refers").alias("id")).distinct(), "id",
        "left_semi").select(F.col("id").alias("refers"), F.col("key").alias("refers_to"),
                            F.col("bytes").alias("full"), F.col("sha1").alias("whole")),
        "warc-referred")
    copies = read.where("record_type = 'revisit'").join(wanted, "refers", "left")
    plain = responses.select("key", F.col("bytes").alias("payload_bytes"),
                             F.col("sha1").alias("payload_digest"), "record_type",
                             F.lit(None).cast(key_type).alias("refers_to"))
    return plain.unionByName(copies.select(
        "key", F.col("full").alias("payload_bytes"), F.col("named").alias("payload_digest"),
        "record_type", "refers_to"))


def convert_pages(pages: DataFrame, *, key_col: str = "page_id", url_col: str = "url",
                  payload_col: str = "html", min_bytes: int = 1000) -> DataFrame:
    """Write ``pages`` as ARC files, convert them to WARC, read those back:
    see ``page_records``. Archives go to the session's shared folder."""
    spark = pages.sparkSession
    key_type = pages.schema[key_col].dataType.simpleString()
    arc, warc = scratch_path(spark, "arc"), scratch_path(spark, "warc")
    write_arc(pages, arc, key_col=key_col, url_col=url_col, payload_col=payload_col)
    arc_to_warc(spark, arc, warc, key_type=key_type, min_bytes=min_bytes)
    return page_records(spark, warc, key_type)
