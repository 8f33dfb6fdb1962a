"""Delimited text files with a table of rejected lines.

``read_checked`` gives two tables of one set of files: the good rows, typed,
and the rejects, each with its file, byte offset, reason and the line as it
stands. Every line is in exactly one of them. Both are lazy: the good rows
never leave the JVM, and of the rejects' scan only line lengths and rejected
lines go through Python.

The byte offset of a line in a file is the sum of the lengths of the lines
before it. A task knows its own lines only, so it counts from the start of
its piece of a file (``file_block_start``), and the lengths of the earlier
pieces of that file are added from a table of one row per piece.

Offsets count the bytes of the (uncompressed) file; a byte-order mark at its
start is not counted. A line ends at a line feed; a carriage return before it
belongs to the line break, not to the last field.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

Fields = list[tuple[str, int, str]]

_PLACE = ["file", "piece"]


def read_places(spark: SparkSession, path: str) -> DataFrame:
    """(file, piece, value, bytes): lines with the file and the start of the
    piece of it that a task reads, without the carriage return of CRLF, and
    their length in the file with the line break."""
    # an explicit separator keeps "\r", so that lengths are those of the file
    raw = spark.read.option("lineSep", "\n").text(path).select(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("piece"), "value")
    size, whole = F.octet_length("value"), F.col("value").cast("binary")
    text = F.when(F.endswith("value", F.lit("\r")), F.substring(whole, F.lit(1), size - 1))
    return raw.select(*_PLACE, text.otherwise(whole).cast("string").alias("value"),
                      (size + 1).cast("long").alias("bytes"))


def _check(fields: Fields, sep: str, trim: bool) -> tuple[list[Column], Column]:
    """Typed columns, and the reason why a line is rejected (null: it isn't)."""
    parts = F.split(F.col("value"), "\\Q" + sep + "\\E", -1)
    typed, reasons = [], []
    for name, at, kind in fields:
        raw = F.get(parts, at)
        if trim:
            raw = F.trim(raw)
        got = raw if kind == "string" else raw.try_cast(kind)
        typed.append(got.alias(name))
        reasons.append(F.when(F.get(parts, at).isNull(), F.lit(f"no {name}"))
                       .when(got.isNull(), F.lit(f"{name} is not {kind}")))
    return typed, F.coalesce(*reasons)


def _starts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Offset of every line from the start of its piece; a task reads the
    lines of a piece in order, one piece after the other."""
    place, before = None, 0
    for b in batches:
        if not b.num_rows:
            continue
        size = b.column("bytes").to_numpy()
        files, pieces = b.column("file"), b.column("piece").to_numpy()
        name = files.dictionary_encode().indices.to_numpy()
        new = np.flatnonzero((np.diff(name) != 0) | (np.diff(pieces) != 0)) + 1
        start = np.empty(len(size), np.int64)
        for lo, hi in zip([0, *new], [*new, len(size)], strict=True):
            here = (files[int(lo)].as_py(), int(pieces[lo]))
            if here != place:
                place, before = here, 0
            ends = before + np.cumsum(size[lo:hi])
            start[lo:hi] = ends - size[lo:hi]
            before = int(ends[-1])
        bad = pa.array(b.column("reason").is_valid())
        out = pa.RecordBatch.from_arrays(
            [files, b.column("piece"), pa.array(start), b.column("reason"), b.column("line")],
            names=["file", "piece", "start", "reason", "line"])
        yield out.filter(bad)


def read_checked(spark: SparkSession, path: str, sep: str, fields: Fields,
                 trim: bool = False) -> tuple[DataFrame, DataFrame]:
    """(good, rejects) of the files at ``path``; ``fields`` = [(name, index,
    type), ...]. A line is rejected for its first bad field in the order of
    ``fields``: "no <name>" (too few fields) or "<name> is not <type>". A string
    field is good if it is there, if empty too. ``rejects``: file, offset (long),
    reason, line (binary, so that bytes that are no UTF-8 are kept)."""
    lines = read_places(spark, path)
    typed, reason = _check(fields, sep, trim)
    good = lines.where(reason.isNull()).select(*typed)
    pieces = lines.groupBy(*_PLACE).agg(F.sum("bytes").alias("bytes"))
    earlier = Window.partitionBy("file").orderBy("piece").rowsBetween(
        Window.unboundedPreceding, -1)                   # one row per piece of a file
    pieces = pieces.select(*_PLACE, F.coalesce(F.sum("bytes").over(earlier), F.lit(0))
                           .alias("base"))
    found = lines.select(*_PLACE, "bytes", reason.alias("reason"), F.when(
        reason.isNotNull(), F.col("value").cast("binary")).alias("line")).mapInArrow(
        _starts, "file string, piece long, start long, reason string, line binary")
    rejects = found.join(pieces, _PLACE).select(
        "file", (F.col("base") + F.col("start")).alias("offset"), "reason", "line")
    return good, rejects
