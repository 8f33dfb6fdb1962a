"""Byte-level BPE encoding and decoding by a global shuffle of distinct words.

Each text is exploded into words at their positions: space-led pieces that
hold whole pre-tokens of the pattern (``words``). A block's distinct words
are dealt to buckets by hash; a bucket meets the words of all blocks and
encodes each distinct one once; the ids join back to the block, which puts
them at the words' positions. Decoding joins the token-byte table to the ids.

Texts travel once, compressed; words once per block that holds them. The
rank table is the vocabulary (bounded) and travels as a broadcast.

Defined results: null and empty texts have no ids and decode to nothing;
repeated rows are each encoded; other columns are ignored; empty table,
empty result.
"""

from __future__ import annotations

import base64
import binascii
import re
from collections import defaultdict
from itertools import count

import numpy as np
import pandas as pd
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kestrel.llm.blocks import (blocks, buckets_for, of_one, of_two, pack, release,
                                text_bytes, unpack)

MARK = "\x1f"
BLOCK_BYTES = 6 << 20        # a block's distinct words and ids stand in memory together
#: A space that continues a run of white space and is not followed by a word:
#: only there can a pre-token reach over a space.
UNSAFE = re.compile(r"\s (?!\S)")


def load_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}


def words(text: str, pattern) -> list[str]:
    """The text in order as pieces that each hold whole pre-tokens: cut
    before every space, since no pre-token holds an inner space unless it is
    white space; texts where that could happen are cut into pre-tokens."""
    if MARK in text or UNSAFE.search(text):
        return pattern.findall(text)
    out = text.replace(" ", MARK + " ").split(MARK)
    return out if out[0] else out[1:]


class Encoder:
    """The library's encoder, made once per worker from the ranks."""

    held: dict = {}

    @classmethod
    def of(cls, ranks: dict, pattern: str):
        key = (len(ranks), pattern, id(ranks))
        if key not in cls.held:
            import tiktoken
            cls.held.clear()
            cls.held[key] = tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=ranks,
                                              special_tokens={})
        return cls.held[key]


def _index(texts: list[bytes], pattern):
    """Codes of every text's words, and the distinct words in code order."""
    code = defaultdict(count().__next__)
    codes = [np.fromiter(map(code.__getitem__, ws), np.uint32, len(ws))
             for ws in (words(t.decode("utf-8", "replace"), pattern) for t in texts)]
    return codes, [w.encode() for w in code]


def _dealt(distinct: list[bytes], buckets: int) -> dict[int, list[int]]:
    out: dict[int, list[int]] = defaultdict(list)
    for i, w in enumerate(distinct):
        out[binascii.crc32(w) % buckets].append(i)
    return out


def encode(docs: DataFrame, ranks: dict[bytes, int], pattern: str, *,
           id_col: str = "doc_id", text_col: str = "text",
           block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """(id, ids, n_tokens) per row; ``ids``: little-endian unsigned 32-bit."""
    spark = docs.sparkSession
    total = text_bytes(docs, text_col)
    buckets = buckets_for(total)
    shared = spark.sparkContext.broadcast(ranks)
    narrow = "<u2" if max(ranks.values(), default=0) < 1 << 16 else "<u4"
    b = blocks(docs, id_col, text_col, total, block_bytes)
    kind = docs.schema[id_col].dataType

    def ask(batches):
        pat = regex.compile(pattern)
        for batch in batches:
            for block, blob in zip(batch["block"], batch["blob"], strict=True):
                _, distinct = _index(unpack(blob), pat)
                rows = [(k, block, pack([distinct[i] for i in at]))
                        for k, at in _dealt(distinct, buckets).items()]
                yield pd.DataFrame(rows, columns=["bucket", "block", "words"])
                del distinct, rows
                release()

    def encode_bucket(rows: pd.DataFrame) -> pd.DataFrame:
        encoder, known, out = Encoder.of(shared.value, pattern), {}, []
        for block, blob in zip(rows["block"], rows["words"], strict=True):
            ids = []
            for w in unpack(blob):
                got = known.get(w)
                if got is None:
                    got = known[w] = np.array(encoder.encode_ordinary(w.decode()),
                                              narrow).tobytes()
                ids.append(got)
            out.append((block, rows["bucket"].iat[0], pack(ids)))
        return pd.DataFrame(out, columns=["block", "bucket", "ids"])

    def assemble(block: pd.DataFrame, answers: pd.DataFrame) -> pd.DataFrame:
        if not len(block):
            return pd.DataFrame({"id": [], "ids": [], "n_tokens": []})
        codes, distinct = _index(unpack(block["blob"].iat[0]), regex.compile(pattern))
        by_code: list = [b""] * len(distinct)
        at = _dealt(distinct, buckets)
        del distinct
        for k, blob in zip(answers["bucket"], answers["ids"], strict=True):
            for i, ids in zip(at[k], unpack(blob), strict=True):
                by_code[i] = ids
        width = np.dtype(narrow).itemsize
        flat = np.frombuffer(b"".join(by_code), narrow)
        sizes = np.fromiter(map(len, by_code), np.int64, len(by_code)) // width
        starts = np.cumsum(sizes) - sizes
        out = []
        for c in codes:
            n = sizes[c]
            total = int(n.sum())
            here = np.repeat(starts[c] - (np.cumsum(n) - n), n) + np.arange(total)
            out.append(flat[here].astype("<u4").tobytes())
        return pd.DataFrame({"id": pd.Series(list(block["ids"].iat[0]), dtype=object),
                             "ids": out, "n_tokens": [len(x) // 4 for x in out]})

    answers = (b.mapInPandas(ask, "bucket int, block long, words binary")
               .groupBy("bucket").applyInPandas(of_one(encode_bucket),
                                                "block long, bucket int, ids binary"))
    return b.groupBy("block").cogroup(answers.groupBy("block")).applyInPandas(
        of_two(assemble), "id string, ids binary, n_tokens long").withColumn(
        "id", F.col("id").cast(kind))


def decode(encoded: DataFrame, ranks: dict[bytes, int]) -> DataFrame:
    """``encoded`` with ``decoded`` (bytes): the token-byte table joined to
    each id in order. The table is the vocabulary, a bounded broadcast. Rows
    travel in Spark's small batches of rows: an Arrow batch takes 10,000 rows
    of any length."""
    shared = encoded.sparkSession.sparkContext.broadcast(
        [w for w, _ in sorted(ranks.items(), key=lambda x: x[1])]
        if sorted(ranks.values()) == list(range(len(ranks))) else
        {i: w for w, i in ranks.items()})

    def join_bytes(ids: bytes) -> bytes:
        return b"".join(map(shared.value.__getitem__, np.frombuffer(ids, "<u4").tolist()))

    join_bytes = F.udf(join_bytes, "binary", useArrow=False)
    return encoded.withColumn("decoded", join_bytes("ids"))
