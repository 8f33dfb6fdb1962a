"""Blocks of documents, and keyed questions that blocks ask each other.

Operators that must compare the content of all documents do it in two hops.
Documents are gathered into blocks of bounded size (one compressed row each),
and each block asks about its distinct keys: the keys are dealt into buckets
by hash, a bucket sees the keys of all blocks and answers each block in the
order of its question. So what is shuffled is one entry per block and
distinct key (a key that every document holds costs one entry a block), and
both sides of every group are bounded by the block and bucket sizes.
"""

from __future__ import annotations

import contextlib
import ctypes
import itertools

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BLOCK_BYTES = 16 << 20
BUCKET_BYTES = 64 << 20      # text whose keys meet in one bucket


def pack(items: list[bytes]) -> bytes:
    lengths = np.fromiter(map(len, items), np.uint32, len(items))
    head = np.uint32(len(items)).tobytes()
    return zstandard.compress(head + lengths.tobytes() + b"".join(items), 3)


def unpack(blob: bytes) -> list[bytes]:
    raw = zstandard.decompress(blob)
    n = int(np.frombuffer(raw, np.uint32, 1)[0])
    ends = 4 + 4 * n + np.cumsum(np.frombuffer(raw, np.uint32, n, 4), dtype=np.int64)
    ends = ends.tolist()
    return [raw[a:b] for a, b in itertools.pairwise([4 + 4 * n, *ends])]


def pack_arrays(*arrays: np.ndarray) -> bytes:
    return pack([a.tobytes() for a in arrays])


def unpack_arrays(blob: bytes, *kinds) -> list[np.ndarray]:
    return [np.frombuffer(x, k) for x, k in zip(unpack(blob), kinds, strict=True)]


def release() -> None:
    """Give the free memory of a Python worker back to the system: workers stay
    for later stages, which share the executor's memory with them."""
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):      # glibc only
        ctypes.CDLL("libc.so.6").malloc_trim(0)


def of_one(fn):
    """``fn`` on one group, memory given back after it."""
    def run(rows: pd.DataFrame) -> pd.DataFrame:
        out = fn(rows)
        release()
        return out
    return run


def of_two(fn):
    """``fn`` on two groups of a key, memory given back after it."""
    def run(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        out = fn(left, right)
        release()
        return out
    return run


def whole_numbers(ids) -> list[int | None]:
    return [None if i is None else int(i) for i in ids]


def text_bytes(docs: DataFrame, text_col: str) -> int:
    return int(docs.agg(F.sum(F.octet_length(text_col)).alias("n")).first()["n"] or 0)


def buckets_for(total_bytes: int) -> int:
    return max(64, -(-total_bytes // BUCKET_BYTES))


def blocks(docs: DataFrame, id_col: str, text_col: str, total_bytes: int,
           block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """(block, ids, blob): documents in blocks of about ``block_bytes``, dealt
    by block; null text is empty. Ids travel as strings, so that a null among
    them doesn't turn the others into floats. The exchange is one that a plan
    which uses the blocks several times runs once."""
    d = docs.select(F.col(id_col).cast("string").alias("id"), F.col(text_col).alias("text"))

    def gather(batches):
        number = itertools.count(TaskContext.get().partitionId() << 32)
        ids, texts, size = [], [], 0
        for b in batches:
            for i, t in zip(b["id"], b["text"], strict=True):
                ids.append(i)
                texts.append(t.encode("utf-8", "surrogatepass") if t else b"")
                size += len(texts[-1])
                if size >= block_bytes:
                    yield pd.DataFrame({"block": [next(number)], "ids": [ids],
                                        "blob": [pack(texts)]})
                    ids, texts, size = [], [], 0
        if ids:
            yield pd.DataFrame({"block": [next(number)], "ids": [ids], "blob": [pack(texts)]})

    out = d.mapInPandas(gather, "block long, ids array<string>, blob binary")
    return out.repartition(max(8, -(-total_bytes // block_bytes)), "block")


class Hashes(dict):
    """64-bit hash of each distinct word (bytes), remembered."""

    def __missing__(self, word: bytes) -> int:
        h = self[word] = xxhash.xxh3_64_intdigest(word)
        return h

    def of(self, words: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), np.uint64, len(words))


MIX = np.uint64(0x9E3779B97F4A7C15)


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijective finaliser of 64-bit values."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def runs(h: np.ndarray, k: int, base: int) -> np.ndarray:
    """Polynomials of all runs of k consecutive words, put together from runs of
    1, 2, 4, ... words."""
    n = len(h) - k + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    out, done, part, size, power = None, 0, h, 1, np.uint64(base)   # power: base ** size
    with np.errstate(over="ignore"):
        while True:
            if k & size:
                add = part[done:done + n]
                out = add.copy() if out is None else out * power + add
                done += size
            if 2 * size > k:
                return out
            part = part[:-size] * power + part[size:]
            size, power = 2 * size, power * power


def shingles(h: np.ndarray, k: int, base: int = 0x9E3779B97F4A7C15) -> np.ndarray:
    """Hashes of all runs of k consecutive words."""
    return mixed(runs(h, k, base))


def by_bucket(keys: np.ndarray, buckets: int):
    """Order of sorted distinct keys by bucket: (bucket, slice of order)."""
    where = (keys >> np.uint64(40)) % np.uint64(buckets)
    order = np.argsort(where, kind="stable")
    where = where[order].astype(np.int64)
    cuts = np.flatnonzero(np.diff(where)) + 1
    for part in np.split(order, cuts):
        if len(part):
            yield int((keys[part[0]] >> np.uint64(40)) % np.uint64(buckets)), part


ASKED = "bucket int, block long, asked binary"
ANSWER = "block long, bucket int, answer binary"


def question(block: int, keys: np.ndarray, ids: np.ndarray, buckets: int) -> list[tuple]:
    """What a block asks about its keys: per distinct key the smallest and
    largest id (of any kind, int64) and how many entries it has. One row per
    bucket; the answer comes back in the same order (sorted by key)."""
    if not len(keys):
        return []
    order = np.argsort(keys, kind="stable")
    keys, ids = keys[order], ids[order]
    first = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]])
    low, high = np.minimum.reduceat(ids, first), np.maximum.reduceat(ids, first)
    n = np.diff(np.r_[first, len(keys)]).astype(np.uint32)
    keys = keys[first]
    return [(k, block, pack_arrays(keys[at], low[at], high[at] - low[at], n[at]))
            for k, at in by_bucket(keys, buckets)]


def meet(rows: pd.DataFrame):
    """All questions of a bucket. Per block: the block, its keys, their
    largest id in the block, their smallest and largest id anywhere, and
    their entries anywhere."""
    parts = [unpack_arrays(a, np.uint64, np.int64, np.int64, np.uint32) for a in rows["asked"]]
    keys, low, span, n = (np.concatenate(x) for x in zip(*parts, strict=True))
    high = low + span
    order = np.argsort(keys, kind="stable")
    ordered = keys[order]
    new = np.r_[True, ordered[1:] != ordered[:-1]]
    first = np.flatnonzero(new)
    group = np.empty(len(keys), np.int64)
    group[order] = np.cumsum(new) - 1
    low_all = np.minimum.reduceat(low[order], first)[group]
    high_all = np.maximum.reduceat(high[order], first)[group]
    n_all = np.add.reduceat(n[order].astype(np.int64), first)[group]
    ends = np.cumsum([len(p[0]) for p in parts])
    for block, end, p in zip(rows["block"], ends, parts, strict=True):
        at = slice(end - len(p[0]), end)
        yield block, keys[at], high[at], low_all[at], high_all[at], n_all[at]
