"""Alternating least squares on blocks of packed ratings.

The same model as Spark ML's ``ALS`` (explicit ratings, regularisation weighted by
the number of ratings, normal equations in double precision, factors in single):

1. Either side's ratings are packed once into chunks of whole rows (a user's or
   an item's ratings), sorted, and dealt to blocks; a chunk knows which blocks of
   the other side need its rows.
2. A half iteration brings a block the factors it needs, each once, next to its
   chunks, which stay where they are (both are partitioned alike). Chunks stream
   through, rows of equally many ratings are solved together, and their factors
   go to the blocks that need them.

A block holds the factors it needs and one chunk, and not its ratings, so blocks
can be few (which is what the traffic follows) and large.
"""

from __future__ import annotations

import gc
from concurrent.futures import ThreadPoolExecutor

import numpy as np
import pyarrow as pa
from pyspark import RDD
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kestrel.session import checkpoint_dir

CHUNK_RATINGS = 2_000_000    # packed by one task
SOLVED_ROWS = 1 << 12        # at once
SOLVED_RATINGS = 1 << 16     # at once
CHECKPOINT_INTERVAL = 5      # iterations
SPREAD = 2_654_435_761


def _block(codes: np.ndarray, blocks: int) -> np.ndarray:
    return ((codes.astype(np.int64) * SPREAD) >> 15) % blocks


def _packer(blocks: int):
    """mapInArrow: ratings (x, y, r) of whole rows, out come chunks by block."""
    def chunk(x, y, r):
        starts = np.flatnonzero(np.r_[True, x[1:] != x[:-1]])
        size = np.diff(np.r_[starts, len(x)])
        order = np.argsort(size, kind="stable")          # rows of equal size together
        firsts = np.repeat(starts[order] - np.r_[0, np.cumsum(size[order])[:-1]], size[order])
        at = firsts + np.arange(len(x))
        x, y, r, size = x[starts][order], y[at], r[at], size[order]
        needed = np.zeros((len(x), blocks), bool)
        needed[np.repeat(np.arange(len(x)), size), _block(y, blocks)] = True
        return b"".join((np.array([len(x), len(y)], np.int64).tobytes(), x.tobytes(),
                         size.astype(np.int32).tobytes(), np.packbits(needed).tobytes(),
                         y.tobytes(), r.tobytes()))

    def run(batches):
        held = [b for b in batches if b.num_rows]
        if not held:
            return
        x, y, r = (np.concatenate([b.column(k).to_numpy() for b in held]) for k in "xyr")
        held.clear()
        key = x.astype(np.int64) << 32 | y
        order = np.argsort(key)
        if (np.diff(key[order]) == 0).any():
            order = np.lexsort((r, key))
        x, y, r = x[order], y[order], r[order]
        block = _block(x, blocks)
        for k in np.unique(block).tolist():
            own = block == k
            yield pa.RecordBatch.from_arrays(
                [pa.array([k], pa.int32()), pa.array([chunk(x[own], y[own], r[own])], pa.binary())],
                names=["block", "chunk"])
    return run


def _unpacked(blob: bytes, blocks: int):
    """(x, size, needed, y, r) of a chunk."""
    m, k = np.frombuffer(blob, np.int64, 2).tolist()
    at, out = 16, []
    for kind, n in ((np.int32, m), (np.int32, m), (np.uint8, -(-m * blocks // 8)),
                    (np.int32, k), (np.float32, k)):
        out.append(np.frombuffer(blob, kind, n, at))
        at += out[-1].nbytes
    out[2] = np.unpackbits(out[2], count=m * blocks).reshape(m, blocks).astype(bool)
    return out


def _solve(a: np.ndarray) -> np.ndarray:
    """Solutions of the symmetric systems in ``a`` (n, k + 1, k + 1), the last
    column the right side, by Cholesky's method for all of them at a time."""
    k = a.shape[1] - 1
    low = np.ascontiguousarray(a.transpose(2, 1, 0))     # [column, row, system]
    for j in range(k):                                   # the last row is the right side, solved
        for i in range(j):
            low[j, j:] -= low[i, j:] * low[i, j]
        with np.errstate(invalid="ignore", divide="ignore"):
            low[j, j:] /= np.sqrt(low[j, j])
    x = low[:k, k].copy()
    for j in range(k - 1, -1, -1):
        for i in range(j + 1, k):
            x[j] -= low[j, i] * x[i]
        x[j] /= low[j, j]
    if not np.isfinite(x).all():
        raise np.linalg.LinAlgError("a system of the fit is singular; use a regularisation above 0")
    return x.T.astype(np.float32)


def _solved(size, y, r, factors, reg: float, pool) -> np.ndarray:
    """Factors of the rows of a chunk; ``y``: positions in ``factors``; ``pool``:
    threads that solve parts of it."""
    rank = factors.shape[1]
    starts = np.cumsum(size.astype(np.int64)) - size
    out = np.empty((len(size), rank), np.float32)

    def solve(first: int) -> None:
        last = min(first + SOLVED_ROWS, len(size))
        a = np.zeros((last - first, rank + 1, rank + 1))
        row = first
        while row < last:
            c = int(size[row])
            end = min(int(np.searchsorted(size, c, "right")), last, row + max(1, SOLVED_RATINGS // c))
            for at in range(0, c, SOLVED_RATINGS):       # one piece but for rows of very many
                n = min(c - at, SOLVED_RATINGS)
                cut = slice(int(starts[row]) + at, int(starts[row]) + (end - row - 1) * c + at + n)
                z = np.empty((end - row, n, rank + 1))
                z[:, :, :rank] = np.take(factors, y[cut], 0, mode="clip").reshape(end - row, n, rank)
                z[:, :, rank] = r[cut].reshape(end - row, n)
                a[row - first:end - first] += z.transpose(0, 2, 1) @ z
            row = end
        a[:, np.arange(rank), np.arange(rank)] += reg * size[first:last, None]
        out[first:last] = _solve(a)

    list(pool.map(solve, range(0, len(size), SOLVED_ROWS)))
    return out


def _parted(x, needed, factors):
    for b in range(needed.shape[1]):
        own = needed[:, b]
        if own.any():
            yield b, ("factors", x[own].tobytes(), factors[own].tobytes())


class _Factors:
    """Factors that have arrived at a block, by their codes (below ``codes``)."""

    def __init__(self, messages: list, codes: int, rank: int):
        ids = np.concatenate([np.frombuffer(x, np.int32) for x, _ in messages])
        self.at = np.zeros(codes, np.int32)
        self.at[ids] = np.arange(len(ids), dtype=np.int32)
        self.rows = np.concatenate([np.frombuffer(f, np.float32) for _, f in messages]).reshape(-1, rank)


def _streamed(rows, blocks: int, codes: int, rank: int):
    """(factors, chunk) of the chunks of a block, which come after its factors."""
    messages, factors = [], None
    for _, (kind, *data) in rows:
        if kind == "factors":
            messages.append(data)
            continue
        if factors is None:
            factors = _Factors(messages, codes, rank)
            messages.clear()
        yield factors, _unpacked(data[0], blocks)


def _starter(blocks: int, rank: int, codes: int):
    """A block: the start factors of its rows, then its chunks."""
    def run(rows):
        for start, (x, _, needed, _, _) in _streamed(rows, blocks, codes, rank):
            yield from _parted(x, needed, start.rows[start.at[x]])
    return run


def _dealer(blocks: int):
    """mapInArrow: start factors (id, features), out come those of a block."""
    def run(batches):
        for batch in batches:
            x = batch.column("id").to_numpy()
            f = batch.column("features").flatten().to_numpy().reshape(len(x), -1)
            block = _block(x, blocks)
            for k in np.unique(block).tolist():
                own = block == k
                yield pa.RecordBatch.from_arrays(
                    [pa.array([k], pa.int32()), pa.array([x[own].tobytes()], pa.binary()),
                     pa.array([f[own].tobytes()], pa.binary())], names=["block", "x", "f"])
    return run


def _stepper(blocks: int, rank: int, reg: float, codes: int, threads: int, final: bool = False):
    """A block: the factors it needs, then its chunks. Out come factors by block
    of the other side, or with ``final`` once. ``codes``: of the other side."""
    def run(rows):
        with ThreadPoolExecutor(threads) as pool:
            for known, (x, size, needed, y, r) in _streamed(rows, blocks, codes, rank):
                own = _solved(size, known.at[y], r, known.rows, reg, pool)
                if final:
                    yield bytearray(x.tobytes()), bytearray(own.tobytes())
                else:
                    yield from _parted(x, needed, own)
    return run


def _rows(rank: int):
    def run(batches):
        for batch in batches:
            for x, f in zip(batch.column("x"), batch.column("f"), strict=True):
                ids = pa.array(np.frombuffer(x.as_py(), np.int32))
                flat = pa.array(np.frombuffer(f.as_py(), np.float32))
                ends = pa.array(np.arange(0, len(flat) + 1, rank, dtype=np.int32))
                yield pa.RecordBatch.from_arrays(
                    [ids, pa.ListArray.from_arrays(ends, flat)], names=["id", "features"])
    return run


def _chunks(ratings: DataFrame, x: str, y: str, n: int, blocks: int) -> RDD:
    tasks = max(ratings.sparkSession.sparkContext.defaultParallelism, -(-n // CHUNK_RATINGS))
    packed = ratings.select(F.col(x).alias("x"), F.col(y).alias("y"), "r").repartition(
        tasks, "x").mapInArrow(_packer(blocks), "block int, chunk binary")
    return packed.rdd.map(lambda c: (c[0], ("chunk", bytes(c[1])))).partitionBy(blocks, _itself)


def _itself(block: int) -> int:
    return block


def fit(ratings: DataFrame, start: DataFrame, n: int, users: int, items: int, blocks: int,
        rank: int, max_iter: int, reg: float) -> tuple[DataFrame, DataFrame]:
    """(user factors, item factors), each (id int, features array<float>), of
    ``n`` ratings (user int, item int, r float; none null), from the user factors
    ``start`` (id int, features array<float>). ``users``, ``items``: their ids are
    below that."""
    if not n or max_iter < 1:
        raise ValueError("a fit needs ratings and an iteration")
    spark = ratings.sparkSession
    checkpoint_dir(spark)
    # a step has one task a block; the cores that this leaves idle are its threads
    threads = max(1, spark.sparkContext.defaultParallelism // blocks)
    by_user = _chunks(ratings, "user", "item", n, blocks)
    by_item = _chunks(ratings, "item", "user", n, blocks)

    def step(factors: RDD, chunks: RDD, codes: int, final: bool = False) -> RDD:
        both = factors.union(chunks)             # partitioned alike: nothing is shuffled
        return both.mapPartitions(_stepper(blocks, rank, reg, codes, threads, final))

    dealt = start.mapInArrow(_dealer(blocks), "block int, x binary, f binary").rdd.map(
        lambda s: (s[0], ("factors", bytes(s[1]), bytes(s[2])))).partitionBy(blocks, _itself)
    own = dealt.union(by_user).mapPartitions(_starter(blocks, rank, users)).partitionBy(blocks, _itself)
    for i in range(1, max_iter + 1):
        of_items = step(own, by_item, users)
        if i == max_iter:
            break
        own = step(of_items.partitionBy(blocks, _itself), by_user, items).partitionBy(blocks, _itself)
        if i % CHECKPOINT_INTERVAL == 0:
            own.checkpoint()                     # lineage is cut
            own.count()
            del of_items                         # the shuffles behind it are garbage,
            gc.collect()                         # and Spark removes them when the JVM
            spark.sparkContext._jvm.System.gc()  # collects it
    schema = "x binary, f binary"
    out = (step(of_items.partitionBy(blocks, _itself), by_user, items, final=True),
           step(own, by_item, users, final=True))
    return tuple(spark.createDataFrame(o, schema).mapInArrow(
        _rows(rank), "id int, features array<float>") for o in out)
