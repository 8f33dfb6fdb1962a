"""Jaccard join of word n-gram sets by signature trees, exact.

A signature tree holds documents in leaves; every node has the OR of its
documents' token bitmaps, its range of set sizes and the largest number of
tokens that share a bit. Two trees (or one with itself) are traversed
together; a pair of nodes whose greatest possible overlap cannot reach the
threshold is left out, and pairs of documents that remain are compared on
their token sets. Documents that are already connected aren't compared.

Trees are built over parts of the documents that can be linked at all:

1. Documents with the same set are one class.
2. A class looks at its smallest tokens by hash, enough that a linked class
   must share ``l`` of them (prefix filter); blocks ask in which other
   classes these occur (see ``blocks``). Classes that share too few have no
   link and are done.
3. The rest are joined into parts through their rare shared tokens: the
   ``l - 1`` most frequent ones can be left out, since two linked classes
   share ``l``. A link never leaves a part.
4. A part is one tree; a part too large for one task is cut into pieces by
   size class and hash, and each pair of pieces whose sizes can match is one
   dual traversal, so no task holds an unbounded group and no pair is lost.

Sets and words are compared by 64-bit hashes. Defined results: null, empty
and word-less texts have an empty set and link with nothing; a text with
fewer than ``n`` words is one token; rows with the same id count as one
document in components; a row with a null id has a null component; other
columns are ignored; empty table, empty result.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from kestrel.llm.blocks import (ANSWER, ASKED, BLOCK_BYTES, Hashes, blocks, buckets_for,
                                by_bucket, meet, of_one, of_two, pack_arrays, question,
                                release, shingles, text_bytes, unpack, unpack_arrays,
                                whole_numbers)
from kestrel.llm.components import components
from kestrel.llm.rows import row_digest
from kestrel.session import materialize

BITS = 4096
FAN = 8
PAIRS = 1 << 16          # node pairs bounded at a time


# ------------------------------------------------------------ token sets

def token_set(raw: bytes, hashes: Hashes, n: int) -> np.ndarray:
    """Sorted distinct hashes of the n-word shingles (A-Z lower-cased)."""
    words = raw.lower().split()
    if not words:
        return np.zeros(0, np.uint64)
    return np.unique(shingles(hashes.of(words), min(n, len(words))) ^ np.uint64(min(n, len(words))))


def needed(size: int, threshold: int) -> int:
    """Least overlap of a set of this size with any linked set."""
    return -(-threshold * size // 100)


def shared_least(size: int) -> int:
    """``l``: prefix tokens that a linked set of at least this size shares."""
    return size // 10 + 1


def prefix_length(size: int, threshold: int) -> int:
    return min(size, size - needed(size, threshold) + shared_least(size))


# --------------------------------------------------------- signature tree

class SignatureTree:
    """Levels of nodes over documents ordered by size, then smallest token."""

    def __init__(self, ids, tokens: list[np.ndarray]):
        sizes = np.array([len(t) for t in tokens], np.int64)
        first = np.array([t[0] for t in tokens], np.uint64)
        order = np.lexsort((first, sizes))
        self.ids = [ids[i] for i in order]
        self.tokens = [tokens[i] for i in order]
        n = len(order)
        bits = np.zeros((n, BITS // 8), np.uint8)
        for i, t in enumerate(self.tokens):
            at = (t % np.uint64(BITS)).astype(np.int64)
            np.bitwise_or.at(bits[i], at >> 3, (1 << (at & 7)).astype(np.uint8))
        bitmap = bits.view(np.uint64)
        low = high = sizes[order]
        slack = low - np.bitwise_count(bitmap).sum(axis=1, dtype=np.int64)
        self.levels = [(bitmap, low, high, slack)]
        while len(self.levels[-1][0]) > FAN:
            bitmap, low, high, slack = self.levels[-1]
            at = np.arange(0, len(bitmap), FAN)
            self.levels.append((np.bitwise_or.reduceat(bitmap, at, axis=0),
                                np.minimum.reduceat(low, at), np.maximum.reduceat(high, at),
                                np.maximum.reduceat(slack, at)))


def _possible(x, y, a, b, threshold):
    """Which node pairs may hold a link: greatest overlap against the least."""
    overlap = np.bitwise_count(x[0][a] & y[0][b]).sum(axis=1, dtype=np.int64)
    overlap += np.minimum(x[3][a], y[3][b])
    overlap = np.minimum(overlap, np.minimum(x[2][a], y[2][b]))
    return (100 + threshold) * overlap >= threshold * (x[1][a] + y[1][b])


def candidates(x: SignatureTree, y: SignatureTree, threshold: int):
    """Dual traversal: arrays of document places (in x, in y) that may link.
    With x is y every pair once."""
    same = x is y
    depth = max(len(x.levels), len(y.levels)) - 1

    def level(t, d):
        return t.levels[min(d, len(t.levels) - 1)]

    def children(t, d, nodes):
        """Nodes one level below; a shorter tree waits at its top."""
        if d >= len(t.levels):
            return nodes[:, None]
        n = len(t.levels[d - 1][0])
        out = nodes[:, None] * FAN + np.arange(FAN)
        return np.where(out < n, out, -1)

    a, b = np.meshgrid(np.arange(len(level(x, depth)[0])), np.arange(len(level(y, depth)[0])),
                       indexing="ij")
    stack = [(depth, a.ravel(), b.ravel())]
    while stack:
        d, a, b = stack.pop()
        if same:
            keep = a <= b if d else a < b
            a, b = a[keep], b[keep]
        if len(a) > PAIRS:
            stack += [(d, a[i:i + PAIRS], b[i:i + PAIRS]) for i in range(0, len(a), PAIRS)]
            continue
        ok = _possible(level(x, d), level(y, d), a, b, threshold)
        a, b = a[ok], b[ok]
        if not len(a):
            continue
        if d == 0:
            yield a, b
            continue
        ca, cb = children(x, d, a), children(y, d, b)
        na = np.repeat(ca[:, :, None], cb.shape[1], axis=2).ravel()
        nb = np.repeat(cb[:, None, :], ca.shape[1], axis=1).ravel()
        real = (na >= 0) & (nb >= 0)
        stack.append((d - 1, na[real], nb[real]))


def links(x: SignatureTree, y: SignatureTree, threshold: int) -> list[tuple]:
    """Links that connect everything that is linked (a spanning forest)."""
    n = len(x.ids)
    offset = 0 if x is y else n
    label = np.arange(n + (0 if x is y else len(y.ids)))
    out = []
    for a, b in candidates(x, y, threshold):
        for i in range(0, len(a), 1024):
            p, q = a[i:i + 1024], b[i:i + 1024]
            open_ = label[p] != label[q + offset]
            for d, e in zip(p[open_].tolist(), q[open_].tolist(), strict=True):
                if label[d] == label[e + offset]:
                    continue
                s, t = x.tokens[d], y.tokens[e]
                both = len(np.intersect1d(s, t, assume_unique=True))
                if 100 * both >= threshold * (len(s) + len(t) - both):
                    out.append((x.ids[d], y.ids[e]))
                    label[label == label[e + offset]] = label[d]
    return out


# ---------------------------------------------------------------- the join

#: Token sets of one side of a traversal, and of the small parts in one group
#: on average.
PIECE_BYTES = 64 << 20


def _profiles(docs, n, threshold, id_col, text_col, block_bytes):
    """(id, size, class, rare, tokens) per row; ``rare`` and ``tokens`` only
    for classes that may have a link."""
    total = text_bytes(docs, text_col)
    buckets = buckets_for(total)
    b = blocks(docs, id_col, text_col, total, block_bytes)

    def sets(block):
        hashes = Hashes()
        ids = whole_numbers(block["ids"].iat[0])
        for i, raw in zip(ids, unpack(block["blob"].iat[0]), strict=True):
            t = token_set(raw, hashes, n)
            yield i, t, xxhash.xxh3_128_digest(t.tobytes())

    def prefixes(block):
        """Prefix tokens of the block's classes, each class once."""
        seen, keys, owners = set(), [], []
        for _, t, c in sets(block):
            if len(t) and c not in seen:
                seen.add(c)
                p = t[:prefix_length(len(t), threshold)]
                keys.append(p)
                owners.append(np.full(len(p), int.from_bytes(c[:6], "little"), np.int64))
        if not keys:
            return np.zeros(0, np.uint64), np.zeros(0, np.int64)
        return np.concatenate(keys), np.concatenate(owners)

    def ask(batches):
        for batch in batches:
            for i in range(len(batch)):
                block = batch.iloc[i:i + 1]
                yield pd.DataFrame(question(block["block"].iat[0], *prefixes(block), buckets),
                                   columns=["bucket", "block", "asked"])
                release()

    def frequencies(rows: pd.DataFrame) -> pd.DataFrame:
        """In how many classes a token occurs (0: in one only)."""
        bucket = rows["bucket"].iat[0]
        return pd.DataFrame(
            [(blk, bucket, pack_arrays(np.where(lo == hi, 0, np.minimum(m, 65535))
                                       .astype(np.uint16)))
             for blk, _, _, lo, hi, m in meet(rows)], columns=["block", "bucket", "answer"])

    def profile(block: pd.DataFrame, answers: pd.DataFrame) -> pd.DataFrame:
        cols = ["id", "size", "class", "rare", "tokens"]
        if not len(block):
            return pd.DataFrame({c: [] for c in cols})
        keys = np.unique(prefixes(block)[0])
        df = np.zeros(len(keys), np.uint16)
        got = dict(zip(answers["bucket"], answers["answer"], strict=True))
        for k, at in by_bucket(keys, buckets):
            df[at] = unpack_arrays(got[k], np.uint16)[0]
        out, seen = [], set()
        for i, t, c in sets(block):
            rare = tokens = None
            if len(t):
                p = t[:prefix_length(len(t), threshold)]
                f = df[np.searchsorted(keys, p)]
                least = shared_least(needed(len(t), threshold))
                if (f > 0).sum() >= least and i is not None:
                    order = np.lexsort((p, f))
                    order = order[:len(order) - (least - 1)]
                    rare = p[order][f[order] > 0].view(np.int64).tolist()
                    if c not in seen:
                        seen.add(c)
                        tokens = t.tobytes()
            out.append((i, len(t), c, rare if tokens else None, tokens))
        return pd.DataFrame(out, columns=cols).astype({"id": object})

    answers = b.mapInPandas(ask, ASKED).groupBy("bucket").applyInPandas(
        of_one(frequencies), ANSWER)
    return materialize(b.groupBy("block").cogroup(answers.groupBy("block")).applyInPandas(
        of_two(profile), "id long, size long, class binary, rare array<long>, tokens binary"),
        "shingle-profiles")


def _tree_of(rows: pd.DataFrame) -> SignatureTree:
    return SignatureTree(rows["c"].tolist(),
                         [np.frombuffer(t, np.uint64) for t in rows["tokens"]])


def _part_links(threshold):
    def run(rows: pd.DataFrame) -> pd.DataFrame:
        out = []
        for (_, i, j), g in rows.groupby(["part", "i", "j"]):
            if i == j:
                t = _tree_of(g)
                out += links(t, t, threshold)
            else:
                sides = [_tree_of(s) for _, s in g.groupby("piece")]
                if len(sides) == 2:
                    out += links(*sides, threshold)
        return pd.DataFrame(out, columns=["a", "b"])
    return run


def _cells(parts: DataFrame, threshold: int, piece_rows: int,
           piece_bytes: int = PIECE_BYTES) -> DataFrame:
    """(c, part, size) -> (c, part, i, j, piece, deal): the dual traversals
    that a class takes part in. Narrow rows; the token sets join later. Parts
    and pieces are cut by rows and by the bytes of their sets, 8 a shingle."""
    by_part, by_class = Window.partitionBy("part"), Window.partitionBy("part").orderBy("cls")
    step = 1.0001 * float(np.log(100 / threshold))   # linked sizes differ by one class at most
    p = parts.withColumn("cls", F.floor(F.log("size") / step).cast("int"))
    stats = p.groupBy("part", "cls").agg(F.count(F.lit(1)).alias("n"),
                                         (8 * F.sum("size")).alias("bytes"))
    stats = stats.withColumn("large", (F.sum("n").over(by_part) > piece_rows)
                             | (F.sum("bytes").over(by_part) > piece_bytes))
    k = F.greatest(F.ceil(F.col("n") / piece_rows), F.ceil(F.col("bytes") / piece_bytes)).cast(
        "int")
    total = parts.agg(8 * F.sum("size")).first()[0] or 0
    deals = max(512, -(-total // piece_bytes))

    def beside(step_):
        same = F.lag("cls", step_).over(by_class) == F.col("cls") - step_
        return F.when(same, F.lag(k, step_).over(by_class)).otherwise(0)

    stats = stats.select("part", "cls", "large", k.alias("k"), beside(1).alias("below"),
                         beside(-1).alias("above"))

    def pieces(cls, n):
        names = F.transform(F.sequence(F.lit(0), F.greatest(n, F.lit(1)) - 1),
                            lambda x: cls.cast("long") * (1 << 20) + x)
        return F.when(n > 0, names).otherwise(F.array().cast("array<bigint>"))

    c = F.col("cls")
    others = F.concat(pieces(c - 1, F.col("below")), pieces(c, F.col("k")),
                      pieces(c + 1, F.col("above")))
    none = F.lit(0).cast("long")
    own = c.cast("long") * (1 << 20) + F.pmod(F.xxhash64("c", "size"), F.col("k"))
    p = p.join(stats, ["part", "cls"])
    p = p.withColumn("piece", F.when(F.col("large"), own).otherwise(none))
    p = p.withColumn("other", F.explode(F.when(F.col("large"), others).otherwise(F.array(none))))
    i, j = F.least("piece", "other"), F.greatest("piece", "other")
    # small parts share a group, traversals of large ones are groups of their own
    deal = F.when(F.col("large"), F.xxhash64("part", i, j)).otherwise(
        F.pmod(F.xxhash64("part"), F.lit(deals)))
    return p.select("c", "part", i.alias("i"), j.alias("j"), "piece", deal.alias("deal"))


def jaccard_join(docs: DataFrame, *, n: int = 5, threshold: int = 80,
                 id_col: str = "doc_id", text_col: str = "text",
                 piece_rows: int = 6000, block_bytes: int = BLOCK_BYTES,
                 piece_bytes: int = PIECE_BYTES) -> DataFrame:
    """One row per input row: id, n_shingles, component_id. Two documents link
    when 100 * overlap >= ``threshold`` * union of their n-word shingles."""
    prof = _profiles(docs, n, threshold, id_col, text_col, block_bytes)
    prof = prof.withColumn("c", F.when(F.col("size") > 0, F.xxhash64("class")))
    rare = prof.where("rare IS NOT NULL").select("c", F.explode("rare").alias("token"))
    low = materialize(rare.groupBy("token").agg(F.min("c").alias("low")),
                      "least-classes")    # a table of its own: a hot token can be split
    parts = components(rare.join(low, "token"), "c", "low")
    sizes = prof.where("tokens IS NOT NULL").select("c", "size").distinct()
    parts = sizes.join(parts.select(F.col("node").alias("c"), F.col("component").alias("part")),
                       "c")
    cells = _cells(materialize(parts, "parts"), threshold, piece_rows, piece_bytes)
    # the token sets travel to their class once, and then to its traversals
    sets = (prof.where("tokens IS NOT NULL").select("c", "class", "tokens")
            .repartition("c").dropDuplicates(["c", "class"]))
    found = (cells.join(sets, "c").select("deal", "part", "i", "j", "piece", "c", "tokens")
             .groupBy("deal").applyInPandas(of_one(_part_links(threshold)), "a long, b long"))
    joined = components(found, "a", "b").withColumnRenamed("node", "c")
    d = prof.select("id", "size", "c").join(joined, "c", "left").withColumn(
        "g", F.coalesce("component", "c"))
    least = materialize(d.where("g IS NOT NULL").groupBy("g").agg(F.min("id").alias("least")),
                        "least-ids")       # a table of its own: a hot class can be split
    return d.join(least, "g", "left").select(
        "id", F.col("size").alias("n_shingles"),
        F.when(F.col("id").isNotNull(), F.coalesce("least", "id")).alias("component_id"))


def one_of_each(docs: DataFrame, *, n: int = 5, threshold: int = 80, id_col: str = "doc_id",
                text_col: str = "text", **bounds) -> DataFrame:
    """The rows of ``docs``, with its columns, but of each group of linked
    documents only the one with the smallest id (of several such, the smallest
    digest of all columns): the same rows in any layout of the table."""
    held = materialize(docs.withColumn("__row", F.monotonically_increasing_id()).withColumn(
        "__digest", row_digest(docs.columns)), "near-docs")
    found = jaccard_join(held, n=n, threshold=threshold, id_col="__row", text_col=text_col,
                         **bounds).select(F.col("id").alias("__row"), "component_id")
    named = found.join(held.select("__row", id_col, "__digest"), "__row").select(
        "component_id", F.struct(id_col, "__digest", "__row").alias("name"))
    first = materialize(named.groupBy("component_id").agg(
        F.count(F.lit(1)).alias("n"), F.min("name").alias("first")).where("n > 1"),
        "near-first")                # a table of its own: a hot group can be split
    gone = named.join(first, "component_id").where(F.col("name") != F.col("first"))
    # a table of its own: of known size, so that texts move only if it is large
    gone = materialize(gone.select(F.col("name.__row").alias("__row")), "near-gone")
    return held.join(gone, "__row", "left_anti").select(*docs.columns)
