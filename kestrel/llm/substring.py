"""Substring dedup by relative Lempel-Ziv parsing.

Documents are parsed against an index of all reference blocks that maps each
window of ``window`` words to its first occurrence: the document with the
smallest id, and the position there. A parse goes through a document greedily:
a factor starts at the first window with an occurrence in a smaller document
and grows by a word as long as the next window's first occurrence is the next
position of the same document; the words of the factor are then those of the
reference from ``position`` on (``factors`` reports both). Where that ends,
the windows across the border have been looked up too: if they occur in a
smaller document, the next factor starts there, overlapping the first. Every
factor has at least ``window`` words, and all its words are duplicates.

The index of the reference blocks is built in two steps. Each window has an
anchor (its smallest ``gram``-word hash); blocks ask which of their anchors
occur in two documents, which leaves unique text out. Of the windows at
shared anchors they then ask for the first occurrence. Both questions
are keyed and combined (see ``blocks``): a line that a third of all documents
hold costs one entry a block.

Windows are compared by a 64-bit hash and 32 bits of another one, both made of
64-bit word hashes. Anchors are compared by 64 bits: a clash there only asks
about some windows more.

Defined results: null, empty and short texts lose nothing; a row with a null
id is neither a reference nor cut; rows with the same id don't count as
references of each other; other columns are ignored; empty table, empty
result.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame

from kestrel.llm.blocks import (ANSWER, ASKED, BLOCK_BYTES, Hashes, blocks, buckets_for,
                                by_bucket, meet, pack_arrays, question, runs, shingles,
                                text_bytes, unpack, unpack_arrays, whole_numbers)

NONE = np.iinfo(np.int64).max


class Parsed:
    """Words of one document, and its windows and anchors when asked for."""

    def __init__(self, raw: bytes, hashes: Hashes, window: int, gram: int):
        self.words = raw.split()
        self.n_windows = max(0, len(self.words) - window + 1)
        self._sizes = window, gram
        if self.n_windows:
            self._hashes = hashes.of(self.words)

    def forget_words(self) -> "Parsed":
        self.words = None
        return self

    def windows(self) -> tuple[np.ndarray, np.ndarray]:
        """Key and check of every window."""
        size = self._sizes[0]
        check = runs(self._hashes, size, 0xC2B2AE3D27D4EB4F) >> np.uint64(32)
        return shingles(self._hashes, size, 0xD6E8FEB86659FD93), check.astype(np.uint32)

    def anchors(self) -> np.ndarray:
        """The anchor of every window."""
        window, gram = self._sizes
        low, span, size = shingles(self._hashes, gram), window - gram + 1, 1
        while size < span:                     # minima of 2, 4, ..., span neighbours
            step = min(size, span - size)
            low, size = np.minimum(low[:-step], low[step:]), size + step
        return low


def _documents(block: pd.DataFrame, window: int, gram: int):
    hashes = Hashes()
    ids = whole_numbers(block["ids"].iat[0])
    for i, raw in zip(ids, unpack(block["blob"].iat[0]), strict=True):
        yield i, Parsed(raw, hashes, window, gram)


def _shared_anchors(rows: pd.DataFrame) -> pd.DataFrame:
    """Which keys occur in two documents; a mask in the order asked."""
    bucket = rows["bucket"].iat[0]
    return pd.DataFrame([(b, bucket, np.packbits(lo != hi).tobytes())
                         for b, _, _, lo, hi, _ in meet(rows)],
                        columns=["block", "bucket", "answer"])


# key, check, first document and position there, largest document less the first
WINDOW = (np.uint64, np.uint32, np.int64, np.uint32, np.int64)


def _order(keys, checks):
    """Order by window, otherwise as given, and the starts of the windows."""
    order = np.argsort(keys, kind="stable")
    for _ in range(2):
        k, c = keys[order], checks[order]
        apart = k[1:] != k[:-1]
        clash = ~apart & (c[1:] != c[:-1])
        if not clash.any():
            break
        order = np.lexsort((checks, keys))     # two windows of one key
    return order, np.flatnonzero(np.r_[True, apart | clash])


def _ask_first(block: int, keys, checks, ids, at, buckets: int) -> list[tuple]:
    """What a block asks about its windows, given by document and position;
    one row per bucket."""
    if not len(keys):
        return []
    order, start = _order(keys, checks)
    high = ids[order][np.r_[start[1:], len(order)] - 1]       # ids ascend in a window
    first = order[start]
    keys, checks, ids, at = keys[first], checks[first], ids[first], at[first]
    return [(k, block, pack_arrays(keys[p], checks[p], ids[p], at[p], high[p] - ids[p]))
            for k, p in by_bucket(keys, buckets)]


def _references(rows: pd.DataFrame) -> pd.DataFrame:
    """First occurrences of the windows that occur in a smaller document."""
    parts = [unpack_arrays(a, *WINDOW) for a in rows["asked"]]
    keys, checks, ids, at, span = (np.concatenate(x) for x in zip(*parts, strict=True))
    order, start = _order(keys, checks)
    size = np.diff(np.r_[start, len(order)])
    ordered = ids[order]
    lows = np.repeat(np.minimum.reduceat(ordered, start), size)
    places = np.where(ordered == lows, at[order], np.iinfo(np.uint32).max)
    low, place = np.empty_like(ids), np.empty_like(at)
    low[order] = lows
    place[order] = np.repeat(np.minimum.reduceat(places, start), size)
    dup = low < ids + span
    out, bucket, end = [], rows["bucket"].iat[0], 0
    for b, p in zip(rows["block"], parts, strict=True):
        begin, end = end, end + len(p[0])
        mine = begin + np.flatnonzero(dup[begin:end])
        if len(mine):
            out.append((b, bucket, pack_arrays(keys[mine], checks[mine], low[mine],
                                               place[mine])))
    return pd.DataFrame(out, columns=["block", "bucket", "answer"])


class Index:
    """First occurrences of a block's windows, from the answers it got."""

    def __init__(self, answers):
        parts = [unpack_arrays(a, *WINDOW[:4]) for a in answers]
        kept = [np.concatenate([p[k] for p in parts]) if parts else np.zeros(0, kind)
                for k, kind in enumerate(WINDOW[:4])]
        order = np.argsort(kept[0], kind="stable")
        self.keys, self.checks, self.ids, self.at = (x[order] for x in kept)

    def look_up(self, keys: np.ndarray, checks: np.ndarray):
        """Document (``NONE``: none) and position of every window."""
        ref, at = np.full(len(keys), NONE, np.int64), np.zeros(len(keys), np.int64)
        if not len(self.keys):
            return ref, at
        near = np.searchsorted(self.keys, keys)
        near[near == len(self.keys)] = 0
        todo = np.flatnonzero(self.keys[near] == keys)
        while len(todo):                   # again only where two windows share a key
            same = self.checks[near[todo]] == checks[todo]
            hit = todo[same]
            ref[hit], at[hit] = self.ids[near[hit]], self.at[near[hit]]
            todo = todo[~same]
            near[todo] += 1
            todo = todo[near[todo] < len(self.keys)]
            todo = todo[self.keys[near[todo]] == keys[todo]]
        return ref, at


def factors(reference: np.ndarray, position: np.ndarray,
            window: int) -> list[tuple[int, int, int, int]]:
    """The parse: (start, length in words, reference id, position there), from
    the first occurrence of every window (``NONE``: no reference)."""
    hit = np.flatnonzero(reference != NONE)
    if not len(hit):
        return []
    ref, at = reference[hit], position[hit]
    new = np.r_[True, (np.diff(hit) > 1) | (np.diff(ref) != 0) | (np.diff(at) != 1)]
    first = np.flatnonzero(new)
    starts, ends = hit[first], hit[np.r_[first[1:] - 1, len(hit) - 1]]
    return [(int(s), int(e - s + window), int(r), int(p))
            for s, e, r, p in zip(starts, ends, ref[first], at[first], strict=True)]


def substring_dedup(docs: DataFrame, *, window: int = 13, gram: int = 5,
                    id_col: str = "doc_id", text_col: str = "text",
                    block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """One row per input row: id, n_words, n_removed, kept (text of the words
    that stay, joined by one space) and factors (start, length, reference,
    position: the words of the reference from there on)."""
    total = text_bytes(docs, text_col)
    buckets = buckets_for(total)
    b = blocks(docs, id_col, text_col, total, block_bytes)

    def each(batches):
        for batch in batches:
            for i in range(len(batch)):
                yield batch.iloc[i:i + 1]

    def windowed(block):
        """(id, document) of the documents that can be referred to."""
        return ((i, p) for i, p in _documents(block, window, gram)
                if p.n_windows and i is not None)

    def distinct(a):
        return a[np.r_[True, a[1:] != a[:-1]]]

    def ask_anchors(batches):
        for block in each(batches):
            keys, ids = [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)]
            for i, p in windowed(block):
                keys.append(distinct(p.anchors()))
                ids.append(np.full(len(keys[-1]), i, np.int64))
            yield pd.DataFrame(question(block["block"].iat[0], np.concatenate(keys),
                                        np.concatenate(ids), buckets),
                               columns=["bucket", "block", "asked"])

    def ask_windows(block: pd.DataFrame, answers: pd.DataFrame) -> pd.DataFrame:
        if not len(block):
            return pd.DataFrame({"bucket": [], "block": [], "asked": []})
        masks = dict(zip(answers["bucket"], answers["answer"], strict=True))
        # by id; what is kept of a document are its word hashes, not its words
        docs = sorted(((i, p.forget_words()) for i, p in windowed(block)),
                      key=lambda d: d[0])
        if not docs:
            return pd.DataFrame({"bucket": [], "block": [], "asked": []})
        keys = np.unique(np.concatenate([distinct(p.anchors()) for _, p in docs]))
        shared = [keys[at][np.unpackbits(np.frombuffer(masks[k], np.uint8),
                                         count=len(at)).astype(bool)]
                  for k, at in by_bucket(keys, buckets)]
        shared = np.sort(np.concatenate(shared)) if shared else keys
        if not len(shared):
            return pd.DataFrame({"bucket": [], "block": [], "asked": []})

        parts = []
        for i, p in docs:
            a = p.anchors()
            near = np.searchsorted(shared, a)
            near[near == len(shared)] = 0
            at = np.flatnonzero(shared[near] == a)
            if len(at):
                key, check = p.windows()
                parts.append((key[at], check[at], np.full(len(at), i, np.int64),
                              at.astype(np.uint32)))
        entries = [np.concatenate(x) for x in zip(*parts, strict=True)] if parts else [[]] * 4
        return pd.DataFrame(_ask_first(block["block"].iat[0], *entries, buckets),
                            columns=["bucket", "block", "asked"])

    def parse(block: pd.DataFrame, answers: pd.DataFrame) -> pd.DataFrame:
        if not len(block):
            return pd.DataFrame({c: [] for c in
                                 ("id", "n_words", "n_removed", "kept", "factors")})
        index = Index(answers["answer"])
        out = []
        for i, p in _documents(block, window, gram):
            found, kept = [], p.words
            if p.n_windows and len(index.keys) and i is not None:
                ref, at = index.look_up(*p.windows())
                found = factors(np.where(ref < i, ref, NONE), at, window)
                if found:
                    gone = np.zeros(len(p.words) + 1, np.int64)
                    for s, n, _, _ in found:
                        gone[s] += 1
                        gone[s + n] -= 1
                    kept = [w for w, g in zip(p.words, np.cumsum(gone[:-1]).tolist(), strict=True)
                            if not g]
            out.append((i, len(p.words), len(p.words) - len(kept),
                        b" ".join(kept).decode("utf-8", "replace"),
                        [{"start": s, "length": n, "reference": r, "position": q}
                         for s, n, r, q in found]))
        got = pd.DataFrame(out, columns=["id", "n_words", "n_removed", "kept", "factors"])
        return got.astype({"id": object})

    shared = (b.mapInPandas(ask_anchors, ASKED).groupBy("bucket")
              .applyInPandas(_shared_anchors, ANSWER))
    asked = b.groupBy("block").cogroup(shared.groupBy("block")).applyInPandas(
        ask_windows, ASKED)
    refs = asked.groupBy("bucket").applyInPandas(_references, ANSWER)
    return b.groupBy("block").cogroup(refs.groupBy("block")).applyInPandas(
        parse, "id long, n_words long, n_removed long, kept string, "
               "factors array<struct<start:long,length:long,reference:long,position:long>>")
