"""Ranked lexical search: maximum inner products by buckets of vector length.

A document is the vector of its impacts (weight times saturated frequency) over
the terms of the queries, a query the vector of its term counts, and a score
their inner product. Vectors are ordered by length and cut into buckets. With
``t`` the score of the k-th best document known so far, a query

* skips a bucket whose longest vector is too short for it: by Cauchy-Schwarz no
  score exceeds |query| * |vector|; within a bucket the same cuts the tail;
* looks only at vectors that hold one of its first coordinates, the terms in
  the order of what they can add in the bucket, as long as the terms after
  them could add up to ``t``; of those, it drops each whose partial score and
  the bound of the other coordinates (the sum of their largest values, and
  Cauchy-Schwarz on the rest of the vector) stay below ``t``;
* rescores the survivors exactly, in integers.

Bounds are kept a little above their value in floating point and only what is
strictly below ``t`` goes, so ties are never lost.

The first thresholds come from the longest vectors (a share of ``seeds``),
searched where they lie; vectors that are too short for every query are not
even shuffled. The others are dealt to tasks by ranges of their length (and a
hash of the row, as equal texts have equal lengths); each task raises its
thresholds bucket by bucket and returns its best k per query, and a last step
ranks those.

Queries are taken in blocks of ``block_items`` or fewer, so that thresholds,
vocabulary and query vectors, which go to every task, have a bounded size; each
block reads the documents once.

Defined results: null texts have no terms; an item without terms that occur, or
whose terms all weigh 0, has no rows; repeated items are ranked one by one,
repeated documents too; of equal scores the smaller id comes first, a null id
last; empty tables give an empty result; other columns are ignored. Texts are
read whole, in slices cut between terms.
"""

from __future__ import annotations

import heapq
import math
from collections import Counter
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from kestrel.session import materialize, materialize_counted

BLOCK_ITEMS = 5_000
BUCKET_ROWS = 4_096
BUCKET_ENTRIES = 1 << 20     # coordinates of a bucket
SEEDS = 0.02                 # of the vectors give the first thresholds
SLICE = 1 << 20              # bytes of text that are split at once
SLACK = 1 + 1e-9             # bounds are floating point, scores are integers

#: Term bytes: 0-9, A-Z (lowered), a-z and all of non-ASCII characters; every
#: other byte becomes a space.
TERMS = bytes(b + 32 if 65 <= b <= 90 else b if b >= 128 or 48 <= b <= 57 or 97 <= b <= 122
              else 32 for b in range(256))


def terms(text: str | None):
    """Lists of the terms of ``text``, slice by slice."""
    data = text.encode("utf-8", "surrogatepass").translate(TERMS) if text else b""
    at = 0
    while at < len(data):
        end = data.find(b" ", at + SLICE)
        end = len(data) if end < 0 else end
        yield data[at:end].split()
        at = end


def count_terms(text: str | None) -> Counter:
    got: Counter = Counter()
    for part in terms(text):
        got.update(part)
    return got


# ------------------------------------------------------------------- vectors

def term_frequencies(docs: DataFrame, vocabulary: dict[bytes, int], id_col: str,
                     text_col: str) -> DataFrame:
    """(id, n, terms, tfs): per document its number of terms and, sorted, the
    numbers and frequencies of those in ``vocabulary``. One pass, no shuffle."""
    shared = docs.sparkSession.sparkContext.broadcast(vocabulary)

    def run(batches):
        known = shared.value
        for batch in batches:
            total, found, freq = [], [], []
            for text in batch.column("text"):
                n, hits = 0, Counter()
                for part in terms(text.as_py()):
                    n += len(part)
                    hits.update(map(known.get, part))
                hits.pop(None, None)
                order = sorted(hits)
                total.append(n)
                found.append(order)
                freq.append([hits[t] for t in order])
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), pa.array(total, pa.int64()),
                 pa.array(found, pa.list_(pa.int32())), pa.array(freq, pa.list_(pa.int64()))],
                names=["id", "n", "terms", "tfs"])

    d = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    kind = docs.schema[id_col].dataType.simpleString()
    return d.mapInArrow(run, f"id {kind}, n long, terms array<int>, tfs array<long>")


def term_weight(n_docs: int, df: int) -> int:
    return math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df + 1)))


def impacts(batch: pd.DataFrame, weights: np.ndarray, n_docs: int, n_terms: int):
    """Per row of ``batch`` the 64-bit impacts of its terms."""
    for n, found, freq in zip(batch["n"], batch["terms"], batch["tfs"], strict=True):
        m = 75 + (25 * int(n) * n_docs) // n_terms
        tf = np.asarray(freq, np.int64)
        yield weights[found] * ((1_000_000_000 * tf) // (1000 * tf + 12 * m))


def with_lengths(vectors: DataFrame, weights: np.ndarray, n_docs: int,
                 n_terms: int) -> DataFrame:
    """(row, id, length, terms, impacts): the vectors and their Euclidean
    lengths; vectors of length 0 are left out."""
    shared = vectors.sparkSession.sparkContext.broadcast(weights)

    def run(batches):
        for batch in batches:
            values = list(impacts(batch, shared.value, n_docs, n_terms))
            yield pd.DataFrame({
                "row": batch["row"], "id": batch["id"], "terms": batch["terms"],
                "impacts": values,
                "length": [float(np.sqrt(np.square(v.astype(np.float64)).sum()))
                           for v in values]})

    kind = vectors.schema["id"].dataType.simpleString()
    d = vectors.where(F.size("terms") > 0)
    # ids travel as strings, so that a null among them doesn't turn them into floats
    return d.withColumn("id", F.col("id").cast("string")).mapInPandas(
        run, "row long, id string, length double, terms array<int>, impacts array<long>"
    ).where("length > 0").withColumn("id", F.col("id").cast(kind))


# -------------------------------------------------------------------- search

class Queries:
    """The vectors of a block of items: per item its name (a row number), its
    terms and their counts."""

    def __init__(self, names: list[int], vectors: list[dict[int, int]]):
        self.names = names
        self.terms = [np.fromiter(v, np.int64, len(v)) for v in vectors]
        self.counts = [np.fromiter(v.values(), np.int64, len(v)) for v in vectors]
        self.lengths = [float(np.sqrt(np.square(c.astype(np.float64)).sum()))
                        for c in self.counts]


class Bucket:
    """Documents of descending length, with the postings of every term."""

    def __init__(self, lengths, found, values):
        self.lengths = np.asarray(lengths, np.float64)
        rows = np.repeat(np.arange(len(found)), [len(f) for f in found])
        term, value = np.concatenate(found).astype(np.int64), np.concatenate(values)
        order = np.argsort(term, kind="stable")          # rows stay sorted in a term
        self.row, self.value = rows[order], value[order]
        self.term, first = np.unique(term[order], return_index=True)
        self.cuts = np.append(first, len(order))
        self.most = np.maximum.reduceat(self.value, first)

    def candidates(self, query: np.ndarray, counts: np.ndarray, length: float, least: int):
        """(rows, exact scores) of all documents that can score ``least`` or more."""
        none = np.zeros(0, np.int64)
        if not length or length * self.lengths[0] * SLACK < least:     # none is long enough
            return none, none
        tail = int(np.searchsorted(-self.lengths, -least / (length * SLACK), "right"))
        at = np.searchsorted(self.term, query)
        here = at < len(self.term)
        here[here] = self.term[at[here]] == query[here]
        at, counts = at[here], counts[here]
        most = counts * self.most[at]
        order = np.argsort(-most, kind="stable")
        at, counts, most = at[order], counts[order], most[order]
        rest = np.append(np.cumsum(most[::-1])[::-1], 0)     # what terms i.. can add
        score = np.zeros(len(self.lengths), np.int64)
        seen = np.zeros(len(self.lengths), bool)
        focus = int(np.searchsorted(-rest, -max(least, 1), "right"))
        square = np.zeros(len(self.lengths))
        for t, c in zip(at[:focus], counts[:focus], strict=True):
            part = slice(self.cuts[t], self.cuts[t + 1])
            rows, value = self.row[part], self.value[part]
            score[rows] += c * value
            seen[rows] = True
            square[rows] += np.square(value.astype(np.float64))
        seen[tail:] = False
        rows = np.flatnonzero(seen)
        if focus < len(at):
            left = np.sqrt(np.maximum(np.square(self.lengths[rows]) * SLACK - square[rows], 0))
            weight = math.sqrt(float(np.square(counts[focus:].astype(np.float64)).sum()))
            bound = np.minimum(float(rest[focus]), left * weight * SLACK)
            rows = rows[(score[rows] + bound) * SLACK >= least]
            for t, c in zip(at[focus:], counts[focus:], strict=True):
                part = slice(self.cuts[t], self.cuts[t + 1])
                own = self.row[part]
                place = np.searchsorted(own, rows)
                hit = place < len(own)
                hit[hit] = own[place[hit]] == rows[hit]
                score[rows[hit]] += c * self.value[part][place[hit]]
        got = score[rows]
        keep = got >= max(least, 1)
        return rows[keep], got[keep]


class Best:
    """The k best documents per query: larger score, then smaller id."""

    def __init__(self, k: int, least: np.ndarray):
        self.k, self.least, self.held = k, least.copy(), {}

    def offer(self, query: int, scores: np.ndarray, ids: list) -> None:
        rows = [(-int(s), i is None, i if i is not None else 0)
                for s, i in zip(scores, ids, strict=True)]
        best = heapq.nsmallest(self.k, self.held.get(query, []) + rows)
        self.held[query] = best
        if len(best) == self.k:
            self.least[query] = max(self.least[query], -best[-1][0])

    def rows(self):
        return [(q, None if none else i, -s) for q, best in self.held.items()
                for s, none, i in best]


def lists(column: pa.ListArray) -> list[np.ndarray]:
    flat, ends = column.flatten().to_numpy(), column.offsets.to_numpy()
    return np.split(flat, ends[1:-1] - ends[0])


def buckets(batches, bucket_rows: int):
    """(ids, Bucket) of consecutive vectors of descending length."""
    rows, size = [], 0
    for batch in batches:
        for row in zip(batch.column("id").to_pylist(), batch.column("length").to_pylist(),
                       lists(batch.column("terms")), lists(batch.column("impacts")),
                       strict=True):
            rows.append(row)
            size += len(row[2])
            if len(rows) >= bucket_rows or size >= BUCKET_ENTRIES:
                ids, *columns = zip(*rows, strict=True)
                yield ids, Bucket(*columns)
                rows, size = [], 0
    if rows:
        ids, *columns = zip(*rows, strict=True)
        yield ids, Bucket(*columns)


def search(vectors: DataFrame, queries: Queries, least: np.ndarray, k: int,
           bucket_rows: int) -> DataFrame:
    """(item, id, score): the best ``k`` of each task per query, none below
    ``least``, of vectors that lie sorted by descending length in each task."""
    shared = vectors.sparkSession.sparkContext.broadcast((queries, least))
    id_type = vectors.schema["id"].dataType

    def run(batches):
        queries, least = shared.value
        best = Best(k, least)
        for ids, bucket in buckets(batches, bucket_rows):
            for q, (found, counts, length) in enumerate(
                    zip(queries.terms, queries.counts, queries.lengths, strict=True)):
                rows, scores = bucket.candidates(found, counts, length, int(best.least[q]))
                if len(rows) > k:               # of the ties at the cut all stay
                    cut = np.partition(scores, len(scores) - k)[len(scores) - k]
                    rows, scores = rows[scores >= cut], scores[scores >= cut]
                if len(rows):
                    best.offer(q, scores, [ids[r] for r in rows.tolist()])
        rows = [(queries.names[q], i, s) for q, i, s in best.rows()]
        for at in range(0, len(rows), 10_000):
            part = list(zip(*rows[at:at + 10_000], strict=True))
            yield pa.RecordBatch.from_arrays(
                [pa.array(part[0], pa.int64()), pa.array(part[1], id_arrow),
                 pa.array(part[2], pa.int64())], names=["item", "id", "score"])

    from pyspark.sql.pandas.types import to_arrow_type
    id_arrow = to_arrow_type(id_type)
    return vectors.select("id", "length", "terms", "impacts").mapInArrow(
        run, f"item long, id {id_type.simpleString()}, score long")


def best_of(found: DataFrame, k: int) -> DataFrame:
    """The ``k`` best rows of every item, ranked."""
    order = Window.partitionBy("item").orderBy(F.desc("score"), F.col("id").asc_nulls_last())
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def _block(docs: DataFrame, names: list[int], items: list[Counter], k: int, id_col: str,
           text_col: str, bucket_rows: int, seeds: float) -> DataFrame | None:
    """(item, id, score) with the k best of each item of one block."""
    words: dict[bytes, int] = {}
    for counts in items:
        for w in counts:
            words.setdefault(w, len(words))
    if not words:
        return None
    found = term_frequencies(docs, words, id_col, text_col)
    freq, _, seen = materialize_counted(
        found.withColumn("row", F.monotonically_increasing_id()), "search-terms",
        docs=F.coalesce(F.sum((F.col("n") > 0).cast("long")), F.lit(0)),
        words=F.coalesce(F.sum("n"), F.lit(0)))
    if not seen["words"]:
        return None
    df = {r["term"]: r["n"] for r in freq.select(F.explode("terms").alias("term")).groupBy(
        "term").agg(F.count(F.lit(1)).alias("n")).collect()}      # within the vocabulary
    weights = np.zeros(len(words), np.int64)
    for t, n in df.items():
        weights[t] = term_weight(seen["docs"], n)
    queries = Queries(names, [{words[w]: c for w, c in counts.items() if weights[words[w]] > 0}
                              for counts in items])
    vectors, _, got = materialize_counted(
        with_lengths(freq, weights, seen["docs"], seen["words"]), "search-vectors",
        cut=F.percentile_approx("length", 1 - seeds, 1000))
    if got["cut"] is None:
        return None
    none = np.zeros(len(items), np.int64)
    longest = vectors.where(F.col("length") >= got["cut"]).sortWithinPartitions(F.desc("length"))
    first = best_of(search(longest, queries, none, k, bucket_rows), k).groupBy("item").agg(
        F.count(F.lit(1)).alias("n"), F.min("score").alias("least"))
    known = {r["item"]: r["least"] for r in first.where(F.col("n") == k).collect()}
    least = np.array([known.get(name, 0) for name in names], np.int64)
    short = min((t / length for t, length in zip(least, queries.lengths, strict=True)
                 if length > 0), default=math.inf)
    dealt = vectors.where(F.col("length") * SLACK >= float(short)).repartitionByRange(
        F.desc("length"), F.xxhash64("row")).sortWithinPartitions(F.desc("length"))
    return search(dealt, queries, least, k, bucket_rows)


def lexical_search(docs: DataFrame, items: DataFrame, *, k: int = 20, id_col: str = "doc_id",
                   text_col: str = "text", item_col: str = "item_id",
                   item_text_col: str = "text", block_items: int = BLOCK_ITEMS,
                   bucket_rows: int = BUCKET_ROWS, seeds: float = SEEDS) -> DataFrame:
    """The ``k`` best documents of every item: item_id, rank, id, score."""
    spark = items.sparkSession
    items, count = materialize_counted(
        items.select(F.col(item_col).alias("item_id"), F.col(item_text_col).alias("text"))
        .withColumn("item", F.monotonically_increasing_id()), "search-items")
    blocks = max(1, -(-count // block_items))
    out = []
    for b in range(blocks):
        # a bounded block: its vectors go to every task
        mine = items.where(F.pmod(F.xxhash64("item"), F.lit(blocks)) == b).orderBy("item") \
            .select("item", "text").collect()
        found = _block(docs, [r["item"] for r in mine], [count_terms(r["text"]) for r in mine],
                       k, id_col, text_col, bucket_rows, seeds)
        if found is not None:
            out.append(materialize(best_of(found, k), "search-found"))
    if not out:
        kinds = [docs.schema[id_col].dataType.simpleString(),
                 items.schema["item_id"].dataType.simpleString()]
        return spark.createDataFrame([], f"item_id {kinds[1]}, rank int, id {kinds[0]}, score long")
    found = reduce(DataFrame.unionByName, out)
    return found.join(items.select("item", "item_id"), "item").select(
        "item_id", "rank", "id", "score")
