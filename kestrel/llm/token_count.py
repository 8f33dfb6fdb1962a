"""Token counts with overlap resynchronisation for huge documents.

Texts up to ``chunk_chars`` are encoded as they are. Longer ones are cut into
chunks that overlap; each chunk is encoded on its own, by any task, and
reports the token boundaries inside its overlaps (offset in the document,
tokens so far). Neighbouring chunks are spliced at a boundary that both have
proven: a place where both see the same stable border. A pair without one is
encoded again with overlaps four times as wide, at last as one text.

A stable border is the end of white space (ASCII) inside a chunk: the
vocabulary's pre-tokens drop white space, its normaliser works within
white-space-free runs, and its special strings hold none, so the tokens on
one side don't depend on the other. A chunk's own start is no proof, because
the run there may have begun in the chunk before.

The same property lets a task remember the counts of the runs it has met
(``Counter_``), so that the library encodes each distinct run once per task.

Defined results: null and empty texts have 0 bytes and 0 tokens; repeated
rows are each counted; other columns are ignored; empty table, empty result.
"""

from __future__ import annotations

import os

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kestrel.session import materialize

MEMORY = 400_000        # distinct runs that a task remembers
SPACE = b" \t\n\r\x0b\x0c"


class Counter_(dict):
    """Token counts of white-space-free runs (UTF-8), encoded once each."""

    def __init__(self, vocabulary: str):
        super().__init__()
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_file(vocabulary)

    def learn(self, runs) -> None:
        new = list({r for r in runs if r not in self})
        if len(self) + len(new) > MEMORY:
            self.clear()
            new = list(set(runs))
        got = self.tokenizer.encode_batch_fast([r.decode("utf-8", "replace") for r in new],
                                               add_special_tokens=False)
        self.update(zip(new, (len(e.ids) for e in got), strict=True))

    def count(self, raw: bytes) -> int:
        return sum(map(self.__getitem__, raw.split()))

    def borders(self, raw: bytes, start: int) -> list[tuple[int, int]]:
        """(offset of a border, tokens before it), for every border inside."""
        out, at, n = [], 0, 0
        for run in raw.split():
            at = raw.index(run, at)
            if at:
                out.append((start + at, n))
            n += self[run]
            at += len(run)
        return out


def _shared(vocabulary: str, held: dict = {}) -> Counter_:  # noqa: B006  one per worker
    if vocabulary not in held:
        held[vocabulary] = Counter_(vocabulary)
    return held[vocabulary]


def _whole(vocabulary):
    def run(batches):
        counter = _shared(vocabulary)
        for b in batches:
            raws = [t.encode() if t else b"" for t in b["text"]]
            tokens = []
            for i in range(0, len(raws), 500):
                counter.learn([r for raw in raws[i:i + 500] for r in raw.split()])
                tokens += [counter.count(r) for r in raws[i:i + 500]]
            yield pd.DataFrame({"id": b["id"], "n_bytes": [len(r) for r in raws],
                                "n_tokens": tokens})
    return run


def _chunked(vocabulary):
    """Chunks -> tokens of the chunk, and its borders inside its overlaps."""
    def run(batches):
        counter = _shared(vocabulary)
        for b in batches:
            out = []
            for r in b.itertuples(index=False):
                raw = r.text.encode()
                counter.learn(raw.split())
                # offsets are in characters of the document
                inside = counter.borders(raw, 0)
                text_at = {0: 0}
                chars, last = 0, 0
                for at, _ in inside:
                    chars += len(raw[last:at].decode("utf-8", "replace"))
                    text_at[at], last = chars, at
                marks = [(r.start + text_at[at], n) for at, n in inside]
                low = [m for m in marks if m[0] < r.start + r.lead]
                high = [m for m in marks if m[0] >= r.start + len(r.text) - r.trail]
                out.append((r.row, r.k, counter.count(raw),
                            [m[0] for m in low], [m[1] for m in low],
                            [m[0] for m in high], [m[1] for m in high]))
            yield pd.DataFrame(out, columns=["row", "k", "tokens", "low", "low_n",
                                             "high", "high_n"])
    return run


def _splice(rows: pd.DataFrame) -> pd.DataFrame:
    """All chunks of one document (numbers only) -> its token count, or null."""
    rows = rows.sort_values("k")
    total, skip = 0, 0
    items = list(rows.itertuples(index=False))
    for a, b in zip(items, items[1:], strict=False):
        left = dict(zip(a.high, a.high_n, strict=True))
        right = dict(zip(b.low, b.low_n, strict=True))
        common = sorted(left.keys() & right.keys())
        if not common:
            return pd.DataFrame({"row": [items[0].row], "n_tokens": [None]})
        cut = common[len(common) // 2]
        total += left[cut] - skip
        skip = right[cut]
    total += items[-1].tokens - skip
    return pd.DataFrame({"row": [items[0].row], "n_tokens": [total]})


def count_tokens(docs: DataFrame, vocabulary: str, *, chunk_chars: int = 65_536,
                 overlap: int = 512, id_col: str = "doc_id",
                 text_col: str = "text") -> DataFrame:
    """(id, n_bytes, n_tokens) per row. ``vocabulary``: path of a tokenizers
    file whose pre-tokens drop white space, present on every executor."""
    d = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    kind = docs.schema[id_col].dataType
    long = F.char_length("text") > chunk_chars
    # ids travel as strings: a null would turn the others into floats
    short = (d.where(~F.coalesce(long, F.lit(False))).withColumn("id", F.col("id").cast("string"))
             .mapInPandas(_whole(vocabulary), "id string, n_bytes long, n_tokens long")
             .withColumn("id", F.col("id").cast(kind)))
    todo = d.where(long).withColumn("row", F.monotonically_increasing_id())
    if todo.isEmpty():
        return short
    todo, done, size = materialize(todo, "huge-documents"), [], overlap
    while True:
        parts = _splice_all(todo, vocabulary, chunk_chars, size)
        done.append(todo.join(parts.where("n_tokens IS NOT NULL"), "row").select(
            "id", F.octet_length("text").cast("long").alias("n_bytes"), "n_tokens"))
        open_ = parts.where("n_tokens IS NULL").select("row")
        if open_.isEmpty():
            break
        todo = materialize(todo.join(open_, "row"), "huge-documents")
        size *= 4
        chunk_chars = max(chunk_chars, 2 * size)
    for part in done:
        short = short.unionByName(part)
    return short


def _splice_all(todo: DataFrame, vocabulary: str, chunk: int, overlap: int) -> DataFrame:
    n = F.ceil(F.char_length("text") / F.lit(chunk))
    k = todo.select("row", "text", F.explode(F.sequence(F.lit(0), (n - 1).cast("int"))).alias("k"),
                    (n - 1).cast("int").alias("last"))
    lead = F.when(F.col("k") > 0, F.lit(overlap)).otherwise(0)
    trail = F.when(F.col("k") < F.col("last"), F.lit(overlap)).otherwise(0)
    cut = k.select("row", "k", (F.col("k") * chunk - lead).cast("long").alias("start"),
                   (2 * lead).alias("lead"), (2 * trail).alias("trail"),
                   F.substring("text", (F.col("k") * chunk - lead + 1).cast("int"),
                               (F.lit(chunk) + lead + trail).cast("int")).alias("text"))
    cut = cut.repartition("row", "k")            # chunks of one document over many tasks
    marks = cut.mapInPandas(_chunked(vocabulary), "row long, k int, tokens long, "
                            "low array<long>, low_n array<long>, "
                            "high array<long>, high_n array<long>")
    return materialize(marks.groupBy("row").applyInPandas(_splice, "row long, n_tokens long"),
                       "spliced")
