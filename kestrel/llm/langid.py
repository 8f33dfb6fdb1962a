"""Language identification: word-first backoff.

A known word scores by its log frequency in each language; an unseen word
falls back to its longest known character n-grams (4 down to 1, with word
borders marked). The model is fitted on a bounded sample of labelled rows
(``train_rows`` per language, taken by a hash of the id) and therefore has a
bounded size (at most ``max_words`` words and ``max_grams`` n-grams, dealt to
the languages in turn, each by its own frequencies), so it can travel with the
tasks. Every text is scored whole.

Defined results: a null text or one without letters is ``und`` with score 0;
text whose words and n-grams are all unknown gets the first language with
score 1 / number of languages; without labelled rows everything is ``und``;
repeated rows are each scored; other columns are ignored.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kestrel.llm.blocks import release

LETTERS = re.compile(r"[^\W\d_]+")
LONGEST = 4
CACHE = 200_000          # scored words that a task remembers


def crc_mod(id_col: Column, n: int) -> Column:
    """crc32 of the id written as text, modulo n."""
    return F.crc32(id_col.cast("string").cast("binary")) % n


def grams(word: str, n: int) -> list[str]:
    w = f"^{word}$"
    return [w[i:i + n] for i in range(len(w) - n + 1)] if n > 1 else list(word)


def _count_words(batches):
    for b in batches:
        counts = Counter()
        for lang, text in zip(b.lang, b.text, strict=True):
            c = Counter(LETTERS.findall(text.lower()))
            for w, n in c.items():
                counts[lang, w] += n
        yield pd.DataFrame([(k[0], k[1], v) for k, v in counts.items()],
                           columns=["lang", "word", "n"])
    release()


def _count_grams(batches):
    for b in batches:
        counts = Counter()
        for lang, word, n in zip(b.lang, b.word, b.n, strict=True):
            for size in range(1, LONGEST + 1):
                for g in grams(word, size):
                    counts[lang, size, g] += n
        yield pd.DataFrame([(*k, v) for k, v in counts.items()],
                           columns=["lang", "size", "gram", "n"])
        counts = None
    release()


class Model:
    """Log frequencies of known words and n-grams: per kind a row number for
    each key, and one matrix (rows x languages)."""

    def __init__(self, langs, words, gram_counts):
        self.langs = sorted(langs)
        self.words = self._logs(words)
        self.grams = {size: self._logs(g) for size, g in gram_counts.items()}

    def _logs(self, counts):
        total = {l: 1 for l in self.langs}
        for c in counts.values():
            for l, n in c.items():
                total[l] += n
        size = len(counts) + 1
        logs = np.empty((len(counts), len(self.langs)))
        for row, c in zip(logs, counts.values(), strict=True):
            row[:] = [math.log((c.get(l, 0) + 0.5) / (total[l] + 0.5 * size))
                      for l in self.langs]
        return {k: at for at, k in enumerate(counts)}, logs

    def vector(self, word):
        rows, logs = self.words
        at = rows.get(word)
        if at is not None:
            return logs[at]
        for size in range(LONGEST, 0, -1):
            if size in self.grams:
                rows, logs = self.grams[size]
                found = [rows[g] for g in grams(word, size) if g in rows]
                if found:
                    return logs[found].sum(axis=0) / len(found)
        return np.zeros(len(self.langs))

    def predict(self, texts, memory: "Memory | None" = None):
        """(language, score) per text; ``memory`` serves several calls."""
        return ((lang, score) for lang, score, _ in self.decide(texts, memory))

    def decide(self, texts, memory: "Memory | None" = None):
        """(language, score, whether the text has a language) per text. The score
        weighs the mean log frequencies of all words as those of 40 words at most
        (the language doesn't depend on that; a long text's score would round to
        1 else). A text
        without letters has none, nor has one of which the model knows no word
        and no n-gram. A model without languages denies none with letters."""
        memory = Memory(self) if memory is None else memory
        for text in texts:
            words = LETTERS.findall(text.lower()) if text else []
            letters = any(c.isalpha() for w in words for c in w)
            if not self.langs or not letters:
                yield "und", 0.0, letters
                continue
            try:
                at = [memory[w] for w in words]
                total = memory.table[at].sum(axis=0)
            except OverflowError:               # start the memory afresh
                total = sum(n * self.vector(w) for w, n in Counter(words).items())
                memory.clear()
            z = total / len(words) * min(len(words), 40)
            p = np.exp(z - z.max())
            best = int(p.argmax())
            # log frequencies are below zero: only unknown words add up to zero
            yield self.langs[best], float(p[best] / p.sum()), bool(total.any())


class Memory(dict):
    """Word -> row of ``table``, scored when first met; the table doubles when
    it is full, so growing it costs a constant per word."""

    def __init__(self, model: Model):
        super().__init__()
        self.model, self.table = model, np.empty((1024, len(model.langs)))

    def __missing__(self, word):
        at = len(self)
        if at >= CACHE:
            raise OverflowError
        if at == len(self.table):
            self.table = np.vstack([self.table, np.empty_like(self.table)])
        self.table[at] = self.model.vector(word)
        self[word] = at
        return at


def fit(docs: DataFrame, *, train_rows: int = 4000, max_words: int = 60_000,
        max_grams: int = 60_000, min_count: int = 2, id_col: str = "doc_id",
        text_col: str = "text", lang_col: str = "lang") -> Model:
    """Fit on at most about ``train_rows`` labelled rows per language."""
    d = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"),
                    F.col(lang_col).alias("lang")).where("lang IS NOT NULL AND text IS NOT NULL")
    sizes = {r["lang"]: r["n"] for r in d.groupBy("lang").agg(F.count(F.lit(1)).alias("n"))
             .collect()}                        # one row per language
    if not sizes:
        return Model([], {}, {})
    share = F.coalesce(*[F.when(F.col("lang") == l, F.lit(min(1.0, train_rows / n)))
                         for l, n in sizes.items()])
    draw = F.pmod(F.xxhash64(F.lit("langid"), "id"), F.lit(1 << 30)) / F.lit(float(1 << 30))
    counts = (d.where(draw < share).select("lang", "text")
              .mapInPandas(_count_words, "lang string, word string, n long")
              .groupBy("lang", "word").agg(F.sum("n").alias("n")))
    from kestrel.session import materialize
    counts = materialize(counts, "langid-words")

    def top(df, key, most):
        """{key: {lang: n}} of ``most`` keys (bounded): the most frequent one of
        each language, then the second ones, and so on. A language that runs out
        leaves its places to the others."""
        rank = F.row_number().over(Window.partitionBy("lang").orderBy(F.desc("n"), *key))
        best = (df.withColumn("rank", rank)
                .groupBy(*key).agg(F.sum("n").alias("n"), F.min("rank").alias("rank"),
                                   F.collect_list(F.struct("lang", "n")).alias("by"))
                .where(F.col("n") >= min_count)
                .orderBy("rank", F.desc("n"), *key).limit(most))
        return [(tuple(r[k] for k in key), {x["lang"]: x["n"] for x in r["by"]})
                for r in best.collect()]

    words = {k[0]: by for k, by in top(counts, ["word"], max_words)}
    parts = (counts.mapInPandas(_count_grams, "lang string, size int, gram string, n long")
             .groupBy("lang", "size", "gram").agg(F.sum("n").alias("n")))
    by_size: dict[int, dict] = {}
    for (size, gram), by in top(parts, ["size", "gram"], max_grams):
        by_size.setdefault(size, {})[gram] = by
    return Model(list(sizes), words, by_size)


def _texts(column: pa.Array):
    """The texts one by one: a batch isn't turned into strings as a whole."""
    return (text.as_py() for text in column)


def predict(docs: DataFrame, model: Model, *, id_col: str = "doc_id",
            text_col: str = "text") -> DataFrame:
    """(id, lang_pred, score) per row; the model is bounded and travels along."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        memory = Memory(shared.value)
        for b in batches:
            got = list(shared.value.predict(_texts(b.column("text")), memory))
            yield pa.RecordBatch.from_arrays(
                [b.column("id"), pa.array([g[0] for g in got], pa.string()),
                 pa.array([g[1] for g in got], pa.float64())],
                names=["id", "lang_pred", "score"])

    # ids travel as strings, whatever their type
    d = docs.select(F.col(id_col).cast("string").alias("id"), F.col(text_col).alias("text"))
    return d.mapInArrow(run, "id string, lang_pred string, score double").withColumn(
        "id", F.col("id").cast(docs.schema[id_col].dataType))


def labelled(docs: DataFrame, model: Model, *, text_col: str = "text") -> DataFrame:
    """``docs`` with lang_pred, score and known (whether the text has a
    language, see ``Model.decide``) added as ``__lang`` (all columns kept)."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.arrow_udf("struct<lang_pred string, score double, known boolean>")
    def guess(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        memory = Memory(shared.value)
        for texts in batches:
            got = list(shared.value.decide(_texts(texts), memory))
            yield pa.StructArray.from_arrays(
                [pa.array([g[0] for g in got], pa.string()),
                 pa.array([g[1] for g in got], pa.float64()),
                 pa.array([g[2] for g in got], pa.bool_())],
                names=["lang_pred", "score", "known"])
        texts = got = None
        memory.clear()
        release()

    return docs.withColumn("__lang", guess(F.col(text_col)))
