"""Toxicity: weighted lexicon, Aho-Corasick, exception phrases.

Texts are folded first (compatibility forms, case, homoglyphs, zero-width
characters, digits and signs that stand for letters). The lexicon holds whole
words and word beginnings (written ``stem*``) with log-odds weights. An
Aho-Corasick automaton finds them in one pass over the folded text; matches
inside an exception phrase don't count. The sum of weights is normalised by
the square root of the number of words, and a logistic curve maps it to a
score.

Lexicon and curve are fitted on a bounded sample (``train_rows``) of the
labelled rows, in which texts that fold to the same count once. Candidates are
counted on the executors, and entries are chosen greedily by the toxic texts
that they newly explain. Candidates come to the driver in pages; a page is
used as long as none outside it can be the better choice, then the rest is
counted again over the texts not yet explained: the choice is the one that
all candidates at once would give.

Defined results: null, empty and match-free texts get the curve's value at
zero; without labels of both kinds the lexicon is empty and every score 0;
repeated rows are each scored; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import math
import re
import unicodedata
from collections import Counter

import ahocorasick
import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kestrel.session import materialize

#: Letters of other scripts that look like Latin ones, and signs and digits
#: that stand for letters.
HOMOGLYPHS = dict(zip("аеорсухіјѕһԁԛԝᴀοανικρτυ", "aeopcyxijshdqwaoavikptu", strict=True))
SIGNS = {"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "8": "b",
         "@": "a", "$": "s", "!": "i"}
INVISIBLE = "​‌‍⁠﻿­"
FOLD = str.maketrans({**HOMOGLYPHS, **SIGNS, **dict.fromkeys(INVISIBLE)})
EXCEPTIONS = ("trash can", "trash bin", "clown fish", "pathetic fallacy")
WORD = re.compile(r"[^\W_]+")
STEMS = (4, 5, 6)


def fold(text: str) -> str:
    if not unicodedata.is_normalized("NFKC", text):
        text = unicodedata.normalize("NFKC", text)
    text = text.lower()
    # a sign at the end of a word is punctuation, not a letter
    if "!" in text:
        text = re.sub(r"!+(?!\w)", " ", text)
    return text.translate(FOLD)


def features(text: str) -> set[str]:
    """Words and word beginnings of a folded text."""
    words = set(WORD.findall(fold(text)))
    out = {w for w in words if 3 <= len(w) <= 24}
    for n in STEMS:
        out.update(w[:n] + "*" for w in words if len(w) > n)
    return out


class Lexicon:
    """Weighted entries, exception phrases and the logistic curve."""

    def __init__(self, weights: dict[str, float], exceptions=EXCEPTIONS,
                 curve=(0.0, 0.0, 0.0)):
        self.weights, self.exceptions, self.curve = weights, tuple(exceptions), curve
        self._machine = None

    def __getstate__(self):
        return self.weights, self.exceptions, self.curve

    def __setstate__(self, state):
        self.__init__(*state)

    def machine(self):
        if self._machine is None:
            a = ahocorasick.Automaton()
            # a word, a stem and a phrase may be the same string
            found: dict[str, list] = {}
            for entry, w in self.weights.items():
                found.setdefault(entry.rstrip("*"), []).append((w, entry.endswith("*")))
            for phrase in self.exceptions:
                found.setdefault(fold(phrase), []).append((None, False))
            for key, values in found.items():
                a.add_word(key, (key, values))
            a.make_automaton()
            self._machine = a
        return self._machine

    def matches(self, text: str) -> list[tuple[int, int, float]]:
        """(start, end, weight) in the folded text, exceptions taken out."""
        folded, hits, spared = fold(text), [], []
        if not self.weights:
            return []
        for end, (key, values) in self.machine().iter(folded):
            start, end = end - len(key) + 1, end + 1
            if start and folded[start - 1].isalnum():
                continue
            inside = end < len(folded) and folded[end].isalnum()
            for weight, stem in values:
                if stem or not inside:
                    (hits if weight is not None else spared).append((start, end, weight))
        return [h for h in hits if not any(s <= h[0] and h[1] <= e for s, e, _ in spared)]

    def measures(self, text) -> tuple[float, float]:
        """Strongest weight, and weights per square root of the length."""
        if not text:
            return 0.0, 0.0
        found = self.matches(text)
        if not found:
            return 0.0, 0.0
        words = max(1, text.count(" ") + text.count("\n"))
        return max(w for *_, w in found), sum(w for *_, w in found) / math.sqrt(words)

    def score(self, text) -> float:
        if not self.weights:
            return 0.0
        a, b, c = self.curve
        x, y = self.measures(text)
        return 1 / (1 + math.exp(-max(-50.0, min(50.0, a + b * x + c * y))))


def _curve(x: np.ndarray, y: np.ndarray) -> tuple[float, ...]:
    """Logistic regression with a small ridge, by Newton steps."""
    X = np.column_stack([np.ones(len(x)), x])
    w, ridge = np.zeros(X.shape[1]), np.diag([1e-3, 1e-1, 1e-1])
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(X @ w, -30, 30)))
        h = X.T @ (X * (p * (1 - p))[:, None]) + ridge
        w = w + np.linalg.solve(h, X.T @ (y - p) - ridge @ w)
    return tuple(float(v) for v in w)


def _cover(texts: DataFrame, table: DataFrame, least: int, page_rows: int) -> dict[str, float]:
    """Greedy choice from ``table`` (feature, w, pos): each entry newly explains
    the most of ``texts`` (key, text), and ``least`` of them at least. Ties go
    to the greater weight, then to the greater feature."""
    chosen: dict[str, float] = {}
    explained: set[str] = set()
    gains = table
    while True:
        page = (gains.where(F.col("pos") >= least)
                .orderBy(F.desc("pos"), F.desc("w"), F.desc("feature")).limit(page_rows + 1)
                .collect())                                             # bounded
        if not page:
            return chosen
        more, page = len(page) > page_rows, page[:page_rows]
        at = {r["feature"]: i for i, r in enumerate(page)}
        known = texts.sparkSession.sparkContext.broadcast((set(explained), at))

        def explain(batches, known=known):
            seen, at = known.value
            for b in batches:
                got = [(k, [at[f] for f in features(t) if f in at])
                       for k, t in zip(b["key"], b["text"], strict=True) if k not in seen]
                got = [g for g in got if g[1]]
                yield pd.DataFrame({"key": [g[0] for g in got], "found": [
                    np.packbits(np.isin(np.arange(len(at)), g[1])).tobytes() for g in got]})

        rows = texts.mapInPandas(explain, "key string, found binary").collect()
        if not rows:
            return chosen
        # bounded: a bit per text of the sample and candidate of the page
        holds = np.array([np.frombuffer(r["found"], np.uint8) for r in rows])
        left, open_ = np.zeros(len(page), np.int64), np.ones(len(rows), bool)
        for i in range(0, len(rows), 1024):
            left += np.unpackbits(holds[i:i + 1024], axis=1, count=len(page)).sum(
                axis=0, dtype=np.int64)
        last = (page[-1]["pos"], page[-1]["w"], page[-1]["feature"])
        weights = np.array([r["w"] for r in page])
        while True:
            top = np.flatnonzero(left == left.max())
            best = max(top.tolist(), key=lambda i: (weights[i], page[i]["feature"]))
            gain, f = int(left[best]), page[best]["feature"]
            if more and (gain, page[best]["w"], f) < last:
                break                    # one outside the page may be better
            if gain < least or not gain:
                return chosen
            chosen[f] = page[best]["w"]
            done = np.flatnonzero(open_ & (holds[:, best >> 3] >> (7 - (best & 7)) & 1 > 0))
            open_[done] = False
            explained.update(rows[i]["key"] for i in done.tolist())
            for i in range(0, len(done), 1024):
                left -= np.unpackbits(holds[done[i:i + 1024]], axis=1, count=len(page)).sum(
                    axis=0, dtype=np.int64)
        seen = texts.sparkSession.sparkContext.broadcast(set(explained))

        def recount(batches, seen=seen):
            for b in batches:
                n = Counter()
                for k, t in zip(b["key"], b["text"], strict=True):
                    if k not in seen.value:
                        n.update(features(t))
                yield pd.DataFrame(list(n.items()), columns=["feature", "pos"])

        gains = materialize(
            texts.mapInPandas(recount, "feature string, pos long")
            .groupBy("feature").agg(F.sum("pos").alias("pos")).where(F.col("pos") >= least)
            .join(table.select("feature", "w"), "feature"), "toxicity-candidates")


def fit(docs: DataFrame, labels: DataFrame, *, train_rows: int = 30_000,
        min_docs: int = 3, min_share: float = 0.002,
        min_log_odds: float = 2.5, page_rows: int = 5000,
        exceptions=EXCEPTIONS, id_col: str = "doc_id", text_col: str = "text",
        label_col: str = "toxic") -> Lexicon:
    """Fit on at most about ``train_rows`` labelled rows, taken by a hash of
    the id. ``labels`` must hold the rows to learn from and no others. A
    candidate occurs in ``min_docs`` toxic texts and ``min_share`` of them at
    least; an entry must newly explain nearly as many. ``page_rows`` candidates
    are on the driver at a time; it doesn't change the result."""
    known = labels.select(F.col(id_col).alias("id"), F.col(label_col).alias("y")).where(
        "y IS NOT NULL AND id IS NOT NULL").dropDuplicates(["id"])
    n = known.count()
    if not n:
        return Lexicon({}, exceptions)
    draw = F.pmod(F.xxhash64(F.lit("toxicity"), "id"), F.lit(1 << 30)) / F.lit(float(1 << 30))
    sample = F.broadcast(known.where(draw < min(1.0, train_rows / n)))   # bounded
    d = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).where(
        "text IS NOT NULL").join(sample, "id").select("text", "y")

    def keys(batches):
        for b in batches:
            yield pd.DataFrame({"key": [hashlib.blake2b(fold(t).encode("utf-8", "replace"),
                                                        digest_size=16).hexdigest()
                                        for t in b.text], "text": b.text, "y": b.y})

    d = materialize(d.mapInPandas(keys, "key string, text string, y int")
                    .groupBy("key", "y").agg(F.min("text").alias("text")), "toxicity-texts")
    sizes = {r["y"]: r["n"] for r in d.groupBy("y").agg(F.count(F.lit(1)).alias("n")).collect()}
    pos, neg = sizes.get(1, 0), sizes.get(0, 0)
    if not pos or not neg:
        return Lexicon({}, exceptions)

    least = max(min_docs, math.ceil(min_share * pos))

    def count(batches):
        for b in batches:
            seen = Counter(), Counter()
            for text, y in zip(b.text, b.y, strict=True):
                seen[int(y)].update(features(text))
            yield pd.DataFrame([(f, seen[1][f], seen[0][f]) for f in seen[0].keys() | seen[1].keys()],
                               columns=["feature", "pos", "neg"])

    odds = (F.log((F.col("pos") + 0.5) / (pos + 1.0))
            - F.log((F.col("neg") + 0.5) / (neg + 1.0)))
    table = materialize(
        d.mapInPandas(count, "feature string, pos long, neg long")
        .groupBy("feature").agg(F.sum("pos").alias("pos"), F.sum("neg").alias("neg"))
        .where(F.col("pos") >= least).withColumn("w", odds)
        .where(F.col("w") >= min_log_odds).select("feature", "w", "pos"), "toxicity-candidates")
    chosen = _cover(d.where("y = 1").select("key", "text"), table, least - 1, page_rows)
    lexicon = Lexicon(chosen, exceptions)

    def measure(batches):
        for b in batches:
            m = [lexicon.measures(t) for t in b.text]
            yield pd.DataFrame({"x": [v[0] for v in m], "z": [v[1] for v in m],
                                "y": b.y.astype(float)})

    got = d.mapInPandas(measure, "x double, z double, y double").toPandas()   # bounded
    lexicon.curve = _curve(got[["x", "z"]].to_numpy(), got["y"].to_numpy())
    return lexicon


def score(docs: DataFrame, lexicon: Lexicon, *, id_col: str = "doc_id",
          text_col: str = "text") -> DataFrame:
    """(id, score) per row."""
    shared = docs.sparkSession.sparkContext.broadcast(lexicon)

    def run(batches):
        for b in batches:
            yield pd.DataFrame({"id": b["id"], "score": [shared.value.score(t)
                                                         for t in b["text"]]})

    # ids travel as strings: a null would turn the others into floats
    d = docs.select(F.col(id_col).cast("string").alias("id"), F.col(text_col).alias("text"))
    return d.mapInPandas(run, "id string, score double").withColumn(
        "id", F.col("id").cast(docs.schema[id_col].dataType))
