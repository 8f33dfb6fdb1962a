"""How filters of a corpus interact, for every order in which they may run.

A document that fails the filters of a bit mask survives exactly the subsets
of filters that avoid it. With five filters there are 32 subsets, so the
document's truth table is one 32-bit word: bit S is set when the document
survives all filters of the subset S. Counting the words bit by bit gives the
survivors of every subset at once, and every count of every order follows
from them: what a filter removes after the filters of P are the survivors of
P less those of P and the filter.

The bits are counted by carry-save adders: three words of a weight become one
word of the same weight (their sum bits) and one of twice the weight (their
carries), for all 32 positions in the same few operations, until two words or
fewer are left of each weight. Every task counts its own rows per part and
flags; only those counts are shuffled.

Defined results: null text is the empty text (0 words); a null part is the
empty string; a null id is never a copy and has no labels; repeated rows count
one by one, and rows of the same id and text are not copies of each other; of
several label rows of an id, one with the value is enough; other columns are
ignored; an empty table gives an empty result. Texts are looked at whole, and
only digests of them travel.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kestrel.session import materialize

WORD = r"[^\x20\x09-\x0D]+"
MOST_FILTERS = 5             # 2^5 subsets are the bits of one word
HELD = 20_000                # parts and flags that a task holds before it hands them on


def survival_words(filters: int) -> np.ndarray:
    """The word of every failure mask: bit S says that the subset S keeps it."""
    if not 1 <= filters <= MOST_FILTERS:
        raise ValueError(f"1 to {MOST_FILTERS} filters, not {filters}")
    masks = np.arange(1 << filters, dtype=np.uint32)
    keeps = (masks[:, None] & masks[None, :]) == 0
    return (keeps.astype(np.uint32) << masks[None, :]).sum(axis=1, dtype=np.uint32)


def positional_popcounts(words: np.ndarray, bits: int) -> np.ndarray:
    """How many of ``words`` have each of the lowest ``bits`` bits set."""
    counts, weight = np.zeros(bits, np.int64), 1
    places = np.arange(bits, dtype=np.uint32)
    while len(words):
        carries = []
        while len(words) > 2:
            n = len(words) // 3
            a, b, c = words[:n], words[n:2 * n], words[2 * n:3 * n]
            half = a ^ b
            carries.append((a & b) | (half & c))
            words = np.concatenate([half ^ c, words[3 * n:]])
        for word in words:
            counts += weight * ((word >> places) & np.uint32(1)).astype(np.int64)
        words = np.concatenate(carries) if carries else words[:0]
        weight *= 2
    return counts


def survivors(rows: DataFrame, filters: int) -> DataFrame:
    """(part, flags, fails) rows -> (part, flags, survivors): per subset of
    the filters (a mask, the place in the array) the rows that survive it. A
    part comes several times, once per task or more; sum them up."""
    words, bits = survival_words(filters), 1 << filters

    def table(held):
        return pd.DataFrame({"part": [p for p, _ in held], "flags": [f for _, f in held],
                             "survivors": [c.tolist() for c in held.values()]})

    def count(batches):
        held: dict = {}
        for batch in batches:
            for key, rows in batch.groupby(["part", "flags"], sort=False):
                got = positional_popcounts(words[rows["fails"].to_numpy()], bits)
                held[key] = held[key] + got if key in held else got
            if len(held) > HELD:
                yield table(held)
                held = {}
        if held:
            yield table(held)

    return rows.select("part", "flags", "fails").mapInPandas(
        count, "part string, flags int, survivors array<long>")


def audit(rows: DataFrame, filters: str, flags: tuple[str, ...] = ()) -> DataFrame:
    """(part, flags, fails) rows -> one row per part, order of the filters and
    step: part, filter_order, step, kept, removed, redundant, unique_fails,
    one ``<flag>_lost`` per flag, shapley.

    ``filters`` names the bits of ``fails`` (from the lowest), one letter
    each; ``flags`` names those of ``flags``.
    """
    k = len(filters)
    subsets = 1 << k

    have = [F.col("flags").bitwiseAND(F.lit(1 << i)) != 0 for i in range(len(flags))]
    cells = survivors(rows, k).select("part", "flags", F.posexplode("survivors").alias("subset", "n"))
    counts = [F.sum("n").alias("all"), *[
        F.coalesce(F.sum(F.when(h, F.col("n"))), F.lit(0)).alias(f"_{i}")
        for i, h in enumerate(have)]]
    parts = cells.groupBy("part", "subset").agg(*counts).groupBy("part").agg(
        F.sort_array(F.collect_list(F.struct("subset", "all", *[
            f"_{i}" for i in range(len(flags))]))).alias("s"))     # 2^k entries a part
    parts = materialize(parts.select("part", "s.all", *[f"s._{i}" for i in range(len(flags))]),
                        "audit-parts")

    def alone(x: int) -> str:               # its removals, summed over all orders
        return " + ".join(
            f"{math.factorial(p.bit_count()) * math.factorial(k - 1 - p.bit_count())}"
            f" * (all[{p}] - all[{p | 1 << x}])" for p in range(subsets) if not p >> x & 1)

    parts = parts.withColumn("alone", F.expr(f"array({', '.join(map(alone, range(k)))})"))
    orders = [""]
    for _ in range(k):
        orders = [o + f for o in orders for f in filters if f not in o]
    steps = parts.withColumn("filter_order", F.explode(F.split(F.lit(" ".join(orders)), " "))) \
        .withColumn("step", F.explode(F.sequence(F.lit(1), F.lit(k))))
    place = F.instr(F.lit(filters), F.substring("filter_order", F.col("step"), F.lit(1))) - 1
    before = sum((F.when(F.instr("filter_order", f) < F.col("step"), 1 << i).otherwise(0)
                  for i, f in enumerate(filters)), F.lit(0))
    steps = steps.withColumn("place", place).withColumn("before", before).withColumn(
        "own", F.element_at(F.array(*[F.lit(1 << i) for i in range(k)]), F.col("place") + 1))
    after = F.col("before") + F.col("own")

    def at(counts: str, mask: Column) -> Column:
        return F.element_at(F.col(counts), (mask + 1).cast("int"))

    def lost(counts: str) -> Column:
        return at(counts, F.col("before")) - at(counts, after)

    every = F.lit(subsets - 1)
    fails = F.col("all")[0] - at("all", F.col("own"))
    return steps.select(
        "part", "filter_order", "step", at("all", after).alias("kept"),
        lost("all").alias("removed"), (fails - lost("all")).alias("redundant"),
        (at("all", every - F.col("own")) - F.col("all")[subsets - 1]).alias("unique_fails"),
        *[lost(f"_{i}").alias(f"{name}_lost") for i, name in enumerate(flags)],
        F.element_at("alone", F.col("place") + 1).alias("shapley"))


def text_failures(text: Column, *, min_words: int, min_distinct: int, max_capitals: int,
                  signs: str) -> list[Column]:
    """Failures that the text alone decides: fewer than ``min_words`` words;
    distinct words below ``min_distinct`` % of all; A-Z above ``max_capitals``
    % of the code points; a character of the class ``signs``."""
    words = F.regexp_extract_all(text, F.lit(WORD), F.lit(0))
    return [F.size(words) < min_words,
            100 * F.size(F.array_distinct(words)) < min_distinct * F.size(words),
            100 * F.regexp_count(text, F.lit("[A-Z]")).cast("long")
            > max_capitals * F.length(text).cast("long"),
            text.rlike(signs)]


def mask(bits: list[Column]) -> Column:
    return sum((F.when(b, 1 << i).otherwise(0) for i, b in enumerate(bits)), F.lit(0))


def document_failures(docs: DataFrame, labels: DataFrame, flags: dict[str, str], *,
                      min_words: int = 200, min_distinct: int = 50, max_capitals: int = 3,
                      signs: str = "[#$%&*|]", id_col: str = "doc_id",
                      text_col: str = "text", part_col: str = "lang") -> DataFrame:
    """(part, flags, fails) per row of ``docs``: the failures of
    ``text_failures`` and, as the highest bit, a text that some row with a
    smaller id has too. ``flags`` are SQL conditions on the
    rows of ``labels``."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    d = docs.select(F.col(id_col).alias("id"), text.alias("text"),
                    F.coalesce(F.col(part_col).cast("string"), F.lit("")).alias("part"))
    own = text_failures(F.col("text"), min_words=min_words, min_distinct=min_distinct,
                        max_capitals=max_capitals, signs=signs)
    d = materialize(d.select("id", "part", mask(own).alias("fails"),
                             F.unhex(F.sha2("text", 256)).alias("digest")), "audit-texts")
    named = d.where("id IS NOT NULL")
    # joined by digest and id, so that a hot text is spread by its ids; tables
    # of their own on the right, so that Spark can split repeated rows too
    first = materialize(named.groupBy("digest").agg(F.min("id").alias("id")), "audit-first")
    marks = materialize(labels.where(F.col(id_col).isNotNull()).groupBy(
        F.col(id_col).alias("id")).agg(F.bit_or(mask([F.expr(c) for c in flags.values()])).alias("flags")),
        "audit-labels")
    named = (named.join(first.withColumn("first", F.lit(True)), ["digest", "id"], "left")
             .join(marks, "id", "left"))
    copy = F.when(F.col("first").isNull(), 1 << len(own)).otherwise(0)
    named = named.select("part", F.coalesce("flags", F.lit(0)).alias("flags"),
                         (F.col("fails") + copy).alias("fails"))
    return named.unionByName(d.where("id IS NULL").select(
        "part", F.lit(0).alias("flags"), "fails"))
