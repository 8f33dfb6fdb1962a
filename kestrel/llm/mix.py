"""Mixing sources to target weights.

Every row gets a hash-random key. Within a source the rows are taken in key
order until the source's exact word budget is used up; budgets above the
source's size take whole passes (epochs) first and cut only the last one.

The order is never built by one task: the key range is cut into equal
buckets (the key is uniform, so buckets are even whatever the source's
share), bucket totals are prefix-summed per source, and the rows of a bucket
are prefix-summed on their own from that offset.

Defined results: null or word-less text has size 0 and is never taken; a
null source is a source of its own (last); repeated rows count as separate
rows; an empty table gives an empty result. Columns other than the three
named ones are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kestrel.llm.rows import ordinals, row_digest
from kestrel.session import materialize, materialize_counted

WORD = r"[^\x20\x09-\x0D]+"
KEY_BITS = 52


def word_count(text: Column) -> Column:
    """Number of words between ASCII white space (null: 0)."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def random_key(id_col: Column, seed: int) -> Column:
    """Uniform 52-bit key from md5, the same in every engine and rerun."""
    named = F.concat(F.lit(f"{seed}:"), F.coalesce(id_col.cast("string"), F.lit("")))
    return F.conv(F.substring(F.md5(named.cast("binary")), 1, KEY_BITS // 4),
                  16, 10).cast("long")


def targets(totals: DataFrame, weights: tuple[int, ...], share: float,
            max_epochs: int) -> DataFrame:
    """(source, source_size) -> (source, source_size, target).

    ``share`` of all words is split by weight; a target stops at
    ``max_epochs`` times its source's size and the excess is reshared by
    weight. In closed form: target = min(cap, level * weight), where level is
    the largest value of (all - caps of smaller ratios) / remaining weights
    over the sources ordered by cap / weight. One row per source.
    """
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    place = (F.row_number().over(by_name) - 1) % len(weights)
    weight = F.element_at(F.array(*[F.lit(w) for w in weights]), place + 1)
    t = (totals.withColumn("weight", weight.cast("long"))
         .withColumn("cap", F.col("source_size") * max_epochs))
    fill = Window.orderBy(F.col("cap") / F.col("weight"), F.col("source").asc_nulls_last())
    before = F.coalesce(F.sum("cap").over(fill.rowsBetween(Window.unboundedPreceding, -1)),
                        F.lit(0))
    rest = F.sum("weight").over(fill.rowsBetween(0, Window.unboundedFollowing))
    every = Window.partitionBy()
    total = F.sum("source_size").over(every).cast("double") * F.lit(float(share))
    t = t.withColumn("level", (total - before) / rest)
    return t.select("source", "source_size",
                    F.least(F.col("cap").cast("double"),
                            F.max("level").over(every) * F.col("weight")).alias("target"))


def mix(docs: DataFrame, *, weights: tuple[int, ...] = (3, 1, 2), share: float = 1.5,
        max_epochs: int = 2, seed: int = 11, bucket_rows: int = 50_000,
        id_col: str = "doc_id", text_col: str = "text",
        source_col: str = "source") -> DataFrame:
    """One row per input row: id, source, size, source_size, target, taken,
    epochs (whole passes) and cut (words of the last, partial pass).

    The words taken from a source sum to floor(target) exactly.
    """
    d = docs.select(F.col(id_col).alias("id"), F.col(source_col).alias("source"),
                    word_count(F.col(text_col)).alias("size"))
    return _placed(d.withColumn("key", random_key(F.col("id"), seed)), weights, share,
                   max_epochs, bucket_rows)


def _placed(keyed: DataFrame, weights: tuple[int, ...], share: float, max_epochs: int,
            bucket_rows: int) -> DataFrame:
    """``mix`` of (id, source, size, key) rows."""
    sized, rows = materialize_counted(keyed, "mix-sizes")
    cells = max(1, -(-rows // bucket_rows))
    bits = min(KEY_BITS, (cells - 1).bit_length())
    sized = sized.withColumn("bucket", F.shiftright("key", KEY_BITS - bits))
    sums = materialize(sized.groupBy("source", "bucket").agg(F.sum("size").alias("words")),
                       "mix-buckets")
    plan = targets(sums.groupBy("source").agg(F.sum("words").alias("source_size")),
                   weights, share, max_epochs)
    epochs = F.when(F.col("source_size") > 0,
                    F.floor(F.col("target") / F.col("source_size"))).otherwise(0)
    plan = plan.withColumn("epochs", epochs.cast("long")).withColumn(
        "rest", F.floor(F.col("target")).cast("long") - F.col("epochs") * F.col("source_size"))
    run = Window.partitionBy("source").orderBy("bucket")
    offsets = (sums.withColumn("offset", F.sum("words").over(run) - F.col("words"))
               .select(F.col("source").alias("s"), F.col("bucket").alias("b"), "offset"))
    cell = (offsets.join(plan, F.col("s").eqNullSafe(F.col("source"))).drop("source"))
    inner = (Window.partitionBy("source", "bucket").orderBy("key", "id", "size")
             .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    placed = sized.withColumn("upto", F.sum("size").over(inner))
    j = placed.join(cell, F.col("source").eqNullSafe(F.col("s"))
                    & (F.col("bucket") == F.col("b")))
    left = F.col("rest") - F.col("offset") - (F.col("upto") - F.col("size"))
    j = j.withColumn("cut", F.greatest(F.lit(0), F.least(F.col("size"), left)).cast("long"))
    return j.select("id", "source", "size", "source_size", "target",
                    (F.col("epochs") * F.col("size") + F.col("cut")).alias("taken"),
                    "epochs", "cut")


def mixed_documents(docs: DataFrame, *, weights: tuple[int, ...] = (3, 1, 2),
                    share: float = 1.5, max_epochs: int = 2, seed: int = 11,
                    bucket_rows: int = 50_000, id_col: str = "doc_id", text_col: str = "text",
                    source_col: str = "source") -> DataFrame:
    """The mix itself, with the columns of ``docs``: each row once per whole
    pass and once more when the last pass takes it; the row at the cut keeps
    the first words of its text that the budget pays for. Rows that the mix
    does not take are absent, word-less ones included. Keys are drawn from the
    id, the digest of all columns and an ordinal among equal rows, so the same
    rows give the same mix in any layout."""
    held = materialize(docs.withColumn("__row", F.monotonically_increasing_id()).withColumn(
        "__digest", row_digest(docs.columns)), "mix-docs")
    number = ordinals(held, "__row", "__digest")
    sized = held.select("__row", "__digest", id_col, F.col(source_col).alias("source"),
                        word_count(F.col(text_col)).alias("size")).join(number, "__row")
    name = F.concat_ws(":", F.col(id_col).cast("string"), "__digest", "ordinal")
    plan = _placed(sized.select(
        F.struct(name.alias("name"), "__row").alias("id"), "source", "size",
        random_key(name, seed).alias("key")), weights, share, max_epochs, bucket_rows).select(
        F.col("id.__row").alias("__row"), F.col("size").alias("__size"),
        F.col("epochs").alias("__epochs"), F.col("cut").alias("__cut"))
    plan = plan.where((F.col("__size") > 0) & (F.col("__epochs") + F.col("__cut") > 0))
    j = held.join(plan, "__row")
    part = (F.col("__cut") > 0).cast("int")
    j = j.withColumn("__pass", F.explode(F.sequence(
        F.lit(1), (F.col("__epochs") + part).cast("int"))))
    words = F.regexp_extract_all(F.col(text_col), F.lit(r"[\x20\x09-\x0D]*" + WORD), F.lit(0))
    cut = ((F.col("__pass") > F.col("__epochs")) & (F.col("__cut") < F.col("__size")))
    text = F.when(cut, F.concat_ws("", F.slice(words, 1, F.col("__cut").cast("int")))).otherwise(
        F.col(text_col))
    return j.withColumn(text_col, text).select(*docs.columns)
