"""Exact dedup by content-defined chunk recipes.

Each text is cut where its content says so (see ``CHUNK``), so equal passages
give equal chunks. Chunks are deduplicated to identifiers: a short hash,
verified by SHA-256; chunks whose hashes clash get an ordinal besides. A
document's recipe is its ordered identifier list, and documents are equal
when their recipes are. Only hashes, recipes and the winners travel; no text
is shuffled, however long it is.

Defined results: null text equals the empty text; of equal texts the row
with the largest id stays (a null id is smallest; of repeated rows with the
same id exactly one stays); an empty table gives an empty result; other
columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from kestrel.llm.rows import row_digest
from kestrel.session import materialize, materialize_counted

#: A chunk ends after white space that stands between two letters of certain
#: classes (about one place in 150 of prose), at 256 characters at the
#: earliest and 4096 at the latest.
CHUNK = (r"(?s).{256,4096}?(?:(?<=[dnrst.,]\s)(?=[b-mB-M])|\z)"
         r"|.{4096}|.{1,255}\z")


def recipes(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text",
            hash_bits: int = 64, keep: tuple[str, ...] = ()) -> DataFrame:
    """(row, id, text_sha256, ids, digests, kept): the chunk identifiers and
    chunk digests of each text, in order, and the columns ``keep``. Written once
    to the shared folder."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    d = docs.select(F.col(id_col).alias("id"), text.alias("text"),
                    F.struct(*keep).alias("kept"))
    chunks = F.regexp_extract_all("text", F.lit(CHUNK), F.lit(0))
    d = d.withColumn("chunks", chunks)
    whole = F.concat_ws("", "chunks") == F.col("text")     # the recipe rebuilds the text
    d = d.withColumn("chunks", F.when(whole, F.col("chunks")).otherwise(F.array("text")))
    mask = (1 << hash_bits) - 1 if hash_bits < 64 else -1
    return materialize(d.select(
        F.monotonically_increasing_id().alias("row"), "id",
        F.sha2("text", 256).alias("text_sha256"),
        F.transform("chunks", lambda c: F.xxhash64(c).bitwiseAND(F.lit(mask))).alias("ids"),
        F.transform("chunks", lambda c: F.unhex(F.sha2(c, 256))).alias("digests"),
        *(["kept"] if keep else [])), "recipes")


def _amended(r: DataFrame) -> DataFrame:
    """Recipes with ``amend``: the ordinals of their chunks whose hashes clash."""
    none = F.array().cast("array<struct<pos:int,ordinal:int>>")
    chunks = r.select("row", F.posexplode(F.arrays_zip("ids", "digests")).alias("pos", "c")) \
        .select("row", "pos", F.col("c.ids").alias("h"), F.col("c.digests").alias("digest"))
    clashing, n = materialize_counted(
        chunks.groupBy("h").agg(F.min("digest").alias("low"), F.max("digest").alias("high"))
        .where("low != high").select("h"), "recipe-clashes")
    if not n:                                  # all but always: identifiers are verified
        return r.withColumn("amend", none)
    # identifiers of clashing chunks: (hash, ordinal)
    ordinal = chunks.join(clashing, "h").select("h", "digest").distinct().withColumn(
        "ordinal", F.row_number().over(Window.partitionBy("h").orderBy("digest")))
    amends = (chunks.join(ordinal, ["h", "digest"]).groupBy("row")
              .agg(F.sort_array(F.collect_list(F.struct("pos", "ordinal"))).alias("amend")))
    return r.join(amends, "row", "left").withColumn("amend", F.coalesce("amend", none))


def exact_dedup(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text",
                hash_bits: int = 64) -> DataFrame:
    """One row per input row: row, id, keep_id, group_size, kept, text_sha256."""
    return _judged(recipes(docs, id_col=id_col, text_col=text_col, hash_bits=hash_bits))


def _judged(r: DataFrame) -> DataFrame:
    full = _amended(r.select("row", "id", "text_sha256", "ids", "digests")).drop("digests")
    best = materialize(full.groupBy("ids", "amend").agg(     # a table of its own: Spark can
        F.count(F.lit(1)).alias("group_size"),               # split a hot recipe in the join
        F.max(F.struct("id", "row")).alias("keep")), "recipe-groups")
    j = full.join(best, ["ids", "amend"])
    return j.select("row", "id", F.col("keep.id").alias("keep_id"), "group_size",
                    (F.col("row") == F.col("keep.row")).alias("kept"), "text_sha256")


def distinct_documents(docs: DataFrame, *, id_col: str = "doc_id",
                       text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that stay, with its columns. Of equal texts that
    with the largest id stays, of several such the one with the largest digest
    of all columns: the result is the same in any layout of the table."""
    named = docs.withColumn("__key", F.struct(F.col(id_col), row_digest(docs.columns)))
    r = recipes(named, id_col="__key", text_col=text_col, keep=tuple(docs.columns))
    # a table of its own: of known size, so that texts move only if it is large
    gone = materialize(_judged(r).where(~F.col("kept")).select("row"), "exact-gone")
    return r.select("row", "kept").join(gone, "row", "left_anti").select("kept.*")
