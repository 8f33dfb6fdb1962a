"""The training-data pipeline: five stages over ``documents``.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; ``run``
writes it as Parquet under the session's shared folder and rereads it as the
next stage's input. All stages but the last return the columns of the table.

No stage's choice depends on files, partitions or cores: ties are decided by
the id, then by a digest of all columns. Null ids and repeated rows are allowed
(a null id is smallest), texts of any length are worked on whole, empty tables
give empty results.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kestrel.llm import bpe, langid
from kestrel.llm.exact_dedup import distinct_documents
from kestrel.llm.jaccard_join import one_of_each
from kestrel.llm.mix import mixed_documents
from kestrel.session import scratch_path, table_scope

#: Text that a task of the near-duplicate and BPE stages holds at once: executors
#: that run all stages have less room than those of the single queries.
BLOCK_BYTES = 4 << 20


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejects documents without a language: no text, no letters, or no word
    and no n-gram that the model knows. The model learns from the rows that the
    language query may learn from; without any, all texts with letters stay."""
    model = langid.fit(docs.where(langid.crc_mod(F.col("doc_id"), 4) != 2))
    return (langid.labelled(docs, model).where("__lang.known")
            .select(*docs.columns))


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the row with the largest id stays; null text is empty."""
    return distinct_documents(docs)


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates stays (five words,
    0.8): the one with the smallest id. Texts without words stay."""
    return one_of_each(docs, n=5, threshold=80, block_bytes=BLOCK_BYTES)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix of sources to weights 3, 1, 2 at 150 % of all words; documents
    of sources above their size come again (at most twice in all)."""
    return mixed_documents(docs, weights=(3, 1, 2), share=1.5, max_epochs=2, seed=11)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Byte-level BPE ids of every document of the mix, and the SHA-256 of
    what they decode to."""
    import public_tokenizers
    ranks = bpe.load_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken"))
    out = bpe.decode(bpe.encode(docs, ranks, public_tokenizers.PATTERN,
                                block_bytes=BLOCK_BYTES), ranks)
    return out.select(F.col("id").alias("doc_id"), "n_tokens",
                      F.sha2("ids", 256).alias("ids_sha256"),
                      F.sha2("decoded", 256).alias("decoded_sha256"))


STAGES = [("language ID", language), ("exact dedup", exact), ("near duplicates", near),
          ("mixing", mixed), ("byte-level BPE", tokens)]

#: Language ID, near duplicates and BPE are not expressible in SQL; the tests
#: compare run() with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``. The tables that a stage wrote for itself
    are removed as soon as its result is written."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        path = scratch_path(spark, "stage-" + name.replace(" ", "-"))
        with table_scope(spark):
            out = stage(spark, docs, sf_dir)
            out.write.parquet(path)
        docs = spark.read.schema(out.schema).parquet(path)
    return STAGES[-1][1](spark, docs, sf_dir)
