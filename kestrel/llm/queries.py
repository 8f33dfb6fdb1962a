"""Registered queries of the training-data operators and their DuckDB SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def _read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# ------------------------------------------------------------------ 1: mix

MIX_WEIGHTS = (3, 1, 2)
MIX_SHARE = 1.5
MIX_MAX_EPOCHS = 2
MIX_SEED = 11


def op1_mix_sources(spark, sf_dir):
    """Mix of all documents to source weights 3, 1, 2, 150 % of all words."""
    from kestrel.llm.mix import mix
    out = mix(_read(spark, sf_dir, "documents"), weights=MIX_WEIGHTS, share=MIX_SHARE,
              max_epochs=MIX_MAX_EPOCHS, seed=MIX_SEED)
    return out.select(F.col("id").alias("doc_id"), "size", "source_size", "target", "taken")


OP1_SQL = f"""
WITH sized AS (
  SELECT doc_id, source,
         coalesce(len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')), 0)::BIGINT AS size,
         ('0x' || substr(md5('{MIX_SEED}:' || coalesce(doc_id::VARCHAR, '')), 1, 13))::BIGINT AS key
  FROM documents),
totals AS (SELECT source, sum(size)::BIGINT AS source_size FROM sized GROUP BY source),
weighted AS (
  SELECT *, source_size * {MIX_MAX_EPOCHS} AS cap,
         [{', '.join(map(str, MIX_WEIGHTS))}]
           [1 + (row_number() OVER (ORDER BY source NULLS LAST) - 1) % {len(MIX_WEIGHTS)}] AS weight
  FROM totals),
levels AS (
  SELECT *, (sum(source_size) OVER ()::DOUBLE * {MIX_SHARE}::DOUBLE
             - coalesce(sum(cap) OVER (ORDER BY cap::DOUBLE / weight, source NULLS LAST
                        ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::DOUBLE)
            / sum(weight) OVER (ORDER BY cap::DOUBLE / weight, source NULLS LAST
                        ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)::DOUBLE AS level
  FROM weighted),
plan AS (
  SELECT source, source_size, least(cap::DOUBLE, max(level) OVER () * weight) AS target
  FROM levels),
budget AS (
  SELECT *, CASE WHEN source_size > 0 THEN floor(target / source_size) ELSE 0 END::BIGINT AS epochs
  FROM plan),
placed AS (
  SELECT s.doc_id, s.size, b.source_size, b.target, b.epochs,
         floor(b.target)::BIGINT - b.epochs * b.source_size AS rest,
         sum(s.size) OVER (PARTITION BY s.source ORDER BY s.key, s.doc_id, s.size
                           ROWS UNBOUNDED PRECEDING) - s.size AS before
  FROM sized s JOIN budget b ON s.source IS NOT DISTINCT FROM b.source)
SELECT doc_id, size, source_size, target,
       (epochs * size + greatest(0, least(size, rest - before)))::BIGINT AS taken
FROM placed
"""


# ---------------------------------------------------------- 2: exact dedup

def op2_exact_dedup(spark, sf_dir):
    """Exact dedup of all documents by chunk recipes; the largest id stays."""
    from kestrel.llm.exact_dedup import exact_dedup
    out = exact_dedup(_read(spark, sf_dir, "documents"))
    return out.select(F.col("id").alias("doc_id"), "keep_id", "group_size", "kept",
                      "text_sha256")


OP2_SQL = """
SELECT doc_id, max(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
       doc_id = max(doc_id) OVER w AS kept, sha256(coalesce(text, '')) AS text_sha256
FROM documents WINDOW w AS (PARTITION BY coalesce(text, ''))
"""


# ----------------------------------------------------------- 3: URL filter

URL_RULES = [("block", "net", "/"), ("allow", "example.net", "/en/"),
             ("block", "example.com", "/de/"), ("allow", "org", "/fr/")]


def op3_url_filter(spark, sf_dir):
    """Verdict for every page URL under four host and path rules."""
    from kestrel.llm.url_filter import judge_urls
    rules = spark.createDataFrame(URL_RULES, "action string, host string, path string")
    out = judge_urls(_read(spark, sf_dir, "pages"), rules)
    return out.select(F.col("id").alias("page_id"), "host", "path", "rule", "verdict")


OP3_SQL = f"""
WITH rules(action, host, path) AS (VALUES {', '.join(map(str, URL_RULES))}),
rest AS (
  SELECT page_id, CASE WHEN contains(url, '://')
                       THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest
  FROM pages),
p AS (
  SELECT page_id, translate(regexp_extract(rest, '^[^/?#]*', 0),
              'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(rest, '^[^/?#]*(/[^?#]*)', 1) AS path
  FROM rest),
hits AS (
  SELECT p.page_id, p.host, p.path, r.host || r.path AS rule, r.action,
         row_number() OVER (PARTITION BY p.page_id ORDER BY length(r.host || r.path) DESC,
                            length(r.host) DESC, r.action DESC) AS n
  FROM p LEFT JOIN rules r
    ON (p.host = r.host OR ends_with(p.host, '.' || r.host)) AND starts_with(p.path, r.path))
SELECT page_id, host, path, rule, coalesce(action, 'allow') AS verdict FROM hits WHERE n = 1
"""


# ------------------------------------------------------------- 4: toxicity

def op4_toxicity(spark, sf_dir):
    """Toxicity score of every document; learns from the rows not held out."""
    from kestrel.llm import toxicity
    from kestrel.llm.langid import crc_mod
    docs, labels = _read(spark, sf_dir, "documents"), _read(spark, sf_dir, "labels")
    lexicon = toxicity.fit(docs, labels.where(crc_mod(F.col("doc_id"), 5) != 0))
    return toxicity.score(docs, lexicon).select(
        F.col("id").alias("doc_id"),
        F.coalesce(crc_mod(F.col("id"), 5) == 0, F.lit(False)).alias("held_out"), "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"))


# ------------------------------------------------ 5: embedding near-dedup

def op5_embedding_dedup(spark, sf_dir):
    """Links of all embeddings at cosine 0.9 and their components."""
    from kestrel.llm.embed_dedup import embed_dedup
    return embed_dedup(_read(spark, sf_dir, "embeddings")).select(
        F.col("id").alias("vec_id"), "n_links", "component_id", "kept")


# ---------------------------------------------------------- 6: language ID

def op6_language_id(spark, sf_dir):
    """Language of every document; learns from the rows not held out."""
    from kestrel.llm import langid
    docs = _read(spark, sf_dir, "documents")
    model = langid.fit(docs.where(langid.crc_mod(F.col("doc_id"), 4) != 2))
    return langid.predict(docs, model).select(
        F.col("id").alias("doc_id"),
        F.coalesce(langid.crc_mod(F.col("id"), 4) == 2, F.lit(False)).alias("held_out"),
        "lang_pred", "score")


# ----------------------------------------------------- 7: Jaccard join

def op7_jaccard_join(spark, sf_dir):
    """Classes of documents whose 4-word shingles overlap by 85 % or more."""
    from kestrel.llm.jaccard_join import jaccard_join
    return jaccard_join(_read(spark, sf_dir, "documents"), n=4, threshold=85).select(
        F.col("id").alias("doc_id"), "n_shingles", "component_id")


# -------------------------------------------------------- 8: byte-level BPE

def op8_byte_bpe(spark, sf_dir):
    """Byte-level BPE ids of every document, and what they decode to."""
    import public_tokenizers

    from kestrel.llm import bpe
    ranks = bpe.load_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken"))
    ids = bpe.encode(_read(spark, sf_dir, "documents"), ranks, public_tokenizers.PATTERN)
    return bpe.decode(ids, ranks).select(
        F.col("id").alias("doc_id"), "n_tokens", F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"))


# ------------------------------------------------------- 9: substring dedup

def op9_substring_dedup(spark, sf_dir):
    """Words of every document outside passages of smaller documents."""
    from kestrel.llm.substring import substring_dedup
    return substring_dedup(_read(spark, sf_dir, "documents")).select(
        F.col("id").alias("doc_id"), "n_words", "n_removed",
        F.sha2(F.col("kept").cast("binary"), 256).alias("kept_sha256"))


# -------------------------------------------------------- 10: token counts

TOKEN_LIMIT = 2048


def op10_token_counts(spark, sf_dir):
    """Token count of every document by the word-level vocabulary."""
    import public_tokenizers

    from kestrel.llm.token_count import count_tokens
    out = count_tokens(_read(spark, sf_dir, "documents"),
                       public_tokenizers.path("word_bpe_49k.json"))
    return out.select(F.col("id").alias("doc_id"), "n_bytes", "n_tokens",
                      (F.col("n_tokens") > TOKEN_LIMIT).alias("over_limit"))


# ---------------------------------------------- 11: filter interaction audit

AUDIT_FILTERS = "ABCDE"
AUDIT_FLAGS = {"good": "quality = 1", "toxic": "toxic = 1"}


def op11_filter_audit(spark, sf_dir):
    """What each of five filters removes, in every order, per language."""
    from kestrel.llm.filter_audit import audit, document_failures
    rows = document_failures(_read(spark, sf_dir, "documents"), _read(spark, sf_dir, "labels"),
                             AUDIT_FLAGS)
    return audit(rows, AUDIT_FILTERS, tuple(AUDIT_FLAGS))


OP11_SQL = """
WITH d AS (
  SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS text,
         regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words
  FROM documents),
marks AS (
  SELECT doc_id, bool_or(quality = 1) AS good, bool_or(toxic = 1) AS toxic
  FROM labels GROUP BY doc_id),
f AS (
  SELECT d.part, coalesce(m.good, false) AS good, coalesce(m.toxic, false) AS toxic,
         (len(words) < 200)::INT
         + 2 * (100 * len(list_distinct(words)) < 50 * len(words))::INT
         + 4 * (100 * length(regexp_replace(text, '[^A-Z]', '', 'g')) > 3 * length(text))::INT
         + 8 * regexp_matches(text, '[#$%&*|]')::INT
         + 16 * coalesce(min(d.doc_id) OVER (PARTITION BY text) < d.doc_id, false)::INT AS fails
  FROM d LEFT JOIN marks m ON m.doc_id = d.doc_id),
cells AS (SELECT part, fails, good, toxic, count(*) AS n FROM f GROUP BY ALL),
letters(l, bit) AS (VALUES ('A', 1), ('B', 2), ('C', 4), ('D', 8), ('E', 16)),
orders AS (
  SELECT a.l || b.l || c.l || d.l || e.l AS filter_order
  FROM letters a, letters b, letters c, letters d, letters e
  WHERE a.bit + b.bit + c.bit + d.bit + e.bit = 31
    AND (a.bit | b.bit | c.bit | d.bit | e.bit) = 31),
steps AS (
  SELECT filter_order, step::INT AS step, own.bit AS own,
         (SELECT coalesce(sum(l2.bit), 0)::INT FROM letters l2
          WHERE strpos(filter_order, l2.l) < step) AS before
  FROM orders, range(1, 6) r(step)
  JOIN letters own ON own.l = substr(filter_order, step::INT, 1)),
counted AS (
  SELECT c.part, s.filter_order, s.step, s.own,
         sum(n) FILTER (WHERE fails & (before | own) = 0) AS kept,
         sum(n) FILTER (WHERE fails & before = 0 AND fails & own <> 0) AS removed,
         sum(n) FILTER (WHERE fails & before <> 0 AND fails & own <> 0) AS redundant,
         sum(n) FILTER (WHERE fails = own) AS unique_fails,
         sum(n) FILTER (WHERE good AND fails & before = 0 AND fails & own <> 0) AS good_lost,
         sum(n) FILTER (WHERE toxic AND fails & before = 0 AND fails & own <> 0) AS toxic_lost
  FROM steps s, cells c GROUP BY ALL)
SELECT part, filter_order, step, coalesce(kept, 0)::BIGINT AS kept,
       coalesce(removed, 0)::BIGINT AS removed, coalesce(redundant, 0)::BIGINT AS redundant,
       coalesce(unique_fails, 0)::BIGINT AS unique_fails,
       coalesce(good_lost, 0)::BIGINT AS good_lost, coalesce(toxic_lost, 0)::BIGINT AS toxic_lost,
       coalesce(sum(removed) OVER (PARTITION BY part, own), 0)::BIGINT AS shapley
FROM counted
"""


# -------------------------------------------------- 12: ranked lexical search

SEARCH_TOP = 20


def op12_lexical_search(spark, sf_dir):
    """The 20 best of all documents for every benchmark item."""
    from kestrel.llm.lexical_search import lexical_search
    return lexical_search(_read(spark, sf_dir, "documents"), _read(spark, sf_dir, "benchmark"),
                          k=SEARCH_TOP).withColumnRenamed("id", "doc_id")


_TERMS_SQL = r"""regexp_extract_all(
    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')"""

OP12_SQL = f"""
WITH d AS (SELECT doc_id, {_TERMS_SQL} AS terms FROM documents),
sized AS (SELECT doc_id, terms, len(terms)::BIGINT AS n FROM d WHERE len(terms) > 0),
stats AS (SELECT count(*)::BIGINT AS docs, sum(n)::BIGINT AS words FROM sized),
posting AS (
  SELECT doc_id, n, term, count(*)::BIGINT AS tf
  FROM (SELECT doc_id, n, unnest(terms) AS term FROM sized) GROUP BY ALL),
weight AS (
  SELECT term, floor(1000 * ln((2 * docs + 2)::DOUBLE / (2 * count(*) + 1)::DOUBLE))::BIGINT AS w
  FROM posting, stats GROUP BY term, docs),
asked AS (
  SELECT item_id, term, count(*)::BIGINT AS c
  FROM (SELECT item_id, unnest({_TERMS_SQL}) AS term FROM benchmark) GROUP BY ALL),
scored AS (
  SELECT item_id, doc_id, sum(c * w * ((1000000000 * tf)
           // (1000 * tf + 12 * (100 - 25 + (25 * n * docs) // words))))::BIGINT AS score
  FROM asked JOIN posting USING (term) JOIN weight USING (term), stats
  GROUP BY item_id, doc_id)
SELECT item_id, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id)::INT AS rank,
       doc_id, score
FROM scored WHERE score > 0
QUALIFY rank <= {SEARCH_TOP}
"""


# ------------------------------------------------------- 13: WARC archives

def op13_warc(spark, sf_dir):
    """All pages written as ARC archives, converted to WARC and read back."""
    from kestrel.llm.warc import convert_pages
    return convert_pages(_read(spark, sf_dir, "pages")).withColumnRenamed("key", "page_id")


OP13_SQL = """
WITH p AS (SELECT page_id, coalesce(html, '') AS html FROM pages),
g AS (SELECT page_id, html, strlen(html) AS payload_bytes,
             CASE WHEN strlen(html) >= 1000 THEN max(page_id) OVER (PARTITION BY html) END AS last
      FROM p)
SELECT page_id, payload_bytes, sha1(html) AS payload_digest,
       CASE WHEN last <> page_id THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN last <> page_id THEN last END AS refers_to
FROM g
"""


QUERIES = {
    "op1_mix_sources": op1_mix_sources,
    "op2_exact_dedup": op2_exact_dedup,
    "op3_url_filter": op3_url_filter,
    "op4_toxicity": op4_toxicity,
    "op5_embedding_dedup": op5_embedding_dedup,
    "op6_language_id": op6_language_id,
    "op7_jaccard_join": op7_jaccard_join,
    "op8_byte_bpe": op8_byte_bpe,
    "op9_substring_dedup": op9_substring_dedup,
    "op10_token_counts": op10_token_counts,
    "op11_filter_audit": op11_filter_audit,
    "op12_lexical_search": op12_lexical_search,
    "op13_warc": op13_warc,
}

ORACLE = {
    "op1_mix_sources": OP1_SQL,
    "op2_exact_dedup": OP2_SQL,
    "op3_url_filter": OP3_SQL,
    "op11_filter_audit": OP11_SQL,
    "op12_lexical_search": OP12_SQL,
    "op13_warc": OP13_SQL,
}
