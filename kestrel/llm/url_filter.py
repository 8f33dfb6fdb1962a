"""URL rules: host-suffix and path-prefix expressions.

Every distinct (host, path) is expanded into the expressions that a rule
could be written as: its host suffixes at label borders times its path
prefixes. Only suffix and prefix lengths that some rule has are expanded, so
the number of expressions is bounded by the rules, not by the URL. The
expressions meet the rules on a short prefix of their SHA-256 digest; the
full digest confirms, and the rule of the highest precedence decides.

Precedence: the longest rule (host + path) wins, then the longer host, then
block before allow. Defined results: a null URL or one without ``://`` has an
empty host and path and no rule; repeated rows are all judged; an empty table
gives an empty result; without a rule the verdict is ``default``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kestrel.session import materialize

SHORT = 8          # hex digits of the digest that the join compares


def _lower(text: Column) -> Column:
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def _after_scheme(url: Column) -> Column:
    at = F.locate("://", url)
    return F.when(at > 0, F.substring(url, at + 3, F.lit(2147483647))).otherwise("")


def host_of(url: Column) -> Column:
    return _lower(F.regexp_extract(F.coalesce(_after_scheme(url), F.lit("")),
                                   r"^[^/?#]*", 0))


def path_of(url: Column) -> Column:
    return F.regexp_extract(F.coalesce(_after_scheme(url), F.lit("")),
                            r"^[^/?#]*(/[^?#]*)", 1)


def rule_table(rules: DataFrame) -> DataFrame:
    """(action, host, path) -> rules with digest, short prefix and rank."""
    host = _lower(F.col("host"))
    r = rules.select("action", host.alias("host"), "path",
                     F.concat(host, "path").alias("rule")).distinct()
    return r.select(F.struct(F.char_length("rule").alias("size"),
                             F.char_length("host").alias("host_size"),
                             "action", "rule").alias("rank"),
                    _digest(F.col("host"), F.col("path")).alias("digest"),
                    F.size(F.split("host", r"\.")).alias("labels"),
                    F.char_length("path").alias("length"))


def _digest(host: Column, path: Column) -> Column:
    return F.sha2(F.concat_ws("\n", host, path), 256)


def judge_urls(pages: DataFrame, rules: DataFrame, *, url_col: str = "url",
               id_col: str = "page_id", default: str = "allow",
               max_broadcast_rules: int = 200_000) -> DataFrame:
    """One row per page: id, host, path, rule (null: none), verdict."""
    r = rule_table(rules)
    sizes = r.agg(F.collect_set("labels").alias("labels"),      # at most a host's labels and
                  F.collect_set("length").alias("lengths"),     # a path's lengths: a few
                  F.count(F.lit(1)).alias("n")).first()
    few = sizes["n"] <= max_broadcast_rules
    r = F.broadcast(r) if few else r
    p = pages.select(F.col(id_col).alias("id"), host_of(F.col(url_col)).alias("host"),
                     path_of(F.col(url_col)).alias("path"))
    urls = p.where(F.col("host") != "").select("host", "path").distinct()
    parts = urls.withColumn("names", F.split("host", r"\."))
    labels = F.array(*[F.lit(n) for n in sorted(sizes["labels"])]).cast("array<int>")
    lengths = F.array(*[F.lit(n) for n in sorted(sizes["lengths"])]).cast("array<int>")
    suffixes = parts.withColumn("n", F.explode(F.filter(
        labels, lambda n: n <= F.size("names")))).withColumn(
        "suffix", F.array_join(F.slice("names", F.size("names") - F.col("n") + 1,
                                       F.col("n")), "."))
    expr = suffixes.withColumn("m", F.explode(F.filter(
        lengths, lambda m: m <= F.char_length("path")))).select(
        "host", "path", _digest(F.col("suffix"), F.expr("substring(path, 1, m)")).alias("d"))
    hit = expr.join(r, (F.substring("d", 1, SHORT) == F.substring("digest", 1, SHORT))
                    & (F.col("d") == F.col("digest")))
    won = hit.groupBy("host", "path").agg(F.max("rank").alias("rank"))
    # a table of its own, so that the pages of one hot url can be split in the join
    found = materialize(won.select("host", "path", "rank.rule", "rank.action"), "url-rules")
    judged = p.where(F.col("host") != "").join(found, ["host", "path"], "left")
    bare = p.where(F.col("host") == "").select(
        "*", F.lit(None).cast("string").alias("rule"), F.lit(None).cast("string").alias("action"))
    return judged.unionByName(bare).select(
        "id", "host", "path", "rule", F.coalesce("action", F.lit(default)).alias("verdict"))
