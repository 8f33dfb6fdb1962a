"""Text columns: word tokens, word counts, hashtags and formatted readings.

All of it is built-in column expressions (split/explode/lower/format_string),
so it stays inside whole-stage codegen; documents are tokenised whole, and
the count is a partial + final aggregate (hot words combine map-side).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Fixed values from the reference programs: the word-split pattern (a Java
# regex: one or more non-word characters) and the hashtag prefix.
WORD_SPLIT = r"\W+"
TAG_PREFIX = "#"


def words(df: DataFrame, text: str = "text", pattern: str = WORD_SPLIT,
          lower: bool = True, empty_tokens: str = "drop") -> DataFrame:
    """One row per token of ``text`` -> column ``word``.

    ``empty_tokens='drop'`` drops every empty token; ``'java'`` keeps what
    Java's ``String.split`` keeps: a leading empty token (text starting with
    a separator) and the single empty token of an empty line (D2).
    """
    parts = F.split(F.col(text), pattern)
    if empty_tokens == "drop":
        # filter after explode: stays in whole-stage codegen (a lambda
        # filter over the token array would be interpreted)
        out = df.select(F.explode(parts).alias("word")).where(F.col("word") != F.lit(""))
        return out.select(F.lower("word").alias("word")) if lower else out
    if empty_tokens == "java":
        # Java drops trailing empty tokens only, and "" splits to [""]
        filled = F.array_position(F.transform(F.reverse(parts), lambda t: t != ""), True)
        kept = F.when(filled > 0, F.slice(parts, 1, F.size(parts) - filled.cast("int") + 1))
        kept = F.when(F.col(text) == "", parts).otherwise(kept)
        out = df.select(F.explode(kept).alias("word"))
        return out.select((F.lower("word") if lower else F.col("word")).alias("word"))
    raise ValueError("empty_tokens must be 'drop' or 'java'")


def word_count(df: DataFrame, text: str = "text", **kw) -> DataFrame:
    """A2: (word, cnt) over the whole text column."""
    return words(df, text, **kw).groupBy("word").agg(F.count("*").alias("cnt"))


def hashtags(df: DataFrame, text: str = "text", ts: str | None = "ts",
             sep: str = " ") -> DataFrame:
    """Tokens split on ``sep`` that start with ``#`` -> column ``tag``.

    Stateless, so the same function serves a batch DataFrame and a stream.
    """
    keep = [F.col(ts)] if ts else []
    toks = F.explode(F.split(F.col(text), "\\Q" + sep + "\\E")).alias("tag")
    return df.select(*keep, toks).where(F.startswith(F.col("tag"), F.lit(TAG_PREFIX)))


def fahrenheit_from_tenths(c: str | Column) -> Column:
    """P5: tenths of a degree Celsius -> Fahrenheit, ``v * 0.1 * (9/5) + 32``."""
    v = F.col(c) if isinstance(c, str) else c
    return v.cast("double") * F.lit(0.1) * (F.lit(9.0) / F.lit(5.0)) + F.lit(32.0)


def format_reading(c: str | Column, fmt: str = "%.2f F") -> Column:
    """printf-style formatting (``%.2f F``)."""
    v = F.col(c) if isinstance(c, str) else c
    return F.format_string(fmt, v)
