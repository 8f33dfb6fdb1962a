"""Shared fixtures of the operator tests: edge rows and brute-force helpers."""

import random

from pyspark.sql import functions as F

CLASH = ["id", "row", "key", "bucket", "size", "block", "ids", "blob", "c", "code", "h",
         "vector", "part", "n"]
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def prose(rng, n, words=("the", "of", "to", "and", "sea", "stone", "river", "light", "cold",
                         "wind", "far", "north", "ship", "hill", "green")):
    return " ".join(rng.choice(words) + str(rng.randrange(40)) for _ in range(n))


def documents(spark, clash=True):
    """Edge rows: null id, text, language and source, empty and blank texts,
    copies, near copies, shared passages, repeated rows, one long text."""
    rng = random.Random(3)
    base, passage = prose(rng, 120), prose(rng, 30)
    near = base.split()
    near[50] = "changed"
    rows = [(1, base, "en", "a"), (2, " ".join(near), "en", "a"), (3, base, "en", None),
            (4, None, "en", "b"), (5, "", "en", "b"), (6, " \t\n ", None, "b"),
            (7, "one two three", "en", "a"), (8, "One TWO three", "en", "a"),
            (9, prose(rng, 40) + " " + passage + " " + prose(rng, 10), "en", "c"),
            (10, passage + "\n" + prose(rng, 5), "en", "c"),
            (11, prose(rng, 6000), "en", "a"), (None, base, "en", "a"),
            (None, None, None, None), (12, "ünï 漢字 🙂 naïve\u00a0x  y   z \n\n q ", "de", "a"),
            (13, "same", "en", "a"), (13, "same", "en", "a"), (14, "1234 5678 !!", "en", "b"),
            (15, "a" * 3000, "en", "b"), (16, prose(rng, 12), "en", "z")]
    d = spark.createDataFrame([(*r, len(r[1]) if r[1] else None) for r in rows], SCHEMA)
    for name in CLASH if clash else ():
        d = d.withColumn(name, F.lit("x"))
    return d


def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def plain(df):
    return [(r.doc_id, r.text or "") for r in df.select("doc_id", "text").collect()]
