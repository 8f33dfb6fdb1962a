"""Parquet test tables and the column mappings from them to the analytic inputs.

Every mapping is a projection/join that Catalyst pushes into the scan, so
only the named columns are read (``ReadSchema``) and filters reach the
parquet reader (``PushedFilters``).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

TABLES = ("region", "nation", "customer", "supplier", "part", "orders",
          "lineitem", "events", "documents", "embeddings", "pages",
          "benchmark", "labels", "conversations")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    if name not in TABLES:
        raise ValueError(f"unknown table {name!r}")
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def ratings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(user_id, item_id, rating): customer rates part with the line quantity."""
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    li = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey", "l_quantity")
    return (li.join(o, li.l_orderkey == o.o_orderkey)
            .select(F.col("o_custkey").alias("user_id"),
                    F.col("l_partkey").alias("item_id"),
                    F.col("l_quantity").alias("rating")))


def item_titles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(item_id, title) dimension from ``part``."""
    return table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("item_id"), F.col("p_name").alias("title"))


def vertex_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(id, name) vertex dimension from ``customer``."""
    return table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("id"), F.col("c_name").alias("name"))


def graph_edges(spark: SparkSession, sf_dir: str, with_id: bool = False) -> DataFrame:
    """Directed multigraph: customer -> (order key mod #customers); edges as
    listed, self-loops included.

    The modulus is a scalar subquery over ``customer``; Spark runs it as one
    small aggregate job and inlines the value.
    """
    n = table(spark, sf_dir, "customer").agg(F.count("*")).scalar()
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    dst = F.col("o_orderkey") % n
    keep = [F.col("o_orderkey").alias("eid")] if with_id else []
    return o.select(F.col("o_custkey").alias("src"), dst.alias("dst"), *keep)


def tag_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(ts, text) messages carrying hashtags, derived from ``events``."""
    ev = table(spark, sf_dir, "events").select("ts", "user_id", "event_type")
    return ev.select(
        "ts",
        F.concat(F.lit("user "), F.col("user_id").cast("string"),
                 F.lit(" #"), F.col("event_type")).alias("text"))
