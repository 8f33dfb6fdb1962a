"""Replay of a table as a stream: files in the order of arrival, a limited
number per micro-batch.

The table is cut into time slices of about equal size (approximate quantiles
of the arrival time) and written slice by slice, so the files' ages follow the
order of arrival, by which Spark's file source takes them. Two last files hold a
message without text at a time that the caller chooses: the first moves the
watermark past every open window, the second brings the micro-batch that sees
it, with or without micro-batches that have no data.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def write_replay(messages: DataFrame, path: str, files: int, *, ts: str = "ts",
                 text: str = "text", arrival: str | None = None,
                 closes_after: str = "1 day") -> DataFrame:
    """Write ``messages`` (columns ``ts`` and ``text``) in ``files`` slices of
    ``arrival`` (default: ``ts``), each as one appended file or more, then
    twice the closing message ``closes_after`` the largest ``ts``. Messages without an
    arrival time come first. Returns the messages as written, for their schema."""
    arrival = arrival or ts
    shares = [k / files for k in range(1, files)]
    row = messages.agg(F.percentile_approx(F.col(arrival), F.array(*map(F.lit, shares)),
                                           10_000).alias("cuts"),
                       F.max(ts).alias("last")).first() if shares else messages.agg(
        F.max(ts).alias("last")).first()
    cuts = sorted(set(row["cuts"] or [])) if shares else []
    out = messages.select(ts, text)
    edges = [None, *cuts, None]
    for low, high in zip(edges, edges[1:]):
        part = F.lit(True)
        if low is not None:
            part = part & (F.col(arrival) > F.lit(low))
        if high is not None:
            inside = F.col(arrival) <= F.lit(high)
            part = part & (inside if low is not None else inside | F.col(arrival).isNull())
        elif low is None:
            part = F.lit(True)
        messages.where(part).select(ts, text).coalesce(1).write.mode("append").parquet(path)
    close = messages.agg((F.max(ts) + F.expr(f"INTERVAL {closes_after}")).cast(
        dict(messages.dtypes)[ts]).alias(ts), F.lit("").alias(text)).where(F.col(ts).isNotNull())
    for _ in range(2):
        close.coalesce(1).write.mode("append").parquet(path)
    return out


def read_replay(spark: SparkSession, path: str, schema, files_per_batch: int = 1) -> DataFrame:
    """The replayed files as a stream, ``files_per_batch`` per micro-batch."""
    return (spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch)
            .parquet(path))
