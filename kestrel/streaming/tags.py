"""Trending tags over sliding event-time windows, as a batch job and as a
Structured Streaming query sharing the same tokenising transform.

Batch plan: count per (10 s pane, tag) first — a partial + final aggregate
that collapses every event into at most one row per pane and tag — then
expand each pane row to the ``length/slide`` windows that contain it and
sum. That is the inverse-free form of the reference's add/subtract window
update, and it expands distinct (pane, tag) rows instead of raw events.

Stream plan: the stateless tokenising step, a watermark on event time, and
``groupBy(window, tag).count()`` in the state store. Output goes through
``foreachBatch`` in update mode: each micro-batch writes its changed window
rows to ``<out>/batch=<id>`` (overwrite, so a replayed batch rewrites the
same folder) and the current table is the last written count per window and
tag. State is bounded by the watermark; results survive restarts through
the checkpoint location.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from kestrel.functions.text import hashtags

# Fixed values from the reference program: 300 s windows sliding every 10 s,
# top 10 printed per interval.
WINDOW = "300 seconds"
SLIDE = "10 seconds"
TOP = 10


def _seconds(spec: str) -> int:
    n, unit = spec.split()
    mult = {"second": 1, "seconds": 1, "minute": 60, "minutes": 60, "hour": 3600,
            "hours": 3600}[unit]
    return int(n) * mult


def _as_instant(ts: str) -> F.Column:
    # event time may be timestamp_ntz; window/watermark want an instant
    return F.col(ts).cast("timestamp")


def window_tag_counts(messages: DataFrame, text: str = "text", ts: str = "ts",
                      length: str = WINDOW, slide: str = SLIDE) -> DataFrame:
    """T3 (batch): (window_start, window_end, tag, cnt) for every window that
    holds at least one tag; windows are [start, start + length)."""
    L, S = _seconds(length), _seconds(slide)
    tags = hashtags(messages, text, ts)
    ntz = dict(messages.dtypes)[ts] == "timestamp_ntz"
    if L % S:
        w = F.window(_as_instant(ts), length, slide)
        out = tags.groupBy(w.alias("w"), "tag").agg(F.count("*").alias("cnt"))
        typ = "timestamp_ntz" if ntz else "timestamp"
        start, end = F.col("w.start").cast(typ), F.col("w.end").cast(typ)
    else:
        us = _micros(F.col(ts), ntz)
        pane = us - F.pmod(us, F.lit(S * 1_000_000))
        panes = tags.groupBy(pane.alias("_p"), "tag").agg(F.count("*").alias("_c"))
        # the next step multiplies rows by L/S: spread the (small) pane rows
        # over all shuffle partitions (a repartition by number is never
        # coalesced by AQE) instead of letting their size pick a few tasks
        n = int(messages.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        panes = panes.repartition(n)
        k = F.explode(F.sequence(F.lit(0), F.lit(L // S - 1))).alias("_k")
        spread = panes.select("tag", "_c", "_p", k).select(
            "tag", "_c", (F.col("_p") - F.col("_k") * F.lit(S * 1_000_000)).alias("_s"))
        out = spread.groupBy("_s", "tag").agg(F.sum("_c").alias("cnt"))
        start = _from_micros(F.col("_s"), ntz)
        end = _from_micros(F.col("_s") + F.lit(L * 1_000_000), ntz)
    return out.select(start.alias("window_start"), end.alias("window_end"),
                      "tag", F.col("cnt").cast("long").alias("cnt"))


def _epoch_ntz() -> F.Column:
    return F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")


def _micros(c: F.Column, ntz: bool) -> F.Column:
    # wall-clock micros for timestamp_ntz (no time zone involved), epoch
    # micros for an instant
    if ntz:
        return F.timestamp_diff("MICROSECOND", _epoch_ntz(), c)
    return F.unix_micros(c)


def _from_micros(us: F.Column, ntz: bool) -> F.Column:
    if ntz:
        return F.timestamp_add("MICROSECOND", us, _epoch_ntz())
    return F.timestamp_micros(us)


def top_tags(counts: DataFrame, k: int = TOP) -> DataFrame:
    """The k largest tags of every window (ties: by tag)."""
    rank = F.row_number().over(
        Window.partitionBy("window_start").orderBy(F.desc("cnt"), F.asc("tag")))
    return counts.withColumn("_r", rank).where(F.col("_r") <= k).drop("_r")


def stream_window_counts(stream: DataFrame, text: str = "text", ts: str = "ts",
                         length: str = WINDOW, slide: str = SLIDE, *,
                         watermark: str) -> DataFrame:
    """T2+T3 (stream): the windowed count as a streaming DataFrame. Events
    later than ``watermark`` are dropped, so the caller must choose it."""
    tags = hashtags(stream, text, ts).select(_as_instant(ts).alias("_t"), "tag")
    return (tags.withWatermark("_t", watermark)
            .groupBy(F.window("_t", length, slide).alias("w"), "tag")
            .agg(F.count("*").alias("cnt")))


def run_trending_stream(stream: DataFrame, out_dir: str, checkpoint: str,
                        text: str = "text", ts: str = "ts", length: str = WINDOW,
                        slide: str = SLIDE, *, watermark: str,
                        trigger: dict | None = None, top_dir: str | None = None,
                        top: int = TOP):
    """Start the streaming query; returns the ``StreamingQuery``.

    ``trigger`` defaults to ``{"processingTime": "1 second"}`` (the
    reference's batch interval); tests pass ``{"availableNow": True}``.
    When ``top_dir`` is set, each micro-batch also writes the ``top`` largest
    tags of every window that it changed.
    """
    counts = stream_window_counts(stream, text, ts, length, slide, watermark=watermark)
    typ = "timestamp_ntz" if dict(stream.dtypes)[ts] == "timestamp_ntz" else "timestamp"

    def write_batch(batch: DataFrame, batch_id: int) -> None:
        # back to the input's timestamp type inside the query's own session
        rows = batch.select(F.col("w.start").cast(typ).alias("window_start"),
                            F.col("w.end").cast(typ).alias("window_end"), "tag",
                            F.col("cnt").cast("long").alias("cnt"),
                            F.lit(batch_id).cast("long").alias("batch_id"))
        path = f"{out_dir}/batch={batch_id}"
        rows.write.mode("overwrite").parquet(path)
        if top_dir:
            # from the folders written: the micro-batch is not run again, and
            # tags that this batch did not change keep their earlier counts
            spark = batch.sparkSession
            changed = spark.read.schema(rows.schema).parquet(path).select("window_start").distinct()
            table = read_trending_table(spark, out_dir, rows.schema)
            ranked = top_tags(table.join(changed, "window_start", "left_semi"), top)
            ranked.withColumn("batch_id", F.lit(batch_id).cast("long")).write.mode(
                "overwrite").parquet(f"{top_dir}/batch={batch_id}")

    w = (counts.writeStream.outputMode("update")
         .option("checkpointLocation", checkpoint)
         .foreachBatch(write_batch)
         .trigger(**(trigger or {"processingTime": "1 second"})))
    return w.start()


def read_trending_table(spark: SparkSession, out_dir: str, schema=None) -> DataFrame:
    """The current windowed counts: the latest written row per (window, tag)."""
    reader = spark.read if schema is None else spark.read.schema(schema)
    return reader.parquet(out_dir).groupBy("window_start", "window_end", "tag").agg(
        F.max_by("cnt", "batch_id").alias("cnt"))


def read_top_table(spark: SparkSession, top_dir: str) -> DataFrame:
    """The current ranking of every window: the last one written."""
    raw = spark.read.parquet(top_dir)
    last = raw.groupBy("window_start").agg(F.max("batch_id").alias("batch_id"))
    return raw.join(last, ["window_start", "batch_id"], "left_semi").select(
        "window_start", "window_end", "tag", "cnt")
