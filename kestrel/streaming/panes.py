"""Sliding tag counts of a stream from panes: add what enters a window,
subtract what leaves it.

Events are cut into panes of one slide. Each Arrow batch of a task is counted
per (pane, tag) before the shuffle, so a tag that a third of all events carry
travels as a few rows. The state is one ring per tag: the counts of the panes
that a window still needs and the running total. When the watermark passes the
end of a window, the pane that enters is added, the pane that leaves is
subtracted, and the total is the window's count. A window is emitted once, when
it is complete, and all of its tags in the same micro-batch; so the ranking of
a window needs the rows of that batch and no earlier output.

An event whose pane ended before the watermark is late: it is counted nowhere
and goes to the table of late counts (per pane and tag), so that windows and
late counts together hold every event.

Needs Spark's RocksDB state store (``STATE_STORE``), as any
``transformWithState`` does. Windows that are open when a finite stream ends
are not emitted; a last message with a late enough time closes them (see
``kestrel.streaming.replay``).
"""

from __future__ import annotations

from collections import Counter

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import StatefulProcessor

from kestrel.functions.text import hashtags
from kestrel.streaming.tags import SLIDE, TOP, WINDOW, _as_instant, _seconds, top_tags

STATE_STORE = ("spark.sql.streaming.stateStore.providerClass",
               "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
ROWS = "start long, tag string, cnt long, kind string"


class PaneRing(StatefulProcessor):
    """Per tag: the panes of the open windows and their running total. Times
    are microseconds; ``next_end`` is the end of the next window to emit."""

    def __init__(self, length: int, slide: int):
        self.length, self.slide = length, slide

    def init(self, handle) -> None:
        self.handle = handle
        self.ring = handle.getValueState(
            "ring", "next_end long, total long, panes array<long>, counts array<long>")

    def _load(self):
        got = self.ring.get() if self.ring.exists() else None
        if got is None:
            return None, 0, Counter()
        return got[0], got[1], Counter(dict(zip(got[2], got[3], strict=True)))

    def _store(self, before, next_end, total, panes) -> None:
        if before is not None and before != next_end:
            self.handle.deleteTimer(before // 1000)
        if not panes:
            self.ring.clear()
            return
        self.ring.update((next_end, total, list(panes), list(panes.values())))
        if before != next_end:
            self.handle.registerTimer(next_end // 1000)

    def _rows(self, key, starts, counts, kind):
        return pd.DataFrame({"start": starts, "tag": key[0], "cnt": counts, "kind": kind})

    def handleInputRows(self, key, rows, timerValues):
        watermark = timerValues.getCurrentWatermarkInMs() * 1000
        before, total, panes = self._load()
        late, first = Counter(), before
        for part in rows:
            for pane, n in zip(part["pane"].tolist(), part["cnt"].tolist(), strict=True):
                end = pane + self.slide
                if end <= watermark:
                    late[pane] += n
                else:
                    panes[pane] += n
                    first = end if first is None else min(first, end)
        if panes:
            self._store(before, first, total, panes)
        if late:
            yield self._rows(key, list(late), list(late.values()), "late")

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
        watermark = timerValues.getCurrentWatermarkInMs() * 1000
        before, total, panes = self._load()
        if before is None:
            return
        end, starts, counts = before, [], []
        while panes and end < watermark:
            total += panes.get(end - self.slide, 0)                 # enters
            total -= panes.pop(end - self.slide - self.length, 0)   # leaves
            if total:
                starts.append(end - self.length)
                counts.append(total)
                end += self.slide
            elif panes:                          # nothing until the next pane
                end = min(panes) + self.slide
        if panes and before == end:              # exactly at the watermark: again later
            self.handle.deleteTimer(before // 1000)
            before = None
        self._store(before, end, total, panes)
        if starts:
            yield self._rows(key, starts, counts, "window")

    def close(self) -> None:
        pass


def _pane_counts(batches):
    for part in batches:
        yield part.groupby(["pane", "tag"], as_index=False, sort=False)["n"].sum().rename(
            columns={"n": "cnt"})


def window_stream(stream: DataFrame, text: str = "text", ts: str = "ts", length: str = WINDOW,
                  slide: str = SLIDE, *, watermark: str) -> DataFrame:
    """(start, tag, cnt, kind): complete windows (``window``, by their start)
    and late counts (``late``, by their pane) as a stream; times in
    microseconds."""
    L, S = _seconds(length) * 1_000_000, _seconds(slide) * 1_000_000
    if L % S:
        raise ValueError("a window must be a whole number of slides")
    # the watermark first: messages without tags move it too
    timed = stream.withColumn(ts, _as_instant(ts)).withWatermark(ts, watermark)
    us = F.unix_micros(F.col(ts))
    tags = hashtags(timed, text, ts).select((us - F.pmod(us, F.lit(S))).alias("pane"), "tag",
                                            F.lit(1).cast("long").alias("n"))
    panes = tags.mapInPandas(_pane_counts, "pane long, tag string, cnt long")
    return panes.groupBy("tag").transformWithStateInPandas(
        PaneRing(L, S), ROWS, "append", "eventTime")


def run_window_stream(stream: DataFrame, out_dir: str, checkpoint: str, text: str = "text",
                      ts: str = "ts", length: str = WINDOW, slide: str = SLIDE, *,
                      watermark: str, trigger: dict | None = None, top_dir: str | None = None,
                      top: int = TOP):
    """Start the query; returns the ``StreamingQuery``. Each micro-batch writes
    its rows to its own folder of ``out_dir`` and, with ``top_dir``, the ``top``
    tags of the windows that it completed; a replayed batch overwrites both."""
    spark = stream.sparkSession
    if spark.conf.get(STATE_STORE[0], None) != STATE_STORE[1]:
        raise ValueError(f"set {STATE_STORE[0]} to {STATE_STORE[1]}")
    rows = window_stream(stream, text, ts, length, slide, watermark=watermark)

    def write_batch(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").partitionBy("kind").parquet(f"{out_dir}/batch={batch_id}")
        if top_dir:
            ranked = top_tags(batch_windows(batch.sparkSession, out_dir, batch_id, length), top)
            ranked.write.mode("overwrite").parquet(f"{top_dir}/batch={batch_id}")

    return (rows.writeStream.outputMode("append").option("checkpointLocation", checkpoint)
            .foreachBatch(write_batch)
            .trigger(**(trigger or {"processingTime": "1 second"})).start())


def _windows(rows: DataFrame, length: str) -> DataFrame:
    us = F.lit(_seconds(length) * 1_000_000)
    return rows.where("kind = 'window'").select(
        F.timestamp_micros("start").alias("window_start"),
        F.timestamp_micros(F.col("start") + us).alias("window_end"), "tag", "cnt")


def batch_windows(spark: SparkSession, out_dir: str, batch_id: int,
                  length: str = WINDOW) -> DataFrame:
    """The windows that one micro-batch completed; reads its own folder only."""
    return _windows(spark.read.schema(ROWS).parquet(f"{out_dir}/batch={batch_id}"), length)


def read_windows(spark: SparkSession, out_dir: str, length: str = WINDOW) -> DataFrame:
    """(window_start, window_end, tag, cnt) of all complete windows."""
    return _windows(spark.read.schema(ROWS + ", batch long").parquet(out_dir), length)


def read_late(spark: SparkSession, out_dir: str) -> DataFrame:
    """(pane_start, tag, cnt, batch): the late counts and when they came."""
    rows = spark.read.schema(ROWS + ", batch long").parquet(out_dir)
    return rows.where("kind = 'late'").select(F.timestamp_micros("start").alias("pane_start"),
                                              "tag", "cnt", "batch")


def read_rankings(spark: SparkSession, top_dir: str) -> DataFrame:
    """The rankings of all windows; each was written once."""
    schema = "window_start timestamp, window_end timestamp, tag string, cnt long"
    return spark.read.schema(schema).parquet(top_dir).drop("batch")
