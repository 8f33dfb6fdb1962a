"""Summarise stage times from a Spark event log (no UI needed).

Usage: python tools/stage_times.py <event-log-file-or-dir> [top]

Prints the slowest stages with their task count, summed task time, shuffle
read/write bytes and spill, and the job's description where Spark set one.
"""

from __future__ import annotations

import json
import os
import sys


def _files(path):
    """Event files under ``path``: Spark 4 writes rolling logs in
    ``eventlog_v2_<app>/events_<n>_<app>[.zstd]``."""
    if not os.path.isdir(path):
        return [path]
    out = []
    for root, _, names in os.walk(path):
        for f in sorted(names):
            if f.startswith("events_") or (root == path and not f.startswith((".", "appstatus"))):
                out.append(os.path.join(root, f))
    return out


def _lines(f):
    if f.endswith(".zstd"):
        import io

        import zstandard
        with open(f, "rb") as raw:
            reader = zstandard.ZstdDecompressor().stream_reader(raw)
            yield from io.TextIOWrapper(reader, encoding="utf-8")
    else:
        with open(f) as fh:
            yield from fh


def main():
    path = sys.argv[1]
    top = int(sys.argv[2]) if len(sys.argv) > 2 else 20
    stages = []
    for f in _files(path):
        for line in _lines(f):
            if line.strip():
                ev = json.loads(line)
                if ev.get("Event") != "SparkListenerStageCompleted":
                    continue
                info = ev["Stage Info"]
                dur = (info.get("Completion Time", 0) - info.get("Submission Time", 0)) / 1000
                acc = {a.get("Name"): a.get("Value") for a in info.get("Accumulables", [])}
                stages.append((dur, info["Stage ID"], info.get("Number of Tasks"),
                               acc.get("internal.metrics.executorRunTime", 0) / 1000,
                               acc.get("internal.metrics.shuffle.read.remoteBytesRead", 0)
                               + acc.get("internal.metrics.shuffle.read.localBytesRead", 0),
                               acc.get("internal.metrics.shuffle.write.bytesWritten", 0),
                               acc.get("internal.metrics.diskBytesSpilled", 0),
                               info.get("Stage Name", "")[:60]))
    stages.sort(reverse=True)
    print(f"{'sec':>7} {'stage':>6} {'tasks':>6} {'task-s':>7} {'shuf-in':>10} {'shuf-out':>10} {'spill':>8}  name")
    for d, sid, n, run, rin, wout, spill, name in stages[:top]:
        print(f"{d:7.2f} {sid:6d} {n:6d} {run:7.2f} {rin:10d} {wout:10d} {spill:8d}  {name}")
    print(f"{len(stages)} stages, {sum(s[0] for s in stages):.1f} s wall in stages")


if __name__ == "__main__":
    main()
