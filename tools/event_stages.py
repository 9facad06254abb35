"""Slowest stages of a Spark event log (the UI stays off; this reads the log).

Usage:
  spark-submit / python with  spark.eventLog.enabled=true  spark.eventLog.dir=<scratch dir>
  python tools/event_stages.py <event log file or rolled-log folder> [top_n]
Handles plain, zstd-compressed and rolled (eventlog_v2_*) logs.
"""

from __future__ import annotations

import glob
import io
import json
import os
import sys


def _lines(path: str):
    files = sorted(glob.glob(os.path.join(path, "events_*"))) if os.path.isdir(path) else [path]
    for f in files:
        if f.endswith(".zstd"):
            import zstandard

            with open(f, "rb") as fh:
                yield from io.TextIOWrapper(zstandard.ZstdDecompressor().stream_reader(fh), encoding="utf-8")
        else:
            with open(f, encoding="utf-8") as fh:
                yield from fh


def main() -> None:
    path = sys.argv[1]
    top = int(sys.argv[2]) if len(sys.argv) > 2 else 15
    stages = []
    for line in _lines(path):
        e = json.loads(line)
        if e.get("Event") == "SparkListenerStageCompleted":
            si = e["Stage Info"]
            secs = (si.get("Completion Time", 0) - si.get("Submission Time", 0)) / 1000
            stages.append((secs, si["Stage ID"], si["Number of Tasks"], si["Stage Name"][:60]))
    stages.sort(reverse=True)
    print(f"stages={len(stages)} total_stage_seconds={sum(s[0] for s in stages):.1f}")
    for secs, sid, tasks, name in stages[:top]:
        print(f"{secs:8.2f}s  stage {sid:<5} tasks {tasks:<6} {name}")


if __name__ == "__main__":
    main()
