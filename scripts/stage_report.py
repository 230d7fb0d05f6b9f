"""Per-stage timings from a Spark event log: duration, task count, median and
slowest task. A slowest task far above the median marks skew.

Usage: python scripts/stage_report.py <event-log file or eventlog_v2_* folder> [top_n]
Write a log with BENCH_EVENT_LOG_DIR=<scratch folder> python bench.py.
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
        with open(f, "rb") as fh:
            if f.endswith(".zstd"):
                import zstandard

                stream = io.TextIOWrapper(zstandard.ZstdDecompressor().stream_reader(fh), encoding="utf-8")
            else:
                stream = io.TextIOWrapper(fh, encoding="utf-8")
            yield from stream


def main() -> None:
    path = sys.argv[1]
    top = int(sys.argv[2]) if len(sys.argv) > 2 else 20
    stages, tasks = {}, {}
    for line in _lines(path):
        e = json.loads(line)
        kind = e["Event"]
        if kind == "SparkListenerStageCompleted":
            info = e["Stage Info"]
            stages[info["Stage ID"]] = (info["Stage Name"], info["Number of Tasks"],
                                        info.get("Completion Time", 0) - info.get("Submission Time", 0))
        elif kind == "SparkListenerTaskEnd":
            t = e["Task Info"]
            tasks.setdefault(e["Stage ID"], []).append(t["Finish Time"] - t["Launch Time"])
    rows = []
    for sid, (name, n, dur) in stages.items():
        times = sorted(tasks.get(sid, [0]))
        rows.append((dur, sid, n, times[len(times) // 2], times[-1], name[:60]))
    print(f"{'stage':>6} {'ms':>7} {'tasks':>6} {'median':>7} {'max':>7}  name")
    for dur, sid, n, med, mx, name in sorted(rows, reverse=True)[:top]:
        print(f"{sid:>6} {dur:>7} {n:>6} {med:>7} {mx:>7}  {name}")


if __name__ == "__main__":
    main()
