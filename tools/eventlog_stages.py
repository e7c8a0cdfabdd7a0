"""Stage timings from a Spark event log folder (as written by bench.py with BENCH_EVENT_LOG_DIR).

usage: python tools/eventlog_stages.py <event-log-dir> [top]
Reads rolling (eventlog_v2_*) or single-file logs, plain or zstd-compressed.
"""

from __future__ import annotations

import glob
import io
import json
import os
import sys


def _lines(path: str):
    if path.endswith(".zstd"):
        import zstandard
        with open(path, "rb") as fh:
            yield from io.TextIOWrapper(zstandard.ZstdDecompressor().stream_reader(fh), encoding="utf-8")
    else:
        with open(path, encoding="utf-8") as fh:
            yield from fh


def stages(log_dir: str) -> list[tuple]:
    files = sorted(glob.glob(os.path.join(log_dir, "**", "events_*"), recursive=True)) or \
        sorted(f for f in glob.glob(os.path.join(log_dir, "*")) if os.path.isfile(f))
    out = []
    for f in files:
        for line in _lines(f):
            e = json.loads(line)
            if e.get("Event") == "SparkListenerStageCompleted":
                s = e["Stage Info"]
                ms = (s.get("Completion Time") or 0) - (s.get("Submission Time") or 0)
                out.append((s["Stage ID"], s["Stage Name"].split(" at ")[0][:50], s["Number of Tasks"], ms))
    return out


if __name__ == "__main__":
    rows = stages(sys.argv[1])
    top = int(sys.argv[2]) if len(sys.argv) > 2 else 10
    print(f"{len(rows)} stages, {sum(r[3] for r in rows)} ms in total")
    for sid, name, tasks, ms in sorted(rows, key=lambda r: -r[3])[:top]:
        print(f"stage {sid:>4}  {ms:>7} ms  {tasks:>5} tasks  {name}")
