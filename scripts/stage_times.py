"""Summarize stage times from a Spark event log (written with spark.eventLog.enabled).

Usage: python scripts/stage_times.py <event log file or folder> [top_n]
Prints the slowest stages: duration, task count, shuffle read/write bytes and the stage name.
"""

from __future__ import annotations

import glob
import json
import os
import sys


def _open(f: str):
    """Text lines of an event log file; Spark 4 compresses them with zstd by default."""
    import io
    if f.endswith(".zstd"):
        import zstandard
        raw = zstandard.ZstdDecompressor().stream_reader(open(f, "rb"), read_across_frames=True)
        return io.TextIOWrapper(raw, encoding="utf-8")
    return open(f, encoding="utf-8")


def stages(path: str):
    files = [path] if os.path.isfile(path) else sorted(
        f for f in glob.glob(os.path.join(path, "**", "*"), recursive=True) if os.path.isfile(f))
    for f in files:
        if os.path.basename(f).startswith((".", "appstatus")):
            continue
        with _open(f) as fh:
            for line in fh:
                try:
                    ev = json.loads(line)
                except json.JSONDecodeError:
                    continue
                if ev.get("Event") != "SparkListenerStageCompleted":
                    continue
                info = ev["Stage Info"]
                acc = {a.get("Name"): a.get("Value") for a in info.get("Accumulables", [])}
                yield {
                    "ms": (info.get("Completion Time", 0) or 0) - (info.get("Submission Time", 0) or 0),
                    "tasks": info.get("Number of Tasks"),
                    "shuffle_read": acc.get("internal.metrics.shuffle.read.remoteBytesRead", 0) or 0
                    + (acc.get("internal.metrics.shuffle.read.localBytesRead", 0) or 0),
                    "shuffle_write": acc.get("internal.metrics.shuffle.write.bytesWritten", 0) or 0,
                    "name": info.get("Stage Name", "")[:80],
                }


def main() -> None:
    path = sys.argv[1]
    top = int(sys.argv[2]) if len(sys.argv) > 2 else 20
    rows = sorted(stages(path), key=lambda r: -r["ms"])[:top]
    for r in rows:
        print(f"{r['ms']:8d} ms  tasks={r['tasks']:<5} shuffle_r={r['shuffle_read']:<10} "
              f"shuffle_w={r['shuffle_write']:<10} {r['name']}")


if __name__ == "__main__":
    main()
