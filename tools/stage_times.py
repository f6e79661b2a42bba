"""Per-stage times from a Spark event log (written by bench.py when
BENCH_EVENT_LOG_DIR is set).  Usage: python tools/stage_times.py LOG_FILE [top_n]"""

from __future__ import annotations

import json
import os
import sys


def _lines(path: str):
    """A plain log file, or a rolling event-log directory (events_* files)."""
    if os.path.isdir(path):
        files = sorted((f for f in os.listdir(path) if f.startswith("events_")),
                       key=lambda f: int(f.split("_")[1]))
        for name in files:
            yield from _read(os.path.join(path, name))
    else:
        yield from _read(path)


def _read(path: str):
    if path.endswith(".zstd"):  # Spark's default event-log codec
        import io

        import zstandard
        with open(path, "rb") as raw:
            reader = zstandard.ZstdDecompressor().stream_reader(raw)
            yield from io.TextIOWrapper(reader, encoding="utf-8")
    else:
        with open(path) as f:
            yield from f


def main() -> None:
    path = sys.argv[1]
    top = int(sys.argv[2]) if len(sys.argv) > 2 else 15
    stages, tasks = [], {}
    for line in _lines(path):
        if line.strip():
            ev = json.loads(line)
            kind = ev.get("Event")
            if kind == "SparkListenerTaskEnd":
                sid = ev["Stage ID"]
                info = ev.get("Task Info", {})
                tasks.setdefault(sid, []).append(info.get("Finish Time", 0) - info.get("Launch Time", 0))
            elif kind == "SparkListenerStageCompleted":
                si = ev["Stage Info"]
                dur = (si.get("Completion Time") or 0) - (si.get("Submission Time") or 0)
                stages.append((dur, si["Stage ID"], si.get("Stage Name", "")[:70], si.get("Number of Tasks")))
    stages.sort(reverse=True)
    print(f"{'ms':>8} {'stage':>6} {'tasks':>6} {'max task ms':>11}  name")
    for dur, sid, name, n in stages[:top]:
        print(f"{dur:>8} {sid:>6} {n:>6} {max(tasks.get(sid, [0])):>11}  {name}")
    print(f"stages: {len(stages)}, total stage ms: {sum(s[0] for s in stages)}")


if __name__ == "__main__":
    main()
