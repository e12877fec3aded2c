"""Slowest stages of a Spark event log (the UI stays off; read the log).

    BENCH_EVENT_LOG_DIR=$(mktemp -d /tmp/run-XXXXXX) python bench.py unified_area_year
    python tools/stages.py $BENCH_EVENT_LOG_DIR [top]
"""

from __future__ import annotations

import glob
import json
import os
import sys


def main() -> None:
    folder = sys.argv[1]
    top = int(sys.argv[2]) if len(sys.argv) > 2 else 15
    logs = sorted(glob.glob(os.path.join(folder, "*")), key=os.path.getmtime)
    if not logs:
        sys.exit(f"no event log in {folder}")
    latest = logs[-1]
    # Spark 4 writes rolling logs: a folder of events_N_* files
    files = sorted(glob.glob(os.path.join(latest, "events_*"))) if os.path.isdir(latest) else [latest]
    stages, tasks = {}, {}
    for path in files:
        if path.endswith(".zstd"):
            import zstandard
            with open(path, "rb") as f:
                text = zstandard.ZstdDecompressor().stream_reader(f).read().decode()
        else:
            with open(path) as f:
                text = f.read()
        lines = text.splitlines()
        for line in lines:
                ev = json.loads(line)
                kind = ev.get("Event")
                if kind == "SparkListenerStageCompleted":
                    info = ev["Stage Info"]
                    start, end = info.get("Submission Time"), info.get("Completion Time")
                    if start and end:
                        stages[info["Stage ID"]] = (end - start, info["Stage Name"], info["Number of Tasks"])
                elif kind == "SparkListenerTaskEnd":
                    m = ev.get("Task Metrics") or {}
                    sid = ev["Stage ID"]
                    shuffle_w = (m.get("Shuffle Write Metrics") or {}).get("Shuffle Bytes Written", 0)
                    spill = m.get("Disk Bytes Spilled", 0)
                    acc = tasks.setdefault(sid, [0, 0, 0])
                    acc[0] = max(acc[0], ev["Task Info"]["Finish Time"] - ev["Task Info"]["Launch Time"])
                    acc[1] += shuffle_w
                    acc[2] += spill
    print(f"{'stage':>6} {'ms':>7} {'tasks':>5} {'max task ms':>11} {'shuffle MB':>10} {'spill MB':>8}  name")
    for sid, (ms, name, n) in sorted(stages.items(), key=lambda kv: -kv[1][0])[:top]:
        mx, sw, sp = tasks.get(sid, [0, 0, 0])
        print(f"{sid:>6} {ms:>7} {n:>5} {mx:>11} {sw / 1e6:>10.2f} {sp / 1e6:>8.2f}  {name[:60]}")


if __name__ == "__main__":
    main()
