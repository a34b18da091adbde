"""Summarise a Spark event log: jobs, stages, task time, heaviest stages.

    python scripts/profile_events.py EVENT_LOG_DIR [--last-ms N]

Write the log with ``spark.eventLog.enabled=true`` and
``spark.eventLog.dir=<a scratch folder>``. ``--last-ms`` keeps only the jobs
submitted in the final N milliseconds of the log (one step of a run).
"""

from __future__ import annotations

import argparse
import collections
import glob
import json
import os


def read_events(path: str) -> list[dict]:
    files = sorted(glob.glob(os.path.join(path, "**", "events_*"), recursive=True)) or [path]
    events = []
    for name in files:
        with open(name, "rb") as fh:
            raw = fh.read()
        if name.endswith(".zstd"):
            import zstandard

            raw = zstandard.ZstdDecompressor().stream_reader(raw).read()
        events += [json.loads(line) for line in raw.decode().splitlines() if line.strip()]
    return events


def main() -> None:
    ap = argparse.ArgumentParser()
    ap.add_argument("log")
    ap.add_argument("--last-ms", type=int, default=None)
    ap.add_argument("--top", type=int, default=10)
    args = ap.parse_args()

    events = read_events(args.log)
    ends = [e["Completion Time"] for e in events if e["Event"] == "SparkListenerJobEnd"]
    start = max(ends) - args.last_ms if args.last_ms and ends else 0
    jobs = {e["Job ID"]: e for e in events
            if e["Event"] == "SparkListenerJobStart" and e["Submission Time"] >= start}
    stage_ids = {s for e in jobs.values() for s in e["Stage IDs"]}
    per_stage = collections.defaultdict(lambda: {"run": 0, "cpu": 0, "gc": 0, "tasks": 0,
                                                 "records": 0})
    names = {}
    for e in events:
        if e["Event"] == "SparkListenerTaskEnd" and e["Stage ID"] in stage_ids:
            m = e.get("Task Metrics") or {}
            s = per_stage[e["Stage ID"]]
            s["run"] += m.get("Executor Run Time", 0)
            s["cpu"] += m.get("Executor CPU Time", 0) // 1_000_000
            s["gc"] += m.get("JVM GC Time", 0)
            s["tasks"] += 1
            s["records"] += (m.get("Input Metrics") or {}).get("Records Read", 0)
        elif e["Event"] == "SparkListenerStageCompleted":
            info = e["Stage Info"]
            names[info["Stage ID"]] = info["Stage Name"][:60]
    total = {k: sum(s[k] for s in per_stage.values()) for k in ("run", "cpu", "gc", "tasks")}
    print(f"jobs {len(jobs)}  stages {len(per_stage)}  tasks {total['tasks']}  "
          f"executor run {total['run']} ms  cpu {total['cpu']} ms  gc {total['gc']} ms")
    for sid, s in sorted(per_stage.items(), key=lambda kv: -kv[1]["run"])[: args.top]:
        print(f"  stage {sid:5d} run {s['run']:7d} ms  cpu {s['cpu']:7d} ms  tasks {s['tasks']:4d}"
              f"  records {s['records']:9d}  {names.get(sid, '')}")


if __name__ == "__main__":
    main()
