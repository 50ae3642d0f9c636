"""Per-stage summary of a Spark event log (no UI needed).

    python tools/stage_report.py <event-log-dir> [job-group]

Prints, per completed stage: tasks, wall time, input rows, shuffle rows
written and read.  With ``job-group`` only stages of jobs in that group.
Run a job with ``spark.eventLog.enabled=true`` and ``spark.eventLog.dir``
pointing at a scratch folder (``BENCH_EVENT_LOG`` does this for bench.py).
"""

from __future__ import annotations

import glob
import io
import json
import os
import sys


def read_events(log_dir: str) -> list[dict]:
    events = []
    for path in sorted(glob.glob(os.path.join(log_dir, "**", "*"), recursive=True)):
        name = os.path.basename(path)
        if os.path.isdir(path) or name.startswith("appstatus"):
            continue
        with open(path, "rb") as fh:
            if path.endswith(".zstd"):
                import zstandard
                stream = zstandard.ZstdDecompressor().stream_reader(fh)
            else:
                stream = fh
            for line in io.TextIOWrapper(stream, encoding="utf-8"):
                if line.strip():
                    events.append(json.loads(line))
    return events


def main() -> None:
    log_dir = sys.argv[1]
    group = sys.argv[2] if len(sys.argv) > 2 else None
    events = read_events(log_dir)
    wanted = None
    if group:
        wanted = set()
        for e in events:
            if e["Event"] == "SparkListenerJobStart" and e.get("Properties", {}).get("spark.jobGroup.id") == group:
                wanted.update(e["Stage IDs"])
    for e in events:
        if e["Event"] != "SparkListenerStageCompleted":
            continue
        info = e["Stage Info"]
        if wanted is not None and info["Stage ID"] not in wanted:
            continue
        if info.get("Submission Time") is None:
            continue
        acc = {a["Name"]: a.get("Value") for a in info.get("Accumulables", [])}
        print(
            f"stage {info['Stage ID']:4d}  tasks {info['Number of Tasks']:4d}  "
            f"{info['Completion Time'] - info['Submission Time']:6d} ms  "
            f"input {acc.get('internal.metrics.input.recordsRead', '-')}  "
            f"shuffle-write {acc.get('internal.metrics.shuffle.write.recordsWritten', '-')}  "
            f"shuffle-read {acc.get('internal.metrics.shuffle.read.recordsRead', '-')}  "
            f"{info['Stage Name'][:60]}"
        )


if __name__ == "__main__":
    main()
