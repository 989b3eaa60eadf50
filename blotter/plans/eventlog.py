"""Per-query I/O and shuffle volumes from Spark's event log.

Run queries with ``spark.eventLog.enabled=true`` and a log folder, label
each query's jobs with ``sc.setJobDescription(label)``, then ``summarise``
the folder: shuffle bytes, tasks and task time per label.  (The log's input
bytes miss what a vectorised Parquet read fetches, so none are given.)  Read only after the session has stopped (or the log is flushed).
"""

from __future__ import annotations

import io
import json
import os
from collections import defaultdict


def _event_files(folder: str) -> list[str]:
    out = []
    for root, _, files in os.walk(folder):
        out += [os.path.join(root, f) for f in files if not f.startswith(".") and not f.endswith(".crc")]
    return sorted(out)


def _lines(path: str):
    if path.endswith(".zstd"):
        import zstandard

        with open(path, "rb") as raw:
            reader = zstandard.ZstdDecompressor().stream_reader(raw)
            yield from io.TextIOWrapper(reader, encoding="utf-8")
    else:
        with open(path, encoding="utf-8") as fh:
            yield from fh


def summarise(folder: str) -> dict[str, dict[str, int]]:
    stage_label: dict[int, str] = {}
    totals: dict[str, dict[str, int]] = defaultdict(
        lambda: {"jobs": 0, "tasks": 0, "task_ms": 0, "shuffle_write_bytes": 0, "shuffle_read_bytes": 0}
    )
    for path in _event_files(folder):
        for line in _lines(path):
            event = json.loads(line)
            kind = event.get("Event")
            if kind == "SparkListenerJobStart":
                label = (event.get("Properties") or {}).get("spark.job.description")
                if not label:
                    continue
                totals[label]["jobs"] += 1
                for sid in event.get("Stage IDs", []):
                    stage_label[sid] = label
            elif kind == "SparkListenerTaskEnd":
                label = stage_label.get(event.get("Stage ID"))
                metrics = event.get("Task Metrics") or {}
                if label is None or not metrics:
                    continue
                t = totals[label]
                t["tasks"] += 1
                t["task_ms"] += int(metrics.get("Executor Run Time", 0))
                sw = metrics.get("Shuffle Write Metrics") or {}
                t["shuffle_write_bytes"] += int(sw.get("Shuffle Bytes Written", 0))
                sr = metrics.get("Shuffle Read Metrics") or {}
                t["shuffle_read_bytes"] += int(sr.get("Remote Bytes Read", 0)) + int(sr.get("Local Bytes Read", 0))
    return dict(totals)
