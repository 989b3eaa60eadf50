"""Benchmark the headline queries; prints one JSON line.

Environment: ``BENCH_SF_DIR`` (default /root/testdata/sf0.1), ``BENCH_CPUS``
(default 8), ``BENCH_DRIVER_MEMORY`` (default 8g), ``BENCH_EVENT_LOG`` (a
fresh folder for Spark's event log; default: a new temporary folder, since
the bench runs in local mode).  Per-query jobs, tasks, input and shuffle
bytes of the first timed run are read from the log into ``io``.  Each query is built and
run to completion through the ``noop`` sink (no rows collected), once to
warm the JVM and then ``BENCH_RUNS`` times (default 2); a query's time is
its best timed run and ``value`` is the sum of those.
"""

from __future__ import annotations

import json
import os
import re
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = [
    "q1_df",
    "q1_sql",
    "q1_rank_ties",
    "q2_day_segments",
    "q2_pairs",
    "q1_two_files",
    "q1_csv",
    "q2_csv",
    "q3_top",
    "q3_bottom",
    "q3_both",
    "q3_top_broadcast",
    "q3_top_shuffle_hash",
    "q3_top_merge",
    "q3_top_merge_all",
    "q3_top_mixed",
    "q3_bottom_mixed",
    "q3_dedupe_first",
    "q4_mean_distance",
    "join_broadcast",
    "join_shuffle_hash",
    "join_merge",
    "join_map_side",
    "join_repartition",
    "join_hot_key",
    "join_hash_bounded",
    "mean_exact",
    "convert_clustered",
    "scan_csv_aligned",
    "union_positional",
    "dedupe_first",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    memory = os.environ.get("BENCH_DRIVER_MEMORY", "8g")
    event_log = os.environ.get("BENCH_EVENT_LOG") or tempfile.mkdtemp(prefix="blotter-bench-events-")
    os.makedirs(event_log, exist_ok=True)
    conf = {
        "spark.driver.memory": memory,
        "spark.eventLog.enabled": "true",
        "spark.eventLog.dir": event_log,
    }
    t0 = time.time()
    from blotter.session import build_session

    spark = build_session(
        f"local[{cpus}]",
        "blotter-bench",
        shuffle_partitions=max(cpus * 2, 8),
        conf=conf,
    )
    spark.sparkContext.setLogLevel("ERROR")
    from blotter.catalog import QUERIES

    session_sec = time.time() - t0

    def run(key: str, label: str) -> float:
        spark.sparkContext.setJobDescription(label)
        start = time.time()
        QUERIES[key](spark, sf_dir).write.format("noop").mode("overwrite").save()
        return time.time() - start

    runs = int(os.environ.get("BENCH_RUNS", "2"))
    cold = {k: round(run(k, f"cold:{k}"), 3) for k in HEADLINE}
    timed = {k: [] for k in HEADLINE}
    for i in range(runs):
        for k in HEADLINE:
            timed[k].append(run(k, k if i == 0 else f"run{i}:{k}"))
    warm = {k: round(min(v), 3) for k, v in timed.items()}
    match = re.search(r"sf([0-9.]+)$", sf_dir)
    result = {
        "metric": "headline_queries_total",
        "value": round(sum(warm.values()), 3),
        "unit": "sec",
        "queries": warm,
        "cold": cold,
        "runs": runs,
        "session_start_sec": round(session_sec, 3),
        "sf": float(match.group(1)) if match else sf_dir,
        "cpus": cpus,
    }
    spark.stop()
    from blotter.plans.eventlog import summarise

    volumes = summarise(event_log)
    result["io"] = {k: volumes.get(k, {}) for k in HEADLINE}
    print(json.dumps(result))


if __name__ == "__main__":
    main()
