"""Write a Markdown report of the headline queries' physical plans and volumes.

Usage: ``python -m blotter.plans.report <sf_dir> <out.md> [key ...]``

For each query: the operator tree Spark plans (before adaptive changes),
the scans' pushed filters and read schemas, and, from the event log of one
run, jobs, tasks, task time and shuffle bytes.
"""

from __future__ import annotations

import os
import re
import sys
import tempfile

from blotter.plans.inspect import physical_section, plan_text

_SCAN_RE = re.compile(r"^\(\d+\) Scan parquet.*?(?=^\(\d+\) |\Z)", re.S | re.M)


def _tree(formatted: str) -> str:
    body = formatted.split("== Physical Plan ==", 1)[-1].strip()
    return body.split("\n\n", 1)[0]


def _scans(formatted: str) -> list[str]:
    out = []
    for block in _SCAN_RE.findall(formatted):
        keep = [
            ln for ln in block.splitlines()
            if ln.startswith(("Location", "PushedFilters", "ReadSchema"))
        ]
        keep = [re.sub(r"InMemoryFileIndex \[file:[^\]]*/([^/\]]+)\]", r"\1", ln) for ln in keep]
        out.append("; ".join(keep))
    return out


def main(argv: list[str]) -> int:
    sf_dir, out_path, *keys = argv
    from blotter.catalog import QUERIES
    from blotter.plans.eventlog import summarise
    from blotter.session import build_session

    import bench

    keys = keys or bench.HEADLINE
    log_dir = tempfile.mkdtemp(prefix="blotter-events-")
    spark = build_session(
        "local[8]",
        "blotter-report",
        shuffle_partitions=16,
        conf={"spark.eventLog.enabled": "true", "spark.eventLog.dir": log_dir},
    )
    spark.sparkContext.setLogLevel("ERROR")
    sections = []
    for key in keys:
        spark.sparkContext.setJobDescription(key)  # eager writes/checks count too
        df = QUERIES[key](spark, sf_dir)
        formatted = plan_text(df, "formatted")
        if key.startswith("q"):
            # results of the questions are small: collect, then show the final
            # adaptive plan with its whole-stage-codegen stage numbers *(n)
            df.collect()
            lines = [ln.rstrip()[:160] for ln in physical_section(df).strip().splitlines()]
            tree = "\n".join(ln for ln in lines if ln.strip() != "+-")
        else:
            df.write.format("noop").mode("overwrite").save()
            tree = _tree(formatted)
        sections.append((key, tree, _scans(formatted)))
    spark.stop()
    volumes = summarise(log_dir)
    lines = [
        "# Physical plans of the headline queries",
        "",
        f"Generated by `python -m blotter.plans.report` on `{os.path.basename(sf_dir)}`, local[8].",
        "For the questions (q*) the tree is the final adaptive plan after a run, where `*(n)`",
        "marks operators fused into whole-stage-codegen stage n; for the others it is the plan",
        "before adaptive re-planning.  Volumes come from the event log of one run (jobs include",
        "the eager writes a question performs).",
        "",
    ]
    for key, tree, scans in sections:
        v = volumes.get(key, {})
        lines += [f"## {key}", "", "```", tree, "```", ""]
        for s in scans:
            lines.append(f"* scan: {s}")
        if v:
            lines.append(
                f"* jobs {v['jobs']}, tasks {v['tasks']}, task time {v['task_ms']} ms, "
                f"shuffle written {v['shuffle_write_bytes']} B"
            )
        lines.append("")
    with open(out_path, "w", encoding="utf-8") as fh:
        fh.write("\n".join(lines))
    return 0


if __name__ == "__main__":
    sys.path.insert(0, os.getcwd())
    sys.exit(main(sys.argv[1:]))
