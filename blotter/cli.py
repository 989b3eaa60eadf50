"""Command line for the four questions over incident files.

    python -m blotter.cli q1 --incidents a.csv b.csv [--sql] [--rank] [--format parquet]
    python -m blotter.cli q2 --incidents a.csv b.csv [--premise STREET]
    python -m blotter.cli q3 --incidents a.csv --places revgeo.csv --incomes income.csv [--strategy merge]
    python -m blotter.cli q4 --incidents a.csv b.csv --stations stations.csv [--regex 1..]
    python -m blotter.cli to-parquet --source a.csv --target a.parquet

Inputs are CSV with a header (all columns text, header names trimmed) or,
with ``--format parquet``, Parquet.  Several incident files are unioned by
position.  The result is shown, or written with ``--output`` (Parquet).
Under ``spark-submit`` the master comes from it; with plain ``python`` pass
``--master local[*]``.
"""

from __future__ import annotations

import argparse
import sys

from pyspark.sql import DataFrame, SparkSession

from blotter.functions.numeric import to_int
from blotter.questions import (
    day_segment_counts,
    descent_breakdown,
    peak_months,
    peak_months_sql,
    station_distance,
)
from blotter.session import build_session
from blotter.sources import csv_to_parquet, descent_codes, read_csv, read_parquet
from blotter.operators.setops import union_positional


def _load(spark: SparkSession, paths: list[str], fmt: str) -> list[DataFrame]:
    if fmt == "parquet":
        return [read_parquet(spark, p) for p in paths]
    return [read_csv(spark, p, repair_headers=True) for p in paths]


def _parser() -> argparse.ArgumentParser:
    ap = argparse.ArgumentParser(prog="python -m blotter.cli", description=__doc__.split("\n\n")[0])
    ap.add_argument("question", choices=["q1", "q2", "q3", "q4", "to-parquet"])
    ap.add_argument("--incidents", nargs="+", default=[])
    ap.add_argument("--format", choices=["csv", "parquet"], default="csv")
    ap.add_argument("--places")
    ap.add_argument("--incomes")
    ap.add_argument("--stations")
    ap.add_argument("--source", nargs="+")
    ap.add_argument("--target")
    ap.add_argument("--sql", action="store_true", help="Q1 through SQL")
    ap.add_argument("--rank", action="store_true", help="Q1 with rank() instead of positions")
    ap.add_argument("--premise", default="STREET")
    ap.add_argument("--strategy", choices=["broadcast", "shuffle_hash", "merge"])
    ap.add_argument("--regex", help="Q4 code filter as an unanchored regex instead of 100 <= code < 200")
    ap.add_argument("--community", default="Los Angeles")
    ap.add_argument("--output")
    ap.add_argument("--master")
    return ap


def run(args: argparse.Namespace, spark: SparkSession) -> DataFrame | None:
    if args.question == "to-parquet":
        csv_to_parquet(spark, args.source, args.target)
        return None
    incidents = _load(spark, args.incidents, args.format)
    method = "rank" if args.rank else "row_number"
    if args.question == "q1":
        if args.sql:
            return peak_months_sql(spark, *incidents, method=method)
        return peak_months(*incidents, method=method)
    if args.question == "q2":
        facts = union_positional(*incidents)
        return day_segment_counts(facts, to_int("TIME OCC"), premise=args.premise)
    if args.question == "q3":
        (places,) = _load(spark, [args.places], args.format)
        (incomes,) = _load(spark, [args.incomes], args.format)
        places = places.withColumnRenamed("ZIPcode", "Zip Code")
        return descent_breakdown(
            union_positional(*incidents), places, incomes, descent_codes(spark),
            community=args.community, strategy=args.strategy,
        )
    (stations,) = _load(spark, [args.stations], args.format)
    stations = stations.withColumnRenamed("LOCATION", "LOCATION_PD")
    if args.regex:
        return station_distance(union_positional(*incidents), stations, code_range=None, code_pattern=args.regex)
    return station_distance(union_positional(*incidents), stations)


def main(argv: list[str] | None = None) -> int:
    args = _parser().parse_args(argv)
    spark = build_session(args.master, "blotter-cli")
    result = run(args, spark)
    if result is not None:
        if args.output:
            result.write.mode("errorifexists").parquet(args.output)
        else:
            result.show(1000, truncate=False)
    return 0


if __name__ == "__main__":
    sys.exit(main())
