"""Compare catalog queries with their DuckDB oracles (the driver's check, locally).

Usage: ``python -m blotter.verify [sf_dir] [key ...]``
"""

from __future__ import annotations

import datetime as dt
import hashlib
import math
import sys
import time

import duckdb
import pyarrow as pa
from pyspark.sql import SparkSession

from blotter.catalog import QUERIES, TABLES
from blotter.oracle import ORACLE_SQL


EXACT = False  # compare doubles bit for bit instead of to 9 decimals


def _canon(v: object) -> object:
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return None
        return repr(v) if EXACT else repr(round(v, 9))
    if isinstance(v, (dt.datetime, dt.date)):
        return v.isoformat()
    if isinstance(v, bool):
        return str(v)
    if isinstance(v, int):
        return str(v)
    return str(v)


def _rows(table: pa.Table) -> list[tuple]:
    cols = sorted(table.column_names)
    data = [table.column(c).to_pylist() for c in cols]
    return sorted(
        (tuple(_canon(v) for v in row) for row in zip(*data)),
        key=lambda r: tuple("" if x is None else str(x) for x in r),
    )


def _digest(rows: list[tuple]) -> str:
    h = hashlib.sha256()
    for r in rows:
        h.update(repr(r).encode())
    return h.hexdigest()[:16]


def _types(table: pa.Table) -> dict[str, str]:
    out = {}
    for f in table.schema:
        t = f.type
        if pa.types.is_large_string(t) or pa.types.is_string_view(t):
            t = pa.string()
        out[f.name] = str(t)
    return out


def duck_connection(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def compare(spark: SparkSession, sf_dir: str, key: str, con: duckdb.DuckDBPyConnection) -> dict:
    t0 = time.time()
    got = QUERIES[key](spark, sf_dir).toArrow()
    spark_sec = time.time() - t0
    result = {"key": key, "spark_rows": got.num_rows, "spark_sec": round(spark_sec, 3)}
    if key not in ORACLE_SQL:
        result["status"] = "rows-only"
        return result
    want = con.sql(ORACLE_SQL[key]).to_arrow_table()
    result["oracle_rows"] = want.num_rows
    names_ok = sorted(got.column_names) == sorted(want.column_names)
    types_ok = _types(got) == _types(want)
    rows_g, rows_w = _rows(got), _rows(want) if names_ok else []
    values_ok = names_ok and _digest(rows_g) == _digest(rows_w)
    result.update(names_ok=names_ok, types_ok=types_ok, values_ok=values_ok)
    if not types_ok:
        result["types"] = {"spark": _types(got), "oracle": _types(want)}
    if names_ok and not values_ok:
        only_g = [r for r in rows_g if r not in set(rows_w)][:3]
        only_w = [r for r in rows_w if r not in set(rows_g)][:3]
        result["diff"] = {"spark_only": only_g, "oracle_only": only_w}
    result["status"] = "ok" if (names_ok and types_ok and values_ok and got.num_rows == want.num_rows) else "FAIL"
    return result


def main(argv: list[str]) -> int:
    global EXACT
    if argv and argv[0] == "--exact":
        EXACT, argv = True, argv[1:]
    sf_dir = argv[0] if argv else "/root/testdata/sf0.01"
    keys = argv[1:] or list(QUERIES)
    from blotter.session import build_session

    spark = build_session("local[8]", "blotter-verify", shuffle_partitions=8)
    spark.sparkContext.setLogLevel("ERROR")
    con = duck_connection(sf_dir)
    bad = 0
    for key in keys:
        try:
            r = compare(spark, sf_dir, key, con)
        except Exception as exc:  # report and go on
            r = {"key": key, "status": "ERROR", "error": f"{type(exc).__name__}: {str(exc)[:400]}"}
        bad += r["status"] not in ("ok", "rows-only")
        print(r, flush=True)
    print(f"{len(keys) - bad}/{len(keys)} ok")
    return 1 if bad else 0


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))
