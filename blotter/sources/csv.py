"""CSV input and output.

Incident files arrive as CSV with a header and every field read as text.
Quoted fields may hold commas and doubled quotes (``"a ""b"", c"``); the
reader handles them with ``quote``/``escape`` set to the double quote, so no
per-line Python tokenising is needed and the scan stays splittable.
"""

from __future__ import annotations

import csv
from collections.abc import Iterable, Sequence
from concurrent.futures import ThreadPoolExecutor
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

CSV_OPTIONS = {
    "header": "true",
    "quote": '"',
    "escape": '"',
    "mode": "PERMISSIVE",
    # only an unquoted empty field is NULL; a quoted one is an empty text
    "nullValue": "\x00",
}


def string_schema(columns: Iterable[str]) -> StructType:
    """All-string, nullable schema in the given column order."""
    return StructType([StructField(name, StringType(), True) for name in columns])


def trim_headers(df: DataFrame) -> DataFrame:
    """Repair header names with stray blanks (``'AREA '`` → ``'AREA'``)."""
    trimmed = [name.strip() for name in df.columns]
    if trimmed == df.columns:
        return df
    return df.toDF(*trimmed)


def read_csv(
    spark: SparkSession,
    path: str | Sequence[str],
    columns: Sequence[str] | None = None,
    *,
    header: bool = True,
    repair_headers: bool = False,
    multiline: bool = False,
) -> DataFrame:
    """Read CSV as all-string columns.

    Without ``columns`` the header of the first file names them (still all
    strings, never inferred); reading fails on a file whose header differs.
    With ``repair_headers`` blanks around names go, and every file's own header
    says where its columns stand (one small job per file).  With ``columns`` and a header, the names are
    looked up in the header, blanks around names ignored, in any order; a
    missing name raises.  Without a header they name the fields by position,
    and no job runs.  ``multiline`` allows line breaks inside quoted fields
    but makes each file one task, so it is off by default.
    """
    paths = path if isinstance(path, str) else list(path)
    reader = spark.read.options(**CSV_OPTIONS).option("header", str(header).lower())
    reader = reader.option("multiLine", str(multiline).lower())
    if columns is not None and not header:
        return reader.schema(string_schema(columns)).csv(paths)
    if columns is None and repair_headers and header:
        wanted, scans = _scans(spark, path, None, "refuse")
        return _stacked([_picked(reader.schema(fields).csv(files), at) for fields, files, at in scans], wanted, spark)
    if columns is None:
        # each file's header is compared with the first one's where it is read
        df = reader.option("enforceSchema", "false").csv(paths)
        return trim_headers(df) if repair_headers else df
    parts = []
    for one in [path] if isinstance(path, str) else paths:
        # files below one path whose headers differ from the first one's raise
        named = trim_headers(reader.option("enforceSchema", "false").csv(one))
        missing = [c for c in columns if c not in named.columns]
        if missing:
            raise ValueError(f"columns {missing} are not in the header {named.columns} of {one}")
        parts.append(named.select(*[F.col("`" + c.replace("`", "``") + "`") for c in columns]))
    return reduce(DataFrame.unionByName, parts)


# ------------------------------------------------- files of differing headers

HEADER_READERS = 16  # header lines read at the same time
_BAD = "__bad_line"


def file_headers(spark: SparkSession, path: str | Sequence[str]) -> dict[str, list[str]]:
    """The trimmed names in the first line of every file below ``path``; files without a line are left out.

    One small job per file, a few at a time: it reads a file's first line and
    no more.
    """
    files = sorted(spark.read.text(path if isinstance(path, str) else list(path)).inputFiles())

    def first_line(file: str) -> str | None:
        row = spark.read.text(file).first()
        return row and row.value

    with ThreadPoolExecutor(HEADER_READERS) as pool:
        lines = list(pool.map(first_line, files))
    names = ((f, next(csv.reader([x.lstrip("\ufeff")]))) for f, x in zip(files, lines) if x is not None)
    return {f: [n.strip() for n in header] for f, header in names}


def _place(name: str, header: Sequence[str], file: str) -> int | None:
    """Where the column stands, upper and lower case being the same; two of the name raise."""
    at = [k for k, n in enumerate(header) if n.lower() == name.lower()]
    if len(at) > 1:
        raise ValueError(f"column {name!r} stands {len(at)} times in the header of {file}: {list(header)}")
    return at[0] if at else None


def _reason(line: Column, fields: int) -> Column:
    """Why a line is no row of ``fields`` fields."""
    quotes = F.length(line) - F.length(F.replace(line, F.lit('"'), F.lit("")))
    plain = F.regexp_replace(line, '"[^"]*"', "")
    found = F.length(plain) - F.length(F.replace(plain, F.lit(","), F.lit(""))) + 1
    return (
        F.when(quotes % 2 == 1, "open quote")
        .when(found < fields, "too few fields")
        .when(found > fields, "too many fields")
        .otherwise("unreadable")
    )


def _scans(
    spark: SparkSession, path: str | Sequence[str], columns: Sequence[str] | None, missing: str
) -> tuple[list[str], list[tuple[StructType, list[str], dict[str, int | None]]]]:
    """The columns, and per header its fields by place, its files and where each column stands."""
    if missing not in ("refuse", "null"):
        raise ValueError("missing is 'refuse' or 'null'")
    headers = file_headers(spark, path)
    if columns is None:
        seen: dict[str, str] = {}
        for header in headers.values():
            for name in header:
                seen.setdefault(name.lower(), name)
        columns = list(seen.values())
    alike: dict[tuple[str, ...], list[str]] = {}
    for file, header in headers.items():
        lacking = [c for c in columns if _place(c, header, file) is None]
        if lacking and missing == "refuse":
            raise ValueError(f"columns {lacking} are not in the header {header} of {file}")
        alike.setdefault(tuple(header), []).append(file)
    return list(columns), [
        (string_schema(f"f{k}" for k in range(len(header))), files, {c: _place(c, header, files[0]) for c in columns})
        for header, files in alike.items()
    ]


def _picked(lines: DataFrame, places: dict[str, int | None]) -> DataFrame:
    absent = F.lit(None).cast("string")
    return lines.select(*[(absent if at is None else F.col(f"f{at}")).alias(c) for c, at in places.items()])


def _stacked(parts: list[DataFrame], columns: Sequence[str], spark: SparkSession) -> DataFrame:
    return reduce(DataFrame.union, parts) if parts else spark.createDataFrame([], string_schema(columns))


def read_csv_checked(
    spark: SparkSession,
    path: str | Sequence[str],
    columns: Sequence[str] | None = None,
    *,
    missing: str = "refuse",
    multiline: bool = False,
) -> tuple[DataFrame, DataFrame]:
    """(rows, rejects) of CSV files whose headers may differ in order, blanks, case and columns.

    Every file's own header says where its columns stand; files with the same
    header are one scan.  ``columns`` are the wanted ones (by default all, in
    the order they first appear).  A column that some file lacks raises, or is
    NULL there with ``missing='null'``; a name that a header holds twice, blanks
    and case aside, raises.

    A line with too few or too many fields or with a quote left open is no row:
    it goes to ``rejects`` (file, reason, line) whole, and neither cut nor
    padded to ``rows``.  (Quotes within a field of a line that has the right
    number of fields are read as they stand.)  ``multiline`` as in :func:`read_csv`.
    """
    columns, scans = _scans(spark, path, columns, missing)
    rows, rejects = [], []
    for fields, files, places in scans:
        reader = spark.read.options(**CSV_OPTIONS).option("multiLine", str(multiline).lower())
        reader = reader.option("columnNameOfCorruptRecord", _BAD).schema(fields.add(_BAD, StringType()))
        # every field is parsed, used or not, else none would be missed; Spark wants a field read beside the bad line
        lines = reader.option("columnPruning", "false").csv(files)
        lines = lines.where(F.length(F.coalesce("f0", F.lit(""))) >= 0)
        rows.append(_picked(lines.where(F.col(_BAD).isNull()), places))
        rejects.append(
            lines.where(F.col(_BAD).isNotNull()).select(
                F.col("_metadata.file_path").alias("file"),
                _reason(F.col(_BAD), len(fields) - 1).alias("reason"),
                F.col(_BAD).alias("line"),
            )
        )
    return _stacked(rows, columns, spark), _stacked(rejects, ["file", "reason", "line"], spark)


def write_csv(
    df: DataFrame,
    path: str,
    *,
    header: bool = False,
    mode: str = "overwrite",
) -> None:
    """Write CSV that :func:`read_csv` reads back unchanged.

    Blanks at either end of a field stay, an empty text is written as ``""``
    and NULL as nothing.  A line break inside a field is kept in quotes; such
    a file needs ``multiline=True`` when read.
    """
    (
        df.write.mode(mode)
        .option("header", str(header).lower())
        .option("quote", '"')
        .option("escape", '"')
        .option("ignoreLeadingWhiteSpace", "false")
        .option("ignoreTrailingWhiteSpace", "false")
        .option("emptyValue", '""')
        .option("nullValue", "")
        .csv(path)
    )
