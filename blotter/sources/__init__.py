"""Readers, writers and inline tables."""

from blotter.sources.codes import DESCENT_CODES, descent_codes
from blotter.sources.csv import file_headers, read_csv, read_csv_checked, string_schema, trim_headers, write_csv
from blotter.sources.inline import inline_table
from blotter.sources.parquet import csv_to_parquet, read_parquet, read_table, write_clustered

__all__ = [
    "DESCENT_CODES",
    "descent_codes",
    "csv_to_parquet",
    "file_headers",
    "inline_table",
    "read_csv",
    "read_csv_checked",
    "read_parquet",
    "read_table",
    "string_schema",
    "trim_headers",
    "write_clustered",
    "write_csv",
]
