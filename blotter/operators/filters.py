"""Row filters.  All are plain Catalyst predicates, so on a Parquet scan the
simple ones (equality, ranges, not-null) appear under ``PushedFilters``.

NULL rule: SQL logic throughout — a comparison with NULL is unknown and the
row is dropped, so ``where_not_equal`` also drops rows whose value is NULL.
"""

from __future__ import annotations

from pyspark.sql import DataFrame

from blotter.functions._cols import ColumnOrName, as_col


def where_equal(df: DataFrame, c: ColumnOrName, value: object) -> DataFrame:
    return df.filter(as_col(c) == value)


def where_not_equal(df: DataFrame, c: ColumnOrName, value: object) -> DataFrame:
    """Keep rows whose value differs from ``value``; NULL values are dropped too."""
    return df.filter(as_col(c) != value)


def where_not_null(df: DataFrame, c: ColumnOrName) -> DataFrame:
    return df.filter(as_col(c).isNotNull())


def where_contains(df: DataFrame, c: ColumnOrName, needle: str) -> DataFrame:
    """Case-sensitive substring match."""
    return df.filter(as_col(c).contains(needle))


def where_regex(df: DataFrame, c: ColumnOrName, pattern: str) -> DataFrame:
    """Java regex *search*: the pattern may match anywhere in the text.

    ``'1..'`` accepts ``'2100'``; anchor it (``'^1..$'``) for a whole match.
    """
    return df.filter(as_col(c).rlike(pattern))


def where_in_range(df: DataFrame, c: ColumnOrName, low: object, high: object) -> DataFrame:
    """Half-open range ``low <= c < high``."""
    col = as_col(c)
    return df.filter((col >= low) & (col < high))
