"""Column-level operators: derive, rename, project, distinct."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame

from blotter.sources.csv import trim_headers


def derive(df: DataFrame, columns: Mapping[str, Column]) -> DataFrame:
    """Add or replace several columns in one projection."""
    return df.withColumns(dict(columns))


def rename(df: DataFrame, mapping: Mapping[str, str]) -> DataFrame:
    """Rename columns; names not present are ignored, as ``withColumnRenamed`` does."""
    return df.withColumnsRenamed(dict(mapping))


def repair_headers(df: DataFrame) -> DataFrame:
    """Trim stray blanks around column names."""
    return trim_headers(df)


def project(df: DataFrame, columns: Sequence[str | Column]) -> DataFrame:
    return df.select(*columns)


def distinct_values(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Distinct combinations of some columns (a partial-then-final aggregate)."""
    return df.select(*columns).distinct()
