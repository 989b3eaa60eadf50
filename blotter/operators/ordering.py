"""Sorting and top-k / bottom-k.

Top-k stays a DataFrame (``orderBy().limit(k)``), planned as
``TakeOrderedAndProject``: every task keeps its own k best rows and only
those meet in one place, so nothing but k rows per task moves, and the
result can be joined or broadcast later with a size bound of k rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def sort_by(df: DataFrame, order: Sequence[Column]) -> DataFrame:
    return df.orderBy(*order)


def sort_result(df: DataFrame, order: Sequence[Column | str]) -> DataFrame:
    """Order a final result (a global sort: no task has to hold all rows)."""
    return df.orderBy(*order)


def top_k(df: DataFrame, value: str, k: int, tie: str | None = None) -> DataFrame:
    """The k rows with the largest non-NULL ``value``; ties broken by ``tie`` ascending."""
    order = [F.col(value).desc()]
    if tie:
        order.append(F.col(tie).asc_nulls_last())
    return df.filter(F.col(value).isNotNull()).orderBy(*order).limit(k)


def bottom_k(df: DataFrame, value: str, k: int, tie: str | None = None) -> DataFrame:
    """The k rows with the smallest non-NULL ``value``.

    These are the last k rows of the :func:`top_k` order,
    hence the reversed tie key.
    """
    order = [F.col(value).asc_nulls_last()]
    if tie:
        order.append(F.col(tie).desc_nulls_last())
    return df.filter(F.col(value).isNotNull()).orderBy(*order).limit(k)
