"""Unions."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame


def union_positional(*frames: DataFrame) -> DataFrame:
    """UNION ALL by column position; the first input names the columns.

    Works across inputs whose headers differ (``'AREA '`` vs ``'AREA'``), as
    long as the column order and count agree.
    """
    if not frames:
        raise ValueError("nothing to union")
    return reduce(DataFrame.union, frames)


def union_by_name(*frames: DataFrame, allow_missing: bool = False) -> DataFrame:
    """UNION ALL matching columns by name."""
    if not frames:
        raise ValueError("nothing to union")
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=allow_missing), frames)
