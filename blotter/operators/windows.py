"""Ranking within groups."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

_RANKERS = {
    "row_number": F.row_number,  # position: ties broken by the order keys
    "rank": F.rank,              # ties share a rank, gaps follow
    "dense_rank": F.dense_rank,
}


def rank_within(
    df: DataFrame,
    partition_by: Sequence[str | Column],
    order_by: Sequence[Column],
    method: str = "row_number",
    rank_col: str = "rank",
) -> DataFrame:
    if method not in _RANKERS:
        raise ValueError(f"unknown ranking {method!r}; use one of {sorted(_RANKERS)}")
    window = Window.partitionBy(*partition_by).orderBy(*order_by)
    return df.withColumn(rank_col, _RANKERS[method]().over(window))


def top_n_per_group(
    df: DataFrame,
    partition_by: Sequence[str | Column],
    order_by: Sequence[Column],
    n: int,
    method: str = "row_number",
    rank_col: str = "rank",
) -> DataFrame:
    """Rows ranked ``<= n`` within each group.

    Catalyst turns the rank filter into a ``WindowGroupLimit`` that runs
    before the shuffle, so each map task ships at most ``n`` rows per group
    (for ``rank``: the rows tied within the first ``n`` ranks).
    """
    ranked = rank_within(df, partition_by, order_by, method, rank_col)
    return ranked.filter(F.col(rank_col) <= n)
