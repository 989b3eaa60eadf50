"""Grouped aggregates and de-duplication.

Every operator here is a Catalyst aggregate, planned as a partial aggregate
on each map task, a shuffle of the (small) partial results and a final
merge.  A key holding a large share of the rows therefore never lands in
one task as raw rows: each map task sends at most one row per key.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

Keys = Sequence[str | Column]


def count_by(df: DataFrame, keys: Keys, name: str = "count") -> DataFrame:
    """Rows per group."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias(name))


def sum_ones_by(df: DataFrame, keys: Keys, name: str = "count") -> DataFrame:
    """Rows per group as a sum of ones per row (the key/value-pair formulation)."""
    return df.groupBy(*keys).agg(F.sum(F.lit(1)).cast("bigint").alias(name))


def avg_and_count(
    df: DataFrame,
    keys: Keys,
    value: str | Column,
    avg_name: str = "avg",
    count_name: str = "count",
    digits: int | None = None,
) -> DataFrame:
    """Mean of ``value`` and row count per group; mean optionally rounded."""
    mean = F.avg(value)
    if digits is not None:
        mean = F.round(mean, digits)
    return df.groupBy(*keys).agg(mean.alias(avg_name), F.count(F.lit(1)).alias(count_name))


def mean_from_sum_count(
    df: DataFrame,
    keys: Keys,
    value: str | Column,
    avg_name: str = "avg",
    count_name: str = "count",
    digits: int | None = None,
) -> DataFrame:
    """Mean as sum / count of the non-NULL values, plus the row count."""
    v = F.col(value) if isinstance(value, str) else value
    sums = df.groupBy(*keys).agg(
        F.sum(v).alias("__sum"),
        F.count(v).alias("__n"),
        F.count(F.lit(1)).alias(count_name),
    )
    mean = F.when(F.col("__n") > 0, F.col("__sum") / F.col("__n"))
    if digits is not None:
        mean = F.round(mean, digits)
    key_names = [k for k in sums.columns if k not in ("__sum", "__n", count_name)]
    return sums.select(*key_names, mean.alias(avg_name), count_name)


def agg_dict(df: DataFrame, keys: Keys, spec: Mapping[str, str]) -> DataFrame:
    """``{column: function}`` aggregation, e.g. ``{'age': 'sum'}``.

    Output columns are named ``function(column)`` as Spark names them.
    """
    return df.groupBy(*keys).agg(dict(spec))


def dedupe_any(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keep one row per key, whichever comes first (not deterministic)."""
    return df.dropDuplicates(list(keys))


def dedupe_first(df: DataFrame, keys: Sequence[str], order_by: str) -> DataFrame:
    """Keep, per key, the row with the smallest ``order_by`` value (NULLs last).

    ``row_number() = 1`` is planned as a group limit, so every task passes on
    one row per key it holds.  Rows equal in ``order_by`` are told apart by
    the other columns.
    """
    rest = [F.col(c).asc_nulls_first() for c in df.columns if c not in keys and c != order_by]
    place = Window.partitionBy(*keys).orderBy(F.col(order_by).asc_nulls_last(), *rest)
    numbered = df.withColumn("__place", F.row_number().over(place)).filter("__place = 1")
    columns = [*keys, order_by, *[c for c in df.columns if c not in keys and c != order_by]]
    return numbered.select(*columns)
