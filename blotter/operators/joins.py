"""Equi-joins under a chosen strategy.

Rules kept everywhere:

* The strategy hint goes on the *dimension* side only.  Hinting both sides
  lets Spark pick the build side from poor statistics, which can broadcast
  the facts.
* ``broadcast`` is honoured only after a size check (``plans.guards``); a
  dimension that fails it raises, so a growing table never gets shipped
  whole to every executor and no other strategy is taken silently.  Leave
  the strategy to Spark (``None``) where the size is not known, or use
  ``broadcast_join``, which shuffles (with a warning) where it may not broadcast.
* With AQE on, a sort-merge join whose fact side has a hot key is split
  into sub-joins at run time (``spark.sql.adaptive.skewJoin.enabled``).
* Joins are true inner joins: duplicate keys multiply, unmatched rows and
  NULL keys drop.

Cartesian strategies (``shuffle_replicate_nl``) are not offered: they pair
every row with every row and do not survive large inputs.
"""

from __future__ import annotations

import warnings
from collections.abc import Sequence

from pyspark.sql import DataFrame

from blotter.functions.numeric import to_int
from blotter.plans.guards import DEFAULT_BROADCAST_ROWS, broadcast_if_small

STRATEGIES = ("broadcast", "shuffle_hash", "merge")


def _keys(on: str | Sequence[str]) -> list[str]:
    return [on] if isinstance(on, str) else list(on)


def join_with_strategy(
    facts: DataFrame,
    dim: DataFrame,
    on: str | Sequence[str],
    strategy: str | None = None,
    how: str = "inner",
    max_broadcast_rows: int = DEFAULT_BROADCAST_ROWS,
) -> DataFrame:
    """Join ``facts`` with ``dim`` on same-named key columns (USING semantics).

    ``strategy=None`` leaves the choice to Spark (statistics + AQE).
    """
    keys = _keys(on)
    if strategy is None:
        return facts.join(dim, keys, how)
    if strategy not in STRATEGIES:
        raise ValueError(f"unknown join strategy {strategy!r}; use one of {STRATEGIES}")
    if strategy == "broadcast":
        small, ok = broadcast_if_small(dim, max_broadcast_rows)
        if not ok:
            raise ValueError("the dimension is beyond the broadcast bound; choose another strategy or None")
        return facts.join(small, keys, how)
    return facts.join(dim.hint(strategy), keys, how)


def broadcast_join(
    facts: DataFrame,
    dim: DataFrame,
    on: str | Sequence[str],
    how: str = "inner",
    max_broadcast_rows: int = DEFAULT_BROADCAST_ROWS,
) -> DataFrame:
    """Join for dimensions of any size: broadcast within the size check.

    A dimension beyond it is not shipped to every executor: both sides are
    dealt by key and merged, with a warning.  The rows are the same.
    """
    small, ok = broadcast_if_small(dim, max_broadcast_rows)
    if ok:
        return facts.join(small, _keys(on), how)
    warnings.warn("the dimension is beyond the broadcast bound: both sides are shuffled and merged", stacklevel=2)
    return join_with_strategy(facts, dim, on, "merge", how)


def map_side_join(
    facts: DataFrame,
    dim: DataFrame,
    on: str | Sequence[str],
    max_broadcast_rows: int = DEFAULT_BROADCAST_ROWS,
) -> DataFrame:
    """Look each fact row up in a dimension shipped to every task.

    No shuffle of the facts, unless the dimension fails the size check
    (:func:`broadcast_join`).
    """
    return broadcast_join(facts, dim, on, max_broadcast_rows=max_broadcast_rows)


def repartition_join(facts: DataFrame, dim: DataFrame, on: str | Sequence[str]) -> DataFrame:
    """Both sides hash-partitioned on the key, then merged per partition.

    The DataFrame form of the tagged-union / reduce-by-key join: rows of
    both inputs meet in the partition of their key.  Sorting (instead of
    buffering a key's rows in lists) lets a large key spill to disk.
    """
    return join_with_strategy(facts, dim, on, "merge")


def _normalise(df: DataFrame, source: str, key: str) -> DataFrame:
    out = df.withColumn(key, to_int(source))
    # column names resolve case-insensitively: 'AREA' -> 'area' is a replacement
    if source.lower() != key.lower():
        out = out.drop(source)
    return out


def join_normalised(
    left: DataFrame,
    right: DataFrame,
    left_key: str,
    right_key: str,
    key: str,
    strategy: str | None = None,
    max_broadcast_rows: int = DEFAULT_BROADCAST_ROWS,
) -> DataFrame:
    """Join two text keys that differ only in zero padding (``'07'`` vs ``'7'``).

    Both keys become int column ``key``; text that is not a number gets NULL
    and matches nothing.
    """
    lhs = _normalise(left, left_key, key)
    rhs = _normalise(right, right_key, key)
    return join_with_strategy(lhs, rhs, key, strategy, max_broadcast_rows=max_broadcast_rows)
