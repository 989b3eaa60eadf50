"""Sums and means of doubles that do not depend on the order of the rows.

Adding doubles rounds at every step, so a plain sum depends on how rows are
dealt to tasks.  Here every value is cut into whole numbers instead: with its
binary exponent in a window of 32 powers of two, the value is a whole multiple
of the window's unit, which is split into a high and a low part of at most 44
bits.  Those parts are added as decimals, exactly, per group and window (a
partial aggregate of hash type); the at most 66 windows of a group are put
together in their order at the end.  The result is the same bit for bit
however the rows are partitioned, and off by the last bits of the final few
additions only.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

WINDOW = 32  # powers of two
LOW_BITS = 44
FIRST, LAST = -34, 31  # windows of all doubles, from the smallest subnormal on
_UNIT = 54  # bits below the window's first power that a value may reach


def _powers(sign: int) -> list[tuple[float, float]]:
    """2 ** (sign * unit exponent) of every window, as two factors that are doubles."""
    out = []
    for k in range(FIRST, LAST + 1):
        e = sign * (WINDOW * k - _UNIT)
        out.append((2.0 ** (e // 2), 2.0 ** (e - e // 2)))
    return out


def _factor(window: Column, sign: int, which: int) -> Column:
    table = F.array(*[F.lit(p[which]) for p in _powers(sign)])
    return F.get(table, (window - FIRST).cast("int"))


def exact_sum(
    df: DataFrame,
    keys: Sequence[str | Column],
    value: str | Column,
    sum_name: str = "sum",
    n_name: str = "n",
    rows_name: str = "rows",
) -> DataFrame:
    """Per group: the keys, the sum (double), the number of values and that of rows.

    NULL values are left out of the sum; without any it is NULL.  A NaN or
    infinities of both signs give NaN, one infinity gives that infinity.
    """
    v = (F.col(value) if isinstance(value, str) else value).cast("double")
    tagged = df.withColumn("__x", v)
    x = F.col("__x")
    finite = ~F.isnan(x) & (F.abs(x) != float("inf"))
    window = F.when(finite & (x != 0), F.floor(F.floor(F.log2(F.abs(x))) / WINDOW).cast("int"))
    tagged = tagged.withColumn("__w", window)
    scaled = x * _factor(F.col("__w"), -1, 0) * _factor(F.col("__w"), -1, 1)
    tagged = tagged.withColumn("__y", scaled)
    high = F.floor(F.col("__y") / 2.0**LOW_BITS)
    low = F.col("__y") - high.cast("double") * 2.0**LOW_BITS
    names = df.select(*keys).columns
    parts = (
        tagged.groupBy(*keys, "__w")
        .agg(
            F.sum(high.cast("decimal(20,0)")).alias("__high"),
            F.sum(low.cast("bigint").cast("decimal(20,0)")).alias("__low"),
            F.count("__x").alias("__n"),
            F.count(F.lit(1)).alias("__rows"),
            F.max(F.isnan(x)).alias("__nan"),
            F.max(x == float("inf")).alias("__up"),
            F.max(x == float("-inf")).alias("__down"),
        )
        .groupBy(*[F.col("`" + c.replace("`", "``") + "`") for c in names])
        .agg(
            # at most 67 windows a group
            F.sort_array(F.collect_list(F.struct("__w", "__high", "__low"))).alias("__parts"),
            F.sum("__n").alias("__values"),
            F.sum("__rows").alias("__all"),
            *[F.coalesce(F.max(c), F.lit(False)).alias(c) for c in ("__nan", "__up", "__down")],
        )
    )

    def worth(p: Column) -> Column:
        whole = p["__high"].cast("double") * 2.0**LOW_BITS + p["__low"].cast("double")
        return F.coalesce(whole * _factor(p["__w"], 1, 0) * _factor(p["__w"], 1, 1), F.lit(0.0))

    total = F.aggregate("__parts", F.lit(0.0), lambda acc, p: acc + worth(p))
    up, down = F.col("__up"), F.col("__down")
    total = (
        F.when(F.col("__values") == 0, F.lit(None))
        .when(F.col("__nan") | (up & down), F.lit(float("nan")))
        .when(up, F.lit(float("inf")))
        .when(down, F.lit(float("-inf")))
        .otherwise(total)
    )
    return parts.select(
        *[F.col("`" + c.replace("`", "``") + "`") for c in names],
        total.alias(sum_name),
        F.col("__values").alias(n_name),
        F.col("__all").alias(rows_name),
    )


def exact_mean(
    df: DataFrame,
    keys: Sequence[str | Column],
    value: str | Column,
    avg_name: str = "avg",
    count_name: str = "count",
    digits: int | None = None,
) -> DataFrame:
    """Mean of ``value`` and row count per group, the same for every partitioning of the rows."""
    sums = exact_sum(df, keys, value, "__sum", "__values", "__all")
    mean = F.col("__sum") / F.when(F.col("__values") > 0, F.col("__values"))
    if digits is not None:
        mean = F.round(mean, digits)
    names = [F.col("`" + c.replace("`", "``") + "`") for c in sums.columns if c not in ("__sum", "__values", "__all")]
    return sums.select(*names, mean.alias(avg_name), F.col("__all").alias(count_name))
