"""Size guards in front of broadcast decisions.

A side is broadcast only when its size is bounded: either by construction
(a literal table, the output of ``limit(k)``) or by a check run here.  The
check bounds both the number of rows and their bytes (strings by their
UTF-8 length, other types by their fixed width); beyond either bound the
caller must take a shuffle join.

``has_at_most`` is one aggregate (row count and summed bytes) computed on the
executors; one row reaches the driver.  ``broadcast_if_small`` observes the
same numbers while writing the copy that the join reads, when it is built.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql.types import (
    ArrayType,
    BinaryType,
    BooleanType,
    ByteType,
    DateType,
    FloatType,
    IntegerType,
    MapType,
    NumericType,
    ShortType,
    StringType,
    StructType,
)

from blotter.session import scratch_path

# Rows and bytes a dimension may have to be shipped whole to every executor.
DEFAULT_BROADCAST_ROWS = 200_000
DEFAULT_BROADCAST_BYTES = 64 << 20


def _fixed_width(dtype) -> int:
    if isinstance(dtype, (BooleanType, ByteType)):
        return 1
    if isinstance(dtype, ShortType):
        return 2
    if isinstance(dtype, (IntegerType, FloatType, DateType)):
        return 4
    return 8 if dtype.typeName() in ("long", "double", "timestamp", "timestamp_ntz") else 16


def row_bytes(df: DataFrame) -> Column:
    """Estimated bytes of one row: UTF-8 length of text, the fixed width of
    numbers and of arrays of them, JSON length of other nested values."""
    total: Column = F.lit(0).cast("long")
    for field in df.schema.fields:
        ref = F.col("`" + field.name.replace("`", "``") + "`")
        dtype = field.dataType
        if isinstance(dtype, (StringType, BinaryType)):
            total = total + F.coalesce(F.octet_length(ref), F.lit(0))
        elif isinstance(dtype, ArrayType) and isinstance(dtype.elementType, NumericType):
            total = total + F.greatest(F.size(ref), F.lit(0)) * _fixed_width(dtype.elementType)
        elif isinstance(dtype, (ArrayType, MapType, StructType)):
            total = total + F.coalesce(F.octet_length(F.to_json(F.struct(ref))), F.lit(0))
        else:
            total = total + F.lit(_fixed_width(dtype))
    return total


def has_at_most(df: DataFrame, max_rows: int, max_bytes: int = DEFAULT_BROADCAST_BYTES) -> bool:
    """True when ``df`` holds no more than ``max_rows`` rows and ``max_bytes`` bytes."""
    size = df.select(row_bytes(df).alias("b")).agg(F.count("b").alias("n"), F.sum("b").alias("b")).first()
    return size["n"] <= max_rows and (size["b"] or 0) <= max_bytes


def materialise(df: DataFrame, label: str) -> tuple[DataFrame, int, int]:
    """Write ``df`` as Parquet below the shared checkpoint folder, read it back.

    Returns the re-read DataFrame, its row count and its estimated bytes
    (:func:`row_bytes`).  Both are observed while writing, so no second job
    runs for them.  Like ``checkpoint()`` this
    cuts the lineage, but the input is computed once (a reliable checkpoint
    of an unpersisted plan computes it twice) and the optimiser sees the real
    file size.  Executors lost later re-read the files instead of recomputing.
    """
    spark = df.sparkSession
    path = scratch_path(spark, label)
    seen = Observation(f"{label}-size")
    observed = df.observe(
        seen, F.count(F.lit(1)).alias("rows"), F.coalesce(F.sum(row_bytes(df)), F.lit(0)).alias("bytes")
    )
    observed.write.parquet(path)
    metrics = seen.get
    return spark.read.schema(df.schema).parquet(path), int(metrics["rows"]), int(metrics["bytes"])


def broadcast_if_small(
    df: DataFrame,
    max_rows: int = DEFAULT_BROADCAST_ROWS,
    max_bytes: int = DEFAULT_BROADCAST_BYTES,
) -> tuple[DataFrame, bool]:
    """``(broadcast of df, True)`` when it is within both bounds, else ``(df, False)``.

    The rows, one over the bound at most, are written once to the scratch
    folder with their size observed, and the join reads that copy: the
    dimension itself is computed once, and never read whole beyond the bound.
    """
    copy, rows, size = materialise(df.limit(max_rows + 1), "dimension")
    if rows > max_rows or size > max_bytes:
        return df, False
    return F.broadcast(copy), True
