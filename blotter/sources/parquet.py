"""Parquet input and the CSV → Parquet conversion."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import MapType

from blotter.sources.csv import read_csv


def read_parquet(spark: SparkSession, path: str | Sequence[str]) -> DataFrame:
    """Columnar scan; filters and projections applied later reach the reader."""
    return spark.read.parquet(*([path] if isinstance(path, str) else list(path)))


def read_table(spark: SparkSession, data_dir: str, name: str) -> DataFrame:
    """One table of a data folder laid out as ``<dir>/<name>.parquet``, resolved anew on every call."""
    return read_parquet(spark, f"{data_dir.rstrip('/')}/{name}.parquet")


def csv_to_parquet(
    spark: SparkSession,
    source: str | Sequence[str],
    target: str,
    columns: Sequence[str] | None = None,
    *,
    repair_headers: bool = True,
    multiline: bool = False,
    mode: str = "errorifexists",
    partition_by: Mapping[str, Column] | None = None,
    sort_by: Sequence[str | Column] = (),
) -> DataFrame:
    """Convert CSV to Parquet once, return a reader over the result.

    The default mode refuses to overwrite an existing target, as a plain
    ``df.write.parquet`` does.  With ``partition_by`` or ``sort_by`` the rows
    are laid out by :func:`write_clustered`.
    """
    df = read_csv(spark, source, columns, repair_headers=repair_headers, multiline=multiline)
    if partition_by or sort_by:
        return write_clustered(df, target, partition_by or {}, sort_by, mode=mode)
    df.write.mode(mode).parquet(target)
    return read_parquet(spark, target)


def write_clustered(
    df: DataFrame,
    target: str,
    partition_by: Mapping[str, Column],
    sort_by: Sequence[str | Column] = (),
    *,
    mode: str = "errorifexists",
    row_group_bytes: int | None = None,
) -> DataFrame:
    """Write Parquet in folders by the ``partition_by`` columns, each file a range of ``sort_by``; return a reader.

    A later filter on a folder column reads no other folder; one on the first
    sort columns skips files and row groups by their least and greatest values
    (``row_group_bytes`` makes those smaller).  Rows are dealt by sampled
    ranges of folder, sort columns and a hash of the row, so neither a folder
    nor a value holding a large share of the rows is one task; the number of
    files follows from the shuffle partitions, which adaptive execution joins
    up to its advisory size.  Folder columns are added at the end; a name the
    rows already have raises.
    """
    taken = {c.lower() for c in df.columns}
    if clash := [c for c in partition_by if c.lower() in taken]:
        raise ValueError(f"columns {clash} are in the rows already")
    tagged = df.withColumns(dict(partition_by)) if partition_by else df
    hashed = [F.col("`" + f.name.replace("`", "``") + "`") for f in df.schema.fields if not isinstance(f.dataType, MapType)]
    order = [*partition_by, *sort_by]
    laid = tagged.repartitionByRange(*order, F.xxhash64(*hashed)).sortWithinPartitions(*order)
    writer = laid.write.mode(mode)
    if row_group_bytes:
        writer = writer.option("parquet.block.size", row_group_bytes)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(target)
    return df.sparkSession.read.schema(tagged.schema).parquet(target)
