"""Connected components of a graph given as an edge table.

Alternating large-star and small-star steps: every step is a grouped minimum
and a join, and the result is written to the shared scratch folder, which
also cuts the lineage.  A vertex with very many neighbours is one row of the
minima and many rows of a join side, which adaptive execution splits; nothing
is gathered per vertex, and only two numbers a round reach the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Observation

from blotter.session import scratch_path


def _written(edges: DataFrame, label: str) -> tuple[DataFrame, tuple]:
    spark = edges.sparkSession
    path = scratch_path(spark, label)
    seen = Observation(label)
    edges.observe(
        seen,
        F.count(F.lit(1)).alias("n"),
        F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("h"),
    ).write.parquet(path)
    got = seen.get
    return spark.read.schema("u long, v long").parquet(path), (got["n"], got["h"])


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.union(edges.select("v", "u"))
    least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    return both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))


def _small_star(edges: DataFrame) -> DataFrame:
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    moved = edges.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.union(least.select("u", F.col("m").alias("v")))


def components(edges: DataFrame) -> DataFrame:
    """(vertex, component) for every vertex of an edge; the component is its least vertex.

    ``edges`` has two long columns u and v; loops, repeated and mirrored edges
    do no harm, edges with a null end are left out.  Without edges the result
    is empty.
    """
    directed = edges.toDF("u", "v").where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    current, state = _written(directed.distinct(), "edges")
    while state[0]:
        step = _small_star(_large_star(current).distinct()).distinct()
        current, after = _written(step, "edges")
        if after == state:
            break
        state = after
    roots = current.select("v").distinct()
    return current.select(F.col("u").alias("vertex"), F.col("v").alias("component")).union(
        roots.select("v", "v")
    )
