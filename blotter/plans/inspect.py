"""Reading physical plans: which join strategy did Spark pick?"""

from __future__ import annotations

import contextlib
import io
import re

from pyspark.sql import DataFrame, SparkSession

JOIN_NODES = (
    "BroadcastHashJoin",
    "ShuffledHashJoin",
    "SortMergeJoin",
    "BroadcastNestedLoopJoin",
    "CartesianProduct",
)
_JOIN_RE = re.compile(r"\b(" + "|".join(JOIN_NODES) + r")\b")


def plan_text(df: DataFrame, mode: str = "formatted") -> str:
    """The text ``df.explain(mode)`` prints, returned instead of printed."""
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain(mode=mode)
    return buf.getvalue()


def physical_section(df: DataFrame) -> str:
    """The physical operator tree (no per-node details).

    After an adaptive query has run, only its final plan is returned.
    """
    text = plan_text(df, "simple").split("== Physical Plan ==", 1)[-1]
    if "== Final Plan ==" in text:
        text = text.split("== Final Plan ==", 1)[1].split("== Initial Plan ==", 1)[0]
    return text


def join_strategies(df: DataFrame) -> list[str]:
    """Join operators of the physical plan, outermost first."""
    return _JOIN_RE.findall(physical_section(df))


def has_node(df: DataFrame, node: str) -> bool:
    return node in physical_section(df)


def schema_listing(spark: SparkSession, df: DataFrame) -> DataFrame:
    """One row per column of ``df``: (column_name, data_type), in column order."""
    rows = [(i, name, dtype) for i, (name, dtype) in enumerate(df.dtypes)]
    listing = spark.createDataFrame(rows, "position int, column_name string, data_type string")
    return listing.orderBy("position").drop("position")
