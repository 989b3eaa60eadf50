"""Small dimension tables written in code.

They are built as a SQL ``VALUES`` relation with bound parameters, which
plans as a ``LocalTableScan`` whose size the optimiser knows, so joins
against it broadcast the literal rows instead of shuffling the facts.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession


def inline_table(
    spark: SparkSession,
    rows: Sequence[Sequence[object]],
    columns: Sequence[str],
) -> DataFrame:
    """A literal table; values are bound as parameters, never spliced as text."""
    if not rows:
        raise ValueError("an inline table needs at least one row")
    width = len(columns)
    args: dict[str, object] = {}
    tuples = []
    for r, row in enumerate(rows):
        if len(row) != width:
            raise ValueError(f"row {r} has {len(row)} values, expected {width}")
        names = []
        for c, value in enumerate(row):
            key = f"v{r}_{c}"
            args[key] = value
            names.append(f":{key}")
        tuples.append("(" + ", ".join(names) + ")")
    aliases = ", ".join(f"`{name}`" for name in columns)
    query = f"SELECT * FROM VALUES {', '.join(tuples)} AS t({aliases})"
    return spark.sql(query, args=args)
