"""Counts of values that parsing lost, observed by the job that gives the answer."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F


class RejectLedger:
    """Counts, per cause, of values that were there before parsing and are NULL after it.

    ``watch`` returns the rows with the counting attached; whatever action runs
    over them first fills the ledger, so no second pass over the data is made.
    Rows must reach the action whole: put ``watch`` before filters.  (A task run
    again after its output was lost may count its rows twice, as with any
    observation.)
    """

    def __init__(self, name: str = "rejects") -> None:
        self._seen = Observation(name)
        self._causes: list[str] = []

    def watch(self, df: DataFrame, parsed: Mapping[str, tuple[Column, Column]]) -> DataFrame:
        """``parsed`` names each cause: (the value before, the value after parsing)."""
        if self._causes:
            raise ValueError("a ledger watches one set of rows")
        if not parsed or "rows" in parsed:
            raise ValueError("name at least one cause, and none of them 'rows'")
        self._causes = list(parsed)
        lost = [
            F.count(F.when(before.isNotNull() & after.isNull(), 1)).alias(cause) for cause, (before, after) in parsed.items()
        ]
        return df.observe(self._seen, F.count(F.lit(1)).alias("rows"), *lost)

    def counts(self) -> dict[str, int]:
        """``rows`` and the lost values per cause; waits for the action."""
        got = self._seen.get
        return {name: int(got[name]) for name in ("rows", *self._causes)}
