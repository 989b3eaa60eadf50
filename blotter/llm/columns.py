"""Small helpers shared by the operators: safe column references, single evaluation."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def ref(name: str) -> Column:
    """A column by its exact name, dots and back-ticks included."""
    return F.col("`" + name.replace("`", "``") + "`")


def free_name(df: DataFrame, wanted: str) -> str:
    """``wanted``, prefixed until no column of ``df`` has that name (case ignored)."""
    taken = {c.lower() for c in df.columns}
    while wanted.lower() in taken:
        wanted = "_" + wanted
    return wanted


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` computed once per row.

    The optimiser may inline a projected expression into a lambda, where it
    would run once per element; a lambda variable is never inlined.
    """
    return F.element_at(F.transform(F.array(value), body), 1)


def text_or_empty(name: str) -> Column:
    """The text column with null as the empty string."""
    return F.coalesce(ref(name).cast("string"), F.lit(""))


# White space of the word definition: space and the five ASCII controls \t..\r.
SPACES = " \t\n\x0b\x0c\r"
SPACE_RUN = r"[\x20\x09-\x0D]+"


def words(text: Column) -> Column:
    """Words ``[^\\x20\\x09-\\x0D]+`` of a text, in order."""
    return F.array_remove(F.split(text, SPACE_RUN), "")
