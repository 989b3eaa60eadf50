"""String helpers: composite keys, contains, split and replace."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from blotter.functions._cols import ColumnOrName, as_col


def join_key(*cols: ColumnOrName, sep: str = " ") -> Column:
    """Composite key text ``a<sep>b``; any NULL part makes the key NULL."""
    parts: list[Column] = []
    for i, c in enumerate(cols):
        if i:
            parts.append(F.lit(sep))
        parts.append(as_col(c).cast("string"))
    return F.concat(*parts)


def contains(c: ColumnOrName, needle: str) -> Column:
    """Case-sensitive substring test; NULL text → NULL (row dropped by filter)."""
    return as_col(c).contains(needle)


def token(c: ColumnOrName, sep: str, index: int = 1) -> Column:
    """The ``index``-th (1-based) piece of the text split on a literal separator."""
    return F.split_part(as_col(c), F.lit(sep), F.lit(index))


def replace_text(c: ColumnOrName, old: str, new: str) -> Column:
    """Replace every literal occurrence of ``old`` by ``new``."""
    return F.replace(as_col(c), F.lit(old), F.lit(new))
