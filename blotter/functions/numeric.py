"""Text → number conversions that never raise."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from blotter.functions._cols import ColumnOrName, as_col


def to_int(c: ColumnOrName) -> Column:
    """Text → int; leading zeros vanish (``'07'`` → 7); not a number → NULL."""
    return as_col(c).try_cast("int")


def int_or_zero(c: ColumnOrName) -> Column:
    """Empty or missing text → 0, otherwise the int value (NULL if not a number)."""
    text = as_col(c)
    return F.when(text.isNull() | (text == ""), F.lit(0)).otherwise(text.try_cast("int"))


def currency_to_long(c: ColumnOrName) -> Column:
    """Like :func:`currency_to_int`, for amounts beyond the int range."""
    text = F.regexp_replace(as_col(c), r"^[^0-9+-]", "")
    return F.replace(text, F.lit(","), F.lit("")).try_cast("bigint")


def currency_to_int(c: ColumnOrName) -> Column:
    """Currency text → int: drop a leading currency symbol and the thousands commas.

    ``'$1,234,567'`` → 1234567, ``'1,234'`` → 1234; empty or malformed text → NULL.
    """
    text = F.regexp_replace(as_col(c), r"^[^0-9+-]", "")
    return F.replace(text, F.lit(","), F.lit("")).try_cast("int")


def currency_text(c: ColumnOrName, symbol: str = "$") -> Column:
    """Whole number → currency text with thousands commas (``1234`` → ``'$1,234'``)."""
    return F.concat(F.lit(symbol), F.format_number(as_col(c), 0))
