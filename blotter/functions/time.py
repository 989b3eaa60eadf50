"""Date and time-of-day parsing.

Spark 4 runs with ANSI mode on, where ``to_timestamp`` raises on a bad
value.  Incident files do hold bad values, so every parser here is the
``try_`` form: a value that does not parse becomes NULL.  Parsed values are
wall-clock timestamps without zone (``TIMESTAMP_NTZ``), the type Parquet
readers give for plain timestamps.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from blotter.functions._cols import ColumnOrName, as_col

# Fixed formats of the incident files.
REPORT_FORMAT = "MM/dd/yyyy hh:mm:ss a"   # e.g. 08/23/2020 12:00:00 AM
HHMM_FORMAT = "HHmm"                      # e.g. 2245


def parse_timestamp(c: ColumnOrName, fmt: str = REPORT_FORMAT) -> Column:
    """Text → ``TIMESTAMP_NTZ`` by a datetime pattern; unparsable → NULL."""
    return F.try_to_timestamp(as_col(c), F.lit(fmt)).cast("timestamp_ntz")


def parse_hhmm(c: ColumnOrName) -> Column:
    """``'HHmm'`` text → time of day on 1970-01-01; unparsable → NULL."""
    return parse_timestamp(c, HHMM_FORMAT)


def format_timestamp(c: ColumnOrName, fmt: str = REPORT_FORMAT) -> Column:
    """Timestamp → text in a datetime pattern."""
    return F.date_format(as_col(c), fmt)


def hhmm_text(c: ColumnOrName) -> Column:
    """Timestamp → its time of day as ``'HHmm'`` text."""
    return F.date_format(as_col(c), HHMM_FORMAT)


def hhmm_number(c: ColumnOrName) -> Column:
    """Timestamp → time of day as the number ``hour * 100 + minute``."""
    ts = as_col(c)
    return (F.hour(ts) * 100 + F.minute(ts)).cast("int")


def year_of(c: ColumnOrName) -> Column:
    return F.year(as_col(c))


def month_of(c: ColumnOrName) -> Column:
    return F.month(as_col(c))
