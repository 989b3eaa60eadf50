"""Column expressions (all JVM-side except the explicit pandas variant)."""

from blotter.functions.daypart import day_segment, day_segment_pandas
from blotter.functions.geodesy import with_geodesic_km
from blotter.functions.numeric import currency_text, currency_to_int, int_or_zero, to_int
from blotter.functions.text import contains, join_key, replace_text, token
from blotter.functions.time import (
    format_timestamp,
    hhmm_number,
    hhmm_text,
    month_of,
    parse_hhmm,
    parse_timestamp,
    year_of,
)

__all__ = [
    "contains",
    "currency_text",
    "currency_to_int",
    "day_segment",
    "day_segment_pandas",
    "format_timestamp",
    "hhmm_number",
    "hhmm_text",
    "int_or_zero",
    "join_key",
    "month_of",
    "parse_hhmm",
    "parse_timestamp",
    "replace_text",
    "to_int",
    "token",
    "with_geodesic_km",
    "year_of",
]
