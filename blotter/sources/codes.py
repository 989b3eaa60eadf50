"""Code tables of the incident files, as inline dimensions."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from blotter.sources.inline import inline_table

# Victim descent code and its text, as the incident files use them.
DESCENT_CODES = [
    ("A", "Other Asian"),
    ("B", "Black"),
    ("C", "Chinese"),
    ("D", "Cambodian"),
    ("F", "Filipino"),
    ("G", "Guamanian"),
    ("H", "Hispanic/Latin/Mexican"),
    ("I", "American Indian/Alaskan Native"),
    ("J", "Japanese"),
    ("K", "Korean"),
    ("L", "Laotian"),
    ("O", "Other"),
    ("P", "Pacific Islander"),
    ("S", "Samoan"),
    ("U", "Hawaiian"),
    ("V", "Vietnamese"),
    ("W", "White"),
    ("X", "Unknown"),
    ("Z", "Asian Indian"),
]


def descent_codes(spark: SparkSession) -> DataFrame:
    """Columns ``Vict Descent`` and ``Vict Descent text``, one row per code."""
    return inline_table(spark, DESCENT_CODES, ["Vict Descent", "Vict Descent text"])
