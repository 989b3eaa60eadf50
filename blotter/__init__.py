"""blotter — incident-style analytics as lazy PySpark DataFrame functions.

Every public function takes and returns ``DataFrame`` objects (or ``Column``
expressions) and pulls no table rows to the driver, so Catalyst sees one plan
per question: filters reach the Parquet scan, columns are pruned, partial
aggregation runs map-side and AQE picks the join strategy at run time.

Sub-packages
------------
sources    CSV / Parquet readers and writers, inline dimension tables
functions  column expressions: time parsing, casts, currency, day parts, geodesy
operators  filters, projections, joins, aggregates, windows, ordering, unions
plans      plan inspection and size guards for broadcast decisions
"""

from blotter.session import build_session, scratch_path

__all__ = ["build_session", "scratch_path"]
