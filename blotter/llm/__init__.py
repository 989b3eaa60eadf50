"""Operators for large-scale training-data pipelines.

Nothing else in the library imports this sub-package; it may import general
helpers (session, scratch folders).  One module per operator, ``queries``
registers them, ``sql`` holds the oracle SQL.
"""
