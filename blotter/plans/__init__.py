"""Plan inspection and broadcast size guards."""

from blotter.plans.guards import (
    DEFAULT_BROADCAST_BYTES,
    DEFAULT_BROADCAST_ROWS,
    broadcast_if_small,
    has_at_most,
    materialise,
    row_bytes,
)
from blotter.plans.inspect import has_node, join_strategies, physical_section, plan_text, schema_listing
from blotter.plans.ledger import RejectLedger

__all__ = [
    "DEFAULT_BROADCAST_BYTES",
    "DEFAULT_BROADCAST_ROWS",
    "RejectLedger",
    "broadcast_if_small",
    "has_at_most",
    "has_node",
    "materialise",
    "join_strategies",
    "physical_section",
    "plan_text",
    "row_bytes",
    "schema_listing",
]
