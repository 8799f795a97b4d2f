from paywatch.sources.adapters import transactions_from_events, transactions_from_orders
from paywatch.sources.tables import (
    read_features,
    read_importances,
    read_lookup_table,
    read_raw,
    read_scored,
    read_table,
    register_transactions,
    write_lookup_table,
    write_table,
)

__all__ = [
    "read_features",
    "read_importances",
    "read_lookup_table",
    "read_raw",
    "read_scored",
    "read_table",
    "register_transactions",
    "transactions_from_events",
    "transactions_from_orders",
    "write_lookup_table",
    "write_table",
]
