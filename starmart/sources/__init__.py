from starmart.sources.files import (
    TableRegistry,
    lookup_keys,
    read_feed_csv,
    read_run,
    read_table,
    register_view,
    tpch_registry,
    write_table,
)
from starmart.sources.fixtures import orders_feed

__all__ = [
    "TableRegistry", "lookup_keys", "read_feed_csv", "read_run", "read_table",
    "register_view", "tpch_registry", "write_table", "orders_feed",
]
