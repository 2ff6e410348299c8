from skewsafe.sources.generator import generate_orders, second_batch, skewed_orders
from skewsafe.sources.tables import (
    TABLES,
    filter_since,
    orders_from_tpch,
    plant_faults,
    preview,
    read_staged_batch,
    read_table,
    table_path,
)

__all__ = [
    "TABLES", "filter_since", "generate_orders", "orders_from_tpch", "plant_faults",
    "preview", "read_staged_batch", "read_table", "second_batch", "skewed_orders", "table_path",
]
