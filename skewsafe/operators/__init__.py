from skewsafe.operators.aggregate import (
    aggregate_orders,
    aggregate_salted,
    order_list_pages,
    rollup_totals,
    totals_from_pages,
    with_null_order_id,
    with_run_timestamp,
)
from skewsafe.operators.skew import detect_hot_keys, hot_key_list, key_distribution, skew_share

__all__ = [
    "aggregate_orders", "aggregate_salted", "order_list_pages",
    "rollup_totals", "totals_from_pages", "with_null_order_id", "with_run_timestamp",
    "detect_hot_keys", "hot_key_list", "key_distribution", "skew_share",
]
