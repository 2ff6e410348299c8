"""Column expressions shared by the operators."""

from skewsafe.functions.columns import (
    as_date,
    day_string,
    distinct_count,
    exact_avg,
    exact_part,
    from_parts,
    money_sum,
    null_flag,
    percent,
    ratio,
    run_timestamp,
    salt,
    special_part,
)

__all__ = [
    "as_date", "day_string", "distinct_count", "exact_avg", "exact_part", "from_parts", "money_sum", "null_flag",
    "percent", "ratio", "run_timestamp", "salt", "special_part",
]
