"""Data-quality checks."""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skewsafe.functions.columns import as_date, distinct_count, exact_avg, null_flag
from skewsafe.operators.skew import skew_share

# The labels of the two anomaly checks.
NEGATIVE_AMOUNTS = "Negative amounts"
FUTURE_DATES = "Future dates"


def table_summary(v: DataFrame, approx: bool = False) -> DataFrame:
    """Rows, distinct keys, mean group total (J6a). One row, also when empty."""
    return v.agg(
        F.count(F.lit(1)).alias("total_records"),
        distinct_count("partition_key", approx).alias("unique_keys"),
        exact_avg("total_amount").alias("avg_amount"),
    )


def completeness(rows: DataFrame, approx: bool = False) -> DataFrame:
    """Per day over order rows: rows, distinct customers and keys, NULL amounts.

    Runs on order rows (the aggregated table has no ``amount``). The two
    distinct counts share one scan: Spark expands each row once per
    distinct column and de-duplicates map-side before the shuffle.
    ``approx=True`` uses HyperLogLog++ sketches instead (no expand).
    """
    return (
        rows.groupBy("date")
        .agg(
            F.count(F.lit(1)).alias("total_records"),
            distinct_count("customer_id", approx).alias("unique_customers"),
            distinct_count("partition_key", approx).alias("unique_partitions"),
            F.sum(null_flag("amount")).cast("bigint").alias("null_amounts"),
        )
        .orderBy("date")
    )


def skew(v: DataFrame, key: str = "partition_key") -> DataFrame:
    """Share of groups per key."""
    return skew_share(v, key)


def anomalies(v: DataFrame, as_of: str | _dt.date | None = None) -> DataFrame:
    """Negative totals and future dates as two labelled rows.

    One scan: both counts come from one global aggregate, then ``stack``
    turns the single row into two. ``as_of`` defaults to today.
    """
    limit = F.lit(str(as_of)).cast("date") if as_of is not None else F.current_date()
    counts = v.agg(
        F.count_if(F.col("total_amount") < 0).alias("negative"),
        F.count_if(as_date("date") > limit).alias("future"),
    )
    return counts.select(
        F.expr(f"stack(2, '{NEGATIVE_AMOUNTS}', negative, '{FUTURE_DATES}', future) AS (check_type, anomaly_count)")
    )
