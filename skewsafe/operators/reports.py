"""Reports over the aggregated table (J5a-J5e).

Top-k reports end in ``orderBy(...).limit(k)``, which plans as
``TakeOrderedAndProject``: each task keeps k rows, no global sort. Every
ordering ends with the key so ties are stable.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skewsafe.functions.columns import distinct_count, exact_avg, money_sum
from skewsafe.operators.exact import exact_totals
from skewsafe.operators.skew import key_distribution


def partition_distribution(v: DataFrame, key: str = "partition_key") -> DataFrame:
    """Groups per key, largest first."""
    return key_distribution(v, key).orderBy(F.desc("record_count"), F.col(key))


def top_partitions(v: DataFrame, n: int = 10, key: str = "partition_key") -> DataFrame:
    """Top ``n`` keys by group count, with the mean group total."""
    return (
        v.groupBy(key)
        .agg(F.count(F.lit(1)).alias("record_count"), exact_avg("total_amount").alias("avg_total_amount"))
        .orderBy(F.desc("record_count"), F.col(key))
        .limit(n)
    )


def total_rows(v: DataFrame) -> DataFrame:
    """Row count as a one-row frame."""
    return v.agg(F.count(F.lit(1)).alias("total"))


def top_customers(v: DataFrame, n: int = 10) -> DataFrame:
    """Top ``n`` customers by spend (J5d). ``transaction_count`` counts groups."""
    return (
        v.groupBy("customer_id")
        .agg(money_sum("total_amount").alias("total_spent"), F.count(F.lit(1)).alias("transaction_count"))
        .orderBy(F.desc("total_spent"), F.col("customer_id"))
        .limit(n)
    )


def daily_metrics(v: DataFrame, with_avg: bool | str = True, approx: bool = False) -> DataFrame:
    """Per day: distinct customers, revenue, mean of group averages (J5e).

    ``avg_order_value`` averages the groups' ``avg_amount`` unweighted, as
    the reference does: the exact sum of the unrounded quotients, rounded once,
    over their number; ``true_avg_order_value`` (``with_avg='both'``) is
    revenue over orders. ``approx=True`` counts customers with HyperLogLog++.
    """
    aggs = [
        distinct_count("customer_id", approx).alias("unique_customers"),
        money_sum("total_amount").alias("daily_revenue"),
    ]
    if with_avg == "both":
        aggs.append((F.sum("total_amount") / F.sum("order_count")).alias("true_avg_order_value"))
    daily = v.groupBy("date").agg(*aggs)
    if with_avg:
        # Days, not groups, are joined; both sides read the same exchange of the groups.
        means = exact_totals(v, ["date"], "avg_amount", extra={"_n": (F.count("avg_amount"), "sum")})
        means = means.select(F.col("date").alias("_date"), (F.col("total") / F.col("_n")).alias("avg_order_value"))
        daily = daily.join(means, F.col("date").eqNullSafe(F.col("_date"))).drop("_date")
    columns = [c for c in ("date", "unique_customers", "daily_revenue", "avg_order_value", "true_avg_order_value") if c in daily.columns]
    return daily.select(*columns).orderBy("date")
