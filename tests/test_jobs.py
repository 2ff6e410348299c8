"""Composite jobs J1-J4, J8 on generated batches."""

import datetime as dt

from skewsafe.operators.aggregate import aggregate_orders
from skewsafe.plans.jobs import incremental_append, run_all
from skewsafe.sources.generator import second_batch, skewed_orders
from tools.compare import digest

TS = dt.datetime(2024, 1, 15, 12, 0)
SHARED = ["partition_key", "customer_id", "product", "total_amount", "order_count", "date", "avg_amount"]


def _rows(df):
    df = df.select(*SHARED)
    return digest([tuple(r) for r in df.collect()], df.columns)


def test_run_all_and_replayed_append(spark, scratch):
    rows, later = skewed_orders(spark), second_batch(spark)
    out = run_all(rows, later, scratch, since="2024-01-01")
    assert out["v1"].rows == out["v2"].rows == out["v3"].rows == 5989
    assert out["append"].rows == 5989 + 993
    v = aggregate_orders(rows)
    assert _rows(spark.read.parquet(out["v1"].path)) == _rows(v)
    assert out["v3"].reports["top_partitions"].first()["partition_key"] == "SKEWED_KEY"
    assert out["append"].reports["daily_metrics"].count() == 2
    again = incremental_append(later, f"{scratch}/v3", batch_id=1, run_ts=TS)
    assert again.rows == 5989 + 993
