"""Sums below a cent, non-finite amounts, batches and tables that are really replaced."""

import datetime as dt
import math

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from skewsafe.operators.aggregate import aggregate_orders, aggregate_salted, order_list_pages, totals_from_pages
from skewsafe.plans.jobs import TARGET_BATCHED, incremental_append, pipeline_v3
from skewsafe.schemas import ORDERS, TARGET, with_field
from skewsafe.sinks.writers import read_target, write_batch

TS = dt.datetime(2024, 1, 15, 12, 0)


def orders(spark, rows):
    """Rows of (customer, id, amount, day)."""
    return spark.createDataFrame([("k", c, i, a, "p", d) for c, i, a, d in rows], ORDERS)


def total(df):
    return df.first()["total_amount"]


@pytest.mark.parametrize("forms", [aggregate_orders, lambda df: aggregate_salted(df, None, 7),
                                   lambda df: totals_from_pages(order_list_pages(df, 10, with_sums=True))])
def test_parts_below_a_cent_count(spark, forms):
    df = orders(spark, [("c", i, 0.004, "2024-01-01") for i in range(1000)])
    assert total(forms(df)) == 4.0
    df = orders(spark, [("c", i, 10 + i / 997, "2024-01-01") for i in range(500)])
    assert math.isclose(total(forms(df)), math.fsum(10 + i / 997 for i in range(500)), rel_tol=1e-12)
    inf, nan = float("inf"), float("nan")
    for extra, check in [([inf], lambda x: x == inf), ([-inf, 1.0], lambda x: x == -inf), ([nan], math.isnan),
                         ([inf, -inf], math.isnan), ([None], lambda x: x == 4.0)]:
        more = [("c", 5000 + i, a, "2024-01-01") for i, a in enumerate(extra)]
        base = [("c", i, 0.004, "2024-01-01") for i in range(1000 - len([a for a in extra if a == 1.0]))]
        assert check(total(forms(orders(spark, base + more))))


BATCHED = with_field(TARGET, "batch_id", T.LongType())


def stored(spark, path):
    return sorted((r["batch_id"], r["date"]) for r in read_target(spark, path, BATCHED).collect())


def agg(spark, days):
    df = orders(spark, [(f"c{n}", n, 1.0, d) for n, d in enumerate(days)])
    return aggregate_orders(df).withColumn("processed_timestamp", F.lit(TS))


def test_replay_with_fewer_days_and_empty_replay(spark, scratch):
    write_batch(agg(spark, ["2024-01-01"]), scratch, 0)
    write_batch(agg(spark, ["2024-01-01", "2024-01-02"]), scratch, 1)
    write_batch(agg(spark, ["2024-01-02"]), scratch, 1)
    assert stored(spark, scratch) == [(0, "2024-01-01"), (1, "2024-01-02")]
    write_batch(agg(spark, ["2024-01-02"]).where("false"), scratch, 1)
    assert stored(spark, scratch) == [(0, "2024-01-01")]


def test_v3_leaves_only_its_own_rows(spark, scratch):
    rows = orders(spark, [("a", 1, 1.0, "2024-01-01"), ("b", 2, 1.0, "2024-01-05")])
    pipeline_v3(rows, scratch, hot_keys=[], run_ts=TS)
    incremental_append(orders(spark, [("z", 9, 1.0, "2024-02-01")]), scratch, 1, TS)
    assert read_target(spark, scratch, TARGET_BATCHED).count() == 3
    pipeline_v3(rows, scratch, since="2024-01-03", hot_keys=[], run_ts=TS)
    assert [r["customer_id"] for r in read_target(spark, scratch, TARGET_BATCHED).collect()] == ["b"]


def test_future_dates_default_to_today(spark):
    from skewsafe.operators.quality import anomalies

    today = spark.sql("SELECT CAST(current_date() AS STRING) AS d, CAST(current_date() + 2 AS STRING) AS t").first()
    v = aggregate_orders(orders(spark, [("a", 1, 1.0, "2000-01-01"), ("b", 2, -1.0, today["d"]), ("c", 3, 1.0, today["t"])]))
    assert {r["check_type"]: r["anomaly_count"] for r in anomalies(v).collect()} == {"Negative amounts": 1, "Future dates": 1}
