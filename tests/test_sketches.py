"""Sketches: hot keys without a pass over the join, distinct counts merged over batches."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from skewsafe.operators.aggregate import aggregate_orders
from skewsafe.operators.sketches import daily_sketches, heavy_keys, heavy_sketch, merged_estimates, tracked_items
from skewsafe.operators.skew import hot_key_list
from skewsafe.plans.inspect import count_nodes, read_schemas
from skewsafe.plans.jobs import TARGET_BATCHED, pipeline_v3
from skewsafe.sinks.writers import read_target
from skewsafe.sources.tables import orders_from_tpch, partition_keys_from_tpch
from tests.conftest import SF_SMALL
from tools.compare import digest

TS = dt.datetime(2024, 1, 15, 12, 0)


def test_hot_keys_among_many_cold_ones(spark):
    """A third, a tenth and a fiftieth of the rows; the rest is 70,000 keys of their own."""
    rows = spark.range(130_000).select(
        F.expr("CASE WHEN id % 30 < 10 THEN 'third' WHEN id % 30 < 13 THEN 'tenth' WHEN id % 50 = 49 THEN 'fiftieth' "
               "ELSE concat('k', id) END").alias("key"))
    sketch = heavy_sketch(rows, "key", 0.05)
    assert heavy_keys(sketch, 0.05) == ["third", "tenth"]
    assert heavy_keys(heavy_sketch(rows, "key", 0.01), 0.01) == ["third", "tenth", "fiftieth"]
    assert heavy_keys(sketch, 0.05) == hot_key_list(rows, "key", 0.05)


def test_sketches_of_batches_merge(spark):
    a = spark.range(10_000).select(F.when(F.col("id") % 2 == 0, "x").otherwise(F.concat(F.lit("a"), "id")).alias("key"))
    b = spark.range(90_000).select(F.when(F.col("id") % 3 == 0, "y").otherwise(F.concat(F.lit("b"), "id")).alias("key"))
    both = heavy_sketch(a, "key", 0.05).unionByName(heavy_sketch(b, "key", 0.05))
    assert heavy_keys(both, 0.05) == ["y", "x"]
    assert heavy_keys(both, 0.2) == ["y"]  # x holds half of its batch, a twentieth of all rows


def test_no_keys_null_keys_and_wrong_shares(spark):
    empty = spark.createDataFrame([], "key string")
    assert heavy_keys(heavy_sketch(empty, "key", 0.1), 0.1) == []
    nulls = spark.createDataFrame([(None,)] * 9 + [("a",)], "key string")
    assert heavy_keys(heavy_sketch(nulls, "key", 0.1), 0.1) == ["a"]
    assert heavy_keys(heavy_sketch(nulls, "key", 0.5), 0.5) == []
    for share in (0, 1.5):
        with pytest.raises(ValueError):
            tracked_items(share)


def test_v3_finds_its_keys_from_one_column(spark, scratch):
    source = partition_keys_from_tpch(spark, SF_SMALL)
    plan = heavy_sketch(source, "partition_key", 0.05)
    assert count_nodes(plan, "BroadcastHashJoin") == count_nodes(plan, "SortMergeJoin") == 0
    assert read_schemas(plan) == ["struct<l_orderkey:bigint>"] or read_schemas(plan) == ["struct<l_orderkey:int>"]
    rows = orders_from_tpch(spark, SF_SMALL)
    out = pipeline_v3(rows, scratch + "/v3", min_share=0.05, run_ts=TS, key_source=source)
    assert out.hot_keys == ["SKEWED_KEY"]
    a, b = read_target(spark, out.path, TARGET_BATCHED), aggregate_orders(rows)
    a = a.select(*b.columns)
    assert digest([tuple(r) for r in a.collect()], a.columns) == digest([tuple(r) for r in b.collect()], b.columns)


def test_distinct_counts_merge_over_days_and_batches(spark):
    rows = spark.range(200_000).select((F.col("id") % 50_000).alias("who"), F.concat(F.lit("d"), F.col("id") % 4).alias("date"))
    parts = [daily_sketches(rows.where(f"id % 3 = {k}"), ["who"]) for k in range(3)]
    stored = parts[0].unionByName(parts[1]).unionByName(parts[2])
    [whole] = merged_estimates(stored, ["who"]).collect()
    assert whole["row_count"] == 200_000 and abs(whole["who_estimate"] - 50_000) <= 1_500
    for r in merged_estimates(stored, ["who"], ["date"]).collect():
        assert r["row_count"] == 50_000 and abs(r["who_estimate"] - 12_500) <= 375
    [none] = merged_estimates(stored.where("false"), ["who"]).collect()
    assert (none["row_count"], none["who_estimate"]) == (0, 0)
