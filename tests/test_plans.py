"""Plan assertions: pushdown, pruning, aggregate strategy, top-k, no single-partition window."""

import pytest
from pyspark.sql import functions as F

from skewsafe.operators import reports
from skewsafe.operators.aggregate import aggregate_orders, aggregate_salted
from skewsafe.operators.skew import skew_share
from skewsafe.plans.inspect import count_nodes, plan_text, pushed_filters, read_schemas
from skewsafe.schemas import TARGET
from skewsafe.sinks.writers import read_target, write_day_partitioned
from skewsafe.sources.tables import orders_from_tpch
from tests.conftest import SF_SMALL


def test_date_bound_reaches_orders_scan(spark):
    df = orders_from_tpch(spark, SF_SMALL, since="1998-01-01", until="1999-01-01")
    filters = " ".join(pushed_filters(df))
    assert "GreaterThanOrEqual(o_orderdate" in filters and "LessThan(o_orderdate" in filters


def test_scans_read_only_needed_columns(spark):
    schemas = read_schemas(aggregate_orders(orders_from_tpch(spark, SF_SMALL)))
    assert "struct<l_orderkey:bigint,l_partkey:bigint,l_extendedprice:double>" in schemas
    assert "struct<o_orderkey:bigint,o_custkey:bigint,o_orderdate:timestamp_ntz>" in schemas


def test_salted_aggregate_is_four_hash_aggregates(spark):
    df = aggregate_salted(orders_from_tpch(spark, SF_SMALL), ["SKEWED_KEY"], 10)
    assert count_nodes(df, "HashAggregate") == 4
    assert count_nodes(df, "SortAggregate") == 0
    shuffles = count_nodes(df, "Exchange")  # BroadcastExchange is a different node name
    assert shuffles in (2, 4)  # two aggregate shuffles (+2 when the join is sort-merge)


def test_plain_aggregate_has_partial_step(spark):
    text = plan_text(aggregate_orders(orders_from_tpch(spark, SF_SMALL)))
    assert "partial_sum(CASE WHEN" in text and "partial_count(1)" in text
    assert "SortAggregate" not in text


def test_top_k_is_take_ordered(spark):
    v = aggregate_orders(orders_from_tpch(spark, SF_SMALL))
    assert count_nodes(reports.top_customers(v), "TakeOrderedAndProject") == 1
    assert count_nodes(reports.top_partitions(v), "TakeOrderedAndProject") == 1


def test_skew_share_avoids_single_partition_window(spark):
    text = plan_text(skew_share(aggregate_orders(orders_from_tpch(spark, SF_SMALL))))
    assert "Window" not in text
    assert "Subquery" in text


def test_day_partition_filter_prunes(spark, scratch):
    v = aggregate_orders(orders_from_tpch(spark, SF_SMALL, since="2000-01-01"))
    write_day_partitioned(v.withColumn("processed_timestamp", F.current_timestamp()), scratch)
    back = read_target(spark, scratch, TARGET).where("date = '2000-06-01'")
    assert "PartitionFilters: [isnotnull(date" in plan_text(back)


def test_detection_sample_is_taken_before_the_join(spark):
    from skewsafe.operators.skew import hot_key_list

    sample = orders_from_tpch(spark, SF_SMALL, sample_fraction=0.05)
    text = plan_text(sample, "simple")
    join_at = text.index("Join")
    assert text.index("Sample", join_at) > join_at  # Sample sits below the join, over the lineitem scan
    assert hot_key_list(sample, "partition_key", 0.05) == ["SKEWED_KEY"]


@pytest.mark.parametrize("op", ["aggregate_orders", "order_list_pages"])
def test_hot_join_key_is_split_by_aqe(spark, scratch, op):
    """A third of the line items on one order key: AQE splits that key's sort-merge join partition.

    The pages group by the join key, so the split costs an extra shuffle;
    the session's ``forceOptimizeSkewedJoin`` makes AQE take it.
    """
    from skewsafe.operators import aggregate
    from skewsafe.session import conf_override

    li = spark.read.parquet(f"{SF_SMALL}/lineitem.parquet")
    hot = li.agg(F.min("l_orderkey")).first()[0]
    li.withColumn("l_orderkey", F.when(F.pmod(F.xxhash64("l_partkey", "l_linenumber"), F.lit(3)) == 0, F.lit(hot))
                  .otherwise(F.col("l_orderkey"))).repartition(4).write.parquet(f"{scratch}/lineitem.parquet")
    spark.read.parquet(f"{SF_SMALL}/orders.parquet").write.parquet(f"{scratch}/orders.parquet")
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "4KB",
    }
    with conf_override(spark, settings):
        rows = orders_from_tpch(spark, scratch)
        v = getattr(aggregate, op)(rows)
        total = sum(r["order_count"] for r in v.collect())
        final = plan_text(v, "simple")
    assert total == li.count()
    assert "SortMergeJoin(skew=true)" in final


def test_id_pages_are_counted_in_partitions_of_bounded_size(spark):
    """No task counts the ids of all it scanned: AQE sizes the partitions below the first aggregate."""
    from skewsafe.operators.aggregate import order_list_pages

    pages = order_list_pages(orders_from_tpch(spark, SF_SMALL))
    text = plan_text(pages, "simple")
    assert "REBALANCE_PARTITIONS_BY_COL" in text
    assert text.rindex("HashAggregate") < text.index("REBALANCE_PARTITIONS_BY_COL") < text.index("Join")


def test_totals_from_stored_pages_skip_the_id_lists(spark, scratch):
    from skewsafe.operators.aggregate import order_list_pages, totals_from_pages

    order_list_pages(orders_from_tpch(spark, SF_SMALL), with_sums=True).write.parquet(scratch)
    schemas = " ".join(read_schemas(totals_from_pages(spark.read.parquet(scratch))))
    assert "page_sum" in schemas and "order_list" not in schemas


def test_staged_arrival_reads_only_its_folder(spark, scratch):
    from skewsafe.sinks.writers import stage_rows
    from skewsafe.sources.tables import read_staged_batch

    rows = orders_from_tpch(spark, SF_SMALL)
    stage_rows(rows, scratch, F.when(F.col("date") < "1996-01-01", 0).otherwise(1))
    later = read_staged_batch(spark, scratch, 1)
    assert "PartitionFilters: [isnotnull(arrival" in plan_text(later) and "(arrival#" in plan_text(later)
    assert later.count() + read_staged_batch(spark, scratch, 0).count() == rows.count()
    assert later.where("date < '1996-01-01'").count() == 0


def test_salted_without_hot_keys_is_one_shuffle(spark):
    df = aggregate_salted(orders_from_tpch(spark, SF_SMALL), [], 10)
    assert count_nodes(df, "HashAggregate") == 2
