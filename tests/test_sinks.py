"""Sink round trips in a fresh folder."""

import os

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from skewsafe.operators.aggregate import aggregate_orders, with_null_order_id, with_run_timestamp
from skewsafe.schemas import TARGET, TARGET_V3, with_field
from skewsafe.session import local_path
from skewsafe.sinks.writers import (
    append_by_name,
    create_target_tables,
    insert_by_name,
    read_target,
    save_clustered_table,
    staged_publish,
    verify_count,
    write_batch,
    write_clustered,
    write_day_partitioned,
)
from skewsafe.sources.generator import second_batch, skewed_orders
from tools.compare import digest

BATCHED = with_field(TARGET, "batch_id", T.LongType())


def _rows(df):
    return digest([tuple(r) for r in df.collect()], df.columns)


@pytest.fixture(scope="module")
def v(spark):
    return with_run_timestamp(aggregate_orders(skewed_orders(spark).unionByName(second_batch(spark)))).cache()


def test_day_partitions_round_trip(spark, scratch, v):
    write_day_partitioned(v, scratch)
    back = read_target(spark, scratch, TARGET)
    assert _rows(back.select(*v.columns)) == _rows(v)
    assert back.schema["date"].dataType == T.StringType()
    days = sorted(d for d in os.listdir(local_path(scratch)) if d.startswith("date="))
    assert days == ["date=2024-01-15", "date=2024-01-16"]


def test_month_granularity(spark, scratch, v):
    write_day_partitioned(v, scratch, granularity="month")
    back = spark.read.schema(with_field(TARGET, "date_month", T.StringType())).parquet(scratch)
    assert back.select("date_month").distinct().collect()[0][0] == "2024-01"
    assert back.count() == v.count()


def test_clustered_files_are_sorted(spark, scratch, v):
    write_clustered(v, scratch)
    back = read_target(spark, scratch, TARGET).where("date = '2024-01-15'")
    per_file = back.withColumn("f", F.input_file_name()).groupBy("f").agg(
        F.collect_list(F.struct("partition_key", "customer_id")).alias("keys"))
    for row in per_file.collect():
        keys = [(k.partition_key, k.customer_id) for k in row["keys"]]
        assert keys == sorted(keys)


def test_append_by_name_fills_missing_column(spark, scratch, v):
    write_day_partitioned(with_null_order_id(v.where("date = '2024-01-15'")), scratch)
    append_by_name(v.where("date = '2024-01-16'"), scratch, TARGET_V3)
    back = read_target(spark, scratch, TARGET_V3)
    assert back.count() == v.count() == 5989 + 993
    assert back.where("order_id IS NOT NULL").count() == 0


def test_batch_replay_changes_nothing(spark, scratch, v):
    first, later = v.where("date = '2024-01-15'"), v.where("date = '2024-01-16'")
    write_batch(first, scratch, 0)
    write_batch(later, scratch, 1)
    before = _rows(read_target(spark, scratch, BATCHED))
    write_batch(later, scratch, 1)
    assert _rows(read_target(spark, scratch, BATCHED)) == before
    assert verify_count(spark, scratch, BATCHED) == 6982


def test_staged_publish_checks_before_touching_target(spark, scratch, v):
    target, staging = scratch + "/target", scratch + "/staging"
    assert staged_publish(v, target, staging, TARGET, expected_rows=v.count()) == 6982
    with pytest.raises(RuntimeError):
        staged_publish(v.limit(5), target, staging + "2", TARGET, expected_rows=6982)
    assert verify_count(spark, target, TARGET) == 6982


def test_catalog_ddl_and_insert_by_name(spark, v):
    names = create_target_tables(spark, "skewsafe_test", ["t_v1", "t_v2"])
    assert names == ["skewsafe_test.t_v1", "skewsafe_test.t_v2"]
    assert create_target_tables(spark, "skewsafe_test", ["t_v1"]) == ["skewsafe_test.t_v1"]  # idempotent
    spark.sql("CREATE TABLE IF NOT EXISTS skewsafe_test.v3 "
              "(partition_key STRING, customer_id STRING, product STRING, total_amount DOUBLE, "
              "order_count BIGINT, date STRING, processed_timestamp TIMESTAMP, avg_amount DOUBLE, "
              "order_id BIGINT) USING parquet")
    insert_by_name(spark, v.where("date = '2024-01-16'"), "skewsafe_test.v3")
    got = spark.table("skewsafe_test.v3")
    assert got.count() == 993 and got.where("order_id IS NOT NULL").count() == 0


def test_bucketed_table_reads_without_shuffle(spark, v):
    save_clustered_table(v, "skewsafe_test_bucketed", 4)
    t = spark.table("skewsafe_test_bucketed")
    agg = t.groupBy("partition_key", "customer_id").agg(F.sum("total_amount"))
    from skewsafe.plans.inspect import plan_text

    plan = plan_text(agg, "simple")
    assert "Exchange hashpartitioning" not in plan
    assert t.count() == v.count()


def test_hot_day_is_written_by_several_tasks(spark, scratch):
    """A third of the rows on one day: the rebalance before the write splits that day."""
    from skewsafe.session import conf_override

    rows = spark.range(0, 60_000, 1, 8).selectExpr(
        "CASE WHEN id % 3 = 0 THEN '2024-01-15' ELSE date_format(date_add(DATE'2024-02-01', CAST(id % 50 AS INT)), 'yyyy-MM-dd') END AS date",
        "id AS order_id", "CAST(id % 1000 AS DOUBLE) AS amount")
    with conf_override(spark, {"spark.sql.adaptive.advisoryPartitionSizeInBytes": "64KB"}):
        write_day_partitioned(rows, scratch)
    hot = [f for f in os.listdir(local_path(scratch) + "/date=2024-01-15") if f.endswith(".parquet")]
    assert len(hot) > 1
    back = spark.read.parquet(scratch)
    assert back.count() == 60_000 and back.where("date = '2024-01-15'").count() == 20_000


def test_partitioned_external_table_insert_layout(spark, scratch, v):
    from skewsafe.schemas import TARGET_V3

    [table] = create_target_tables(spark, "skewsafe_test_ext", ["v3"], TARGET_V3, partition_by=("date",),
                                   location=scratch)
    assert spark.table(table).columns[-1] == "date"
    insert_by_name(spark, v.repartition(5), table, ("date",))  # five input tasks, two days
    got = spark.table(table)
    assert got.count() == 6982 and got.where("order_id IS NOT NULL").count() == 0
    for day in ("2024-01-15", "2024-01-16"):
        files = [f for f in os.listdir(f"{local_path(scratch)}/v3/date={day}") if f.endswith(".parquet")]
        assert len(files) == 1  # laid out by day before the insert, not one file per input task
