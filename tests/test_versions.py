"""Versioned batches: no gap, failed writes and wrong copies change nothing; streams that stop and go on."""

import datetime as dt
import uuid

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from skewsafe.operators.aggregate import aggregate_orders, rollup_totals
from skewsafe.plans.jobs import replace_batch
from skewsafe.schemas import ORDERS, TARGET, with_field
from skewsafe.sinks import versions as V
from skewsafe.sinks.writers import read_target, staged_publish
from skewsafe.sources.tables import orders_from_tpch
from skewsafe.streaming.append_stream import batch_budget, orders_stream, run_append_stream
from tests.conftest import SF_SMALL
from tools.compare import digest

TS = dt.datetime(2024, 1, 15, 12, 0)


def orders(spark, days):
    return spark.createDataFrame([("k", f"c{i}", i, 1.5, "p", d) for i, d in enumerate(days)], ORDERS)


def new_table(spark, scratch):
    return V.VersionedTable(spark, f"versions_test.t{uuid.uuid4().hex[:12]}", TARGET, scratch)


def stored(table):
    return sorted((r["batch_id"], r["date"]) for r in table.read().collect())


def test_replay_of_fewer_days_and_of_none(spark, scratch):
    table = new_table(spark, scratch)
    assert replace_batch(orders(spark, ["2024-01-01", "2024-01-02"]), table, 1, TS).rows == 2
    replace_batch(orders(spark, ["2024-02-01"]), table, 2, TS)
    replace_batch(orders(spark, ["2024-01-02"]), table, 1, TS)
    assert stored(table) == [(1, "2024-01-02"), (2, "2024-02-01")]
    replace_batch(orders(spark, ["2024-01-02"]).where("false"), table, 1, TS)
    assert stored(table) == [(2, "2024-02-01")]
    assert len(table.versions(1)) == 3 and table.batches() == [1, 2]
    assert len(table.drop_old_versions(1)) == 2 and len(table.versions(1)) == 1
    assert table.drop_old_versions(2) == [] and stored(table) == [(2, "2024-02-01")]


def test_a_write_that_fails_leaves_the_earlier_batch(spark, scratch):
    table = new_table(spark, scratch)
    replace_batch(orders(spark, ["2024-01-01"]), table, 1, TS)
    reader = table.read()
    broken = aggregate_orders(orders(spark, ["2024-03-01", "2024-03-02"])).withColumn("processed_timestamp", F.lit(TS))
    broken = broken.withColumn("order_count", F.when(F.col("date") == "2024-03-02", F.raise_error(F.lit("lost")).cast("long")).otherwise(F.col("order_count")))
    with pytest.raises(Exception, match="lost"):
        table.replace(broken, 1)
    assert stored(table) == [(1, "2024-01-01")] and reader.count() == 1
    replace_batch(orders(spark, ["2024-01-05"]), table, 1, TS)
    assert stored(table) == [(1, "2024-01-05")]


def test_a_wrong_copy_is_never_shown(spark, scratch, monkeypatch):
    table = new_table(spark, scratch)
    replace_batch(orders(spark, ["2024-01-01"]), table, 1, TS)
    first = aggregate_orders(orders(spark, ["2024-01-01"])).withColumn("processed_timestamp", F.lit(TS))
    staged_publish(first, f"{scratch}/target", f"{scratch}/staging0", TARGET)
    calls = []

    def spoilt(columns):
        calls.append(1)  # asked first for what is observed, then for what is read back
        return [F.count(F.lit(1)).alias("rows"), F.lit(len(calls)).alias("checksum")]

    monkeypatch.setattr(V, "row_metrics", spoilt)
    with pytest.raises(V.WrongCopyError):
        replace_batch(orders(spark, ["2024-01-09"]), table, 1, TS)
    with pytest.raises(V.WrongCopyError):
        staged_publish(first.withColumn("date", F.lit("2024-01-09")), f"{scratch}/target", f"{scratch}/staging1", TARGET)
    monkeypatch.undo()
    assert stored(table) == [(1, "2024-01-01")]
    assert [r["date"] for r in read_target(spark, f"{scratch}/target", TARGET).collect()] == ["2024-01-01"]


def test_the_plan_runs_once(spark, scratch):
    """Rows are computed once: the comparison reads the copy."""
    counted = spark.sparkContext.accumulator(0)

    def rows(batches):
        for b in batches:
            counted.add(b.num_rows)
            yield b

    df = spark.range(100).mapInArrow(rows, "id long")
    assert V.write_checked(df, f"{scratch}/once", T.StructType().add("id", "long")) == 100
    assert counted.value == 100


def test_stream_stops_and_goes_on(spark, scratch):
    inbox, target, ckpt = scratch + "/in", scratch + "/out", scratch + "/ckpt"
    rows = orders_from_tpch(spark, SF_SMALL)
    rows.coalesce(1).write.option("maxRecordsPerFile", 700).parquet(inbox)
    stream = orders_stream(spark, inbox, ORDERS, max_bytes_per_trigger=batch_budget(spark, inbox, 4))
    schema = with_field(TARGET, "batch_id", T.LongType())
    run_append_stream(stream, target, ckpt, stop_after=2, run_ts=TS)
    assert sorted(r[0] for r in read_target(spark, target, schema).select("batch_id").distinct().collect()) == [0, 1]
    run_append_stream(stream, target, ckpt, run_ts=TS)
    done = read_target(spark, target, schema)
    assert done.select("batch_id").distinct().count() >= 4
    a, b = rollup_totals(done), aggregate_orders(rows)
    assert digest([tuple(r) for r in a.collect()], a.columns) == digest([tuple(r) for r in b.collect()], b.columns)
    with pytest.raises(ValueError):
        batch_budget(spark, inbox, 0)
