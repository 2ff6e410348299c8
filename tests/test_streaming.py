"""Append stream: per-batch aggregates whose rollup equals the one-shot aggregate; replay-safe."""

from pyspark.sql import functions as F
from pyspark.sql import types as T

from skewsafe.operators.aggregate import aggregate_orders, rollup_totals
from skewsafe.schemas import ORDERS, TARGET, with_field
from skewsafe.sinks.writers import read_target
from skewsafe.sources.tables import orders_from_tpch
from skewsafe.streaming.append_stream import orders_stream, run_append_stream
from tests.conftest import SF_SMALL
from tools.compare import digest


def _rows(df):
    return digest([tuple(r) for r in df.collect()], df.columns)


def test_stream_rollup_and_replay(spark, scratch):
    inbox, target, ckpt = scratch + "/in", scratch + "/out", scratch + "/ckpt"
    rows = orders_from_tpch(spark, SF_SMALL)
    rows.repartition(4, F.col("order_id")).write.parquet(inbox)
    run_append_stream(orders_stream(spark, inbox, ORDERS, max_files_per_trigger=1), target, ckpt)
    schema = with_field(TARGET, "batch_id", T.LongType())
    stored = read_target(spark, target, schema)
    assert stored.select("batch_id").distinct().count() == 4
    assert _rows(rollup_totals(stored)) == _rows(aggregate_orders(rows))
    before = _rows(stored)
    assert stored.where("processed_timestamp IS NULL").count() == 0
    # Re-running the finished query with the same checkpoint adds nothing.
    run_append_stream(orders_stream(spark, inbox, ORDERS, max_files_per_trigger=1), target, ckpt)
    assert _rows(read_target(spark, target, schema)) == before


def test_batches_sized_by_bytes(spark, scratch):
    inbox, target, ckpt = scratch + "/in", scratch + "/out", scratch + "/ckpt"
    rows = orders_from_tpch(spark, SF_SMALL)
    rows.repartition(6).write.parquet(inbox)
    # A byte budget smaller than one file still admits one file per batch.
    run_append_stream(orders_stream(spark, inbox, ORDERS, max_bytes_per_trigger=1), target, ckpt)
    stored = read_target(spark, target, with_field(TARGET, "batch_id", T.LongType()))
    assert stored.select("batch_id").distinct().count() == 6
    assert _rows(rollup_totals(stored)) == _rows(aggregate_orders(rows))


def test_a_new_checkpoint_loses_no_stored_batch(spark, scratch):
    target, rows = scratch + "/out", orders_from_tpch(spark, SF_SMALL)
    halves = [rows.where("order_id % 10 < 9"), rows.where("order_id % 10 = 9")]
    for n, half in enumerate(halves):
        half.coalesce(1).write.parquet(f"{scratch}/in{n}")
        run_append_stream(orders_stream(spark, f"{scratch}/in{n}", ORDERS), target, f"{scratch}/ckpt{n}")
    stored = read_target(spark, target, with_field(TARGET, "batch_id", T.LongType()))
    assert stored.select("stream_id").distinct().count() == 2
    assert stored.agg(F.sum("order_count")).first()[0] == rows.count()
    assert _rows(rollup_totals(stored)) == _rows(aggregate_orders(rows))
