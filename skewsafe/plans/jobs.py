"""Composite jobs a user calls.

Each job reads order rows, aggregates, writes, and returns what it wrote
(plus small report frames). Failures raise; nothing is swallowed.
"""

from __future__ import annotations

import datetime as _dt
import time
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from skewsafe.operators import reports
from skewsafe.operators.aggregate import (
    aggregate_orders,
    aggregate_salted,
    order_list_pages,
    totals_from_pages,
    with_null_order_id,
    with_run_timestamp,
)
from skewsafe.operators.sketches import heavy_keys, heavy_sketch
from skewsafe.operators.skew import hot_key_list
from skewsafe.schemas import TARGET, TARGET_V3, with_field
from skewsafe.sinks.versions import VersionedTable
from skewsafe.sinks.writers import (
    read_target,
    replace_with_batch,
    verify_count,
    write_batch,
    write_day_partitioned,
    write_table,
)
from skewsafe.sources.tables import filter_since

TARGET_BATCHED = with_field(TARGET_V3, "batch_id", T.LongType())


@dataclass
class JobResult:
    name: str
    path: str
    rows: int
    seconds: float
    reports: dict[str, DataFrame] = field(default_factory=dict)
    hot_keys: list = field(default_factory=list)


def _timed(name: str, path: str, spark: SparkSession, schema: T.StructType, write, reports_of=None) -> JobResult:
    t0 = time.time()
    write()
    seconds = time.time() - t0
    rows = verify_count(spark, path, schema)
    written = read_target(spark, path, schema)
    return JobResult(name, path, rows, seconds, reports_of(written) if reports_of else {})


def pipeline_v1(rows: DataFrame, path: str, page_span: int = 10_000,
                run_ts: _dt.datetime | None = None) -> JobResult:
    """Totals plus the sorted order-id lists, from one pass over ``rows``.

    The reference builds one unbounded list per group and caches it for two
    writes. Here the id lists are written once in bounded pages that also
    carry per-page sums (``order_lists/``); the totals (``totals/``) are
    then re-added from that stored table, reading only its key and sum
    columns. The input is scanned (and joined) once, and the stored pages,
    not a cache, survive a lost executor.
    """
    spark = rows.sparkSession

    def write():
        write_table(order_list_pages(rows, page_span, with_sums=True), f"{path}/order_lists")
        pages = spark.read.parquet(f"{path}/order_lists")
        write_table(with_run_timestamp(totals_from_pages(pages), run_ts), f"{path}/totals")

    return _timed("v1", f"{path}/totals", spark, T.StructType(TARGET.fields), write)


def pipeline_v2(rows: DataFrame, path: str, run_ts: _dt.datetime | None = None, top: int = 10) -> JobResult:
    """Plain aggregate, day-partitioned overwrite, key distribution report."""
    spark = rows.sparkSession
    result = with_run_timestamp(aggregate_orders(rows), run_ts)
    return _timed("v2", path, spark, TARGET, lambda: write_day_partitioned(result, path),
                  lambda t: {"partition_distribution": reports.partition_distribution(t).limit(top)})


def pipeline_v3(
    rows: DataFrame,
    path: str,
    since: str | None = None,
    hot_keys: list | None = None,
    min_share: float = 0.05,
    salt_buckets: int = 10,
    run_ts: _dt.datetime | None = None,
    batch_id: int = 0,
    detect_sample: float | None = None,
    key_source: DataFrame | None = None,
) -> JobResult:
    """Filtered scan, salted two-phase aggregate, clustered day partitions.

    ``hot_keys=None`` detects keys holding ``min_share`` of the rows (a
    bounded list), from a ``detect_sample`` fraction of them when given.
    With ``key_source`` (``partition_key`` of the rows, or of a superset, read
    where it is cheapest) they come from a heavy-hitter sketch of that frame
    instead, without a pass over ``rows`` and their join. Which keys are salted
    never changes the result; ``JobResult.hot_keys`` says which were.
    The whole table is overwritten; its rows are batch ``batch_id``, so later
    appends (:func:`incremental_append`) are replay-safe.
    """
    spark = rows.sparkSession
    if since is not None:
        rows = filter_since(rows, since)
    if hot_keys is not None:
        hot = hot_keys
    elif key_source is not None:
        hot = heavy_keys(heavy_sketch(key_source, "partition_key", min_share), min_share)
    else:
        hot = hot_key_list(rows, "partition_key", min_share, detect_sample)
    result = with_run_timestamp(with_null_order_id(aggregate_salted(rows, hot, salt_buckets)), run_ts)

    def write():
        replace_with_batch(result, path, batch_id, ("date",), ("partition_key", "customer_id"))

    out = _timed("v3", path, spark, TARGET_BATCHED, write,
                 lambda t: {"top_partitions": reports.top_partitions(t)})
    out.hot_keys = list(hot)
    return out


def incremental_append(batch: DataFrame, path: str, batch_id: int, run_ts: _dt.datetime | None = None) -> JobResult:
    """Aggregate a later batch and add it to the v3 table as ``batch_id``.

    Re-running with the same ``batch_id`` replaces all of that batch, so a
    retry never doubles it and leaves none of its old rows. Missing ``order_id`` is stored as NULL.
    """
    spark = batch.sparkSession
    result = with_run_timestamp(aggregate_orders(batch), run_ts)
    return _timed("append", path, spark, TARGET_BATCHED,
                  lambda: write_batch(result, path, batch_id, ("date",), ("partition_key", "customer_id")))


def replace_batch(batch: DataFrame, table: VersionedTable, batch_id: int, run_ts: _dt.datetime | None = None) -> JobResult:
    """J4 into a versioned catalog table: readers see the earlier batch until the new one is complete and checked."""
    t0 = time.time()
    rows = table.replace(with_run_timestamp(aggregate_orders(batch), run_ts), batch_id, ("date", "partition_key", "customer_id"))
    return JobResult("replace", table.name, rows, time.time() - t0)


def run_all(rows: DataFrame, later: DataFrame, base: str, since: str | None = None) -> dict[str, JobResult]:
    """v1, v2, v3, the append, then the reports on the final table."""
    out = {
        "v1": pipeline_v1(rows, f"{base}/v1"),
        "v2": pipeline_v2(rows, f"{base}/v2"),
        "v3": pipeline_v3(rows, f"{base}/v3", since=since),
    }
    out["append"] = incremental_append(later, f"{base}/v3", batch_id=1)
    final = read_target(rows.sparkSession, f"{base}/v3", TARGET_BATCHED)
    out["append"].reports = {
        "top_customers": reports.top_customers(final),
        "daily_metrics": reports.daily_metrics(final),
    }
    return out
