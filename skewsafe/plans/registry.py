"""Registered queries: one callable ``(spark, sf_dir) -> DataFrame`` per operator.

Every query reads the driver tables through :func:`orders_from_tpch`, so its
work grows with the tables. Queries that exercise a sink write under the
session's shared folder and return the table as re-read from storage.
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from skewsafe.functions.columns import salt
from skewsafe.operators import quality, reports
from skewsafe.operators.aggregate import (
    aggregate_orders,
    aggregate_salted,
    order_list_pages,
    rollup_totals,
    with_null_order_id,
    with_run_timestamp,
)
from skewsafe.operators.exact import aggregate_orders_exact
from skewsafe.operators.sketches import daily_sketches, merged_estimates, within_bound
from skewsafe.operators.skew import detect_hot_keys
from skewsafe.plans import jobs
from skewsafe.plans.oracle import AS_OF_DAY, PAGE_SPAN, REPLAY_DAY, SINCE_DAY, SPLIT_DAY, WIDE_AMOUNT
from skewsafe.plans.run import job_all
from skewsafe.schemas import GROUP_KEYS, ORDERS, TARGET, TARGET_V3, with_field
from skewsafe.session import shared_dir
from skewsafe.sinks.versions import ReplacedTable, VersionedTable
from skewsafe.sinks.writers import (
    append_by_name,
    create_target_tables,
    ensure_namespace,
    insert_by_name,
    read_target,
    save_clustered_table,
    staged_publish,
    write_batch,
    write_clustered,
    write_day_partitioned,
)
from skewsafe.sources.tables import orders_from_tpch, partition_keys_from_tpch, plant_faults, preview, read_table
from skewsafe.streaming.append_stream import batch_budget, orders_stream, run_append_stream

Query = Callable[[SparkSession, str], DataFrame]

AGG_COLUMNS = [*GROUP_KEYS, "total_amount", "order_count", "date", "avg_amount"]
RUN_TS = _dt.datetime(2024, 1, 15, 12, 0, 0)
HOT_SHARE = 0.05
SALT_BUCKETS = 10
CATALOG_DB = "skewsafe_queries"
# The stream query works off its backlog in about so many micro-batches.
STREAM_BATCHES = 4
# Buckets of the clustered table: its rows are groups, at most some hundred thousand by the adapter's fixed keys.
CLUSTER_BUCKETS = 8
# Amount of the sub-cent queries: the discount granted on a line.
DISCOUNT = "cast(cast(l_extendedprice as decimal(18,2)) * cast(l_discount as decimal(18,2)) as double)"


def _v(spark: SparkSession, sf_dir: str) -> DataFrame:
    return aggregate_orders(orders_from_tpch(spark, sf_dir))


def orders_adapter(spark, sf_dir):
    return orders_from_tpch(spark, sf_dir)


def scan_filter_pushdown(spark, sf_dir):
    return orders_from_tpch(spark, sf_dir, since=SINCE_DAY)


def agg_collect_list(spark, sf_dir):
    return order_list_pages(orders_from_tpch(spark, sf_dir), PAGE_SPAN)


def agg_orders(spark, sf_dir):
    return _v(spark, sf_dir)


def agg_salted_two_phase(spark, sf_dir):
    # Every key is salted: map-side partial sums keep the first shuffle as
    # small as the plain one's times the salts a task sees, and no pass over
    # the rows is spent on finding the hot keys.
    rows = orders_from_tpch(spark, sf_dir, since=SINCE_DAY)
    return with_null_order_id(aggregate_salted(rows, None, SALT_BUCKETS))


def _discounts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order rows whose amount is the discount of the line: parts below a cent."""
    return orders_from_tpch(spark, sf_dir, amount=DISCOUNT)


def agg_subcent(spark, sf_dir):
    return aggregate_orders(_discounts(spark, sf_dir))


def agg_subcent_salted(spark, sf_dir):
    return aggregate_salted(_discounts(spark, sf_dir), None, SALT_BUCKETS)


def agg_wide_range(spark, sf_dir):
    """Amounts of very different sizes and both signs: the exact sum, rounded once."""
    return aggregate_orders_exact(orders_from_tpch(spark, sf_dir, amount=WIDE_AMOUNT))


def agg_wide_range_salted(spark, sf_dir):
    rows = orders_from_tpch(spark, sf_dir, amount=WIDE_AMOUNT)
    return aggregate_orders_exact(rows, salt=salt("partition_key", None, SALT_BUCKETS, ["order_id", "amount"]))


def agg_orders_by_date(spark, sf_dir):
    return aggregate_orders(orders_from_tpch(spark, sf_dir), by_date=True)


def write_by_date_roundtrip(spark, sf_dir):
    """Day-partitioned write of the by-date aggregate: its rows grow with the days and the keys."""
    path = shared_dir(spark, "queries", "by_date")
    write_day_partitioned(with_run_timestamp(agg_orders_by_date(spark, sf_dir), RUN_TS), path)
    return read_target(spark, path, TARGET).select(*AGG_COLUMNS)


def _arrivals(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Aggregates of two arrivals: days before SPLIT_DAY, then the rest.

    One join and one aggregate by (arrival, keys); only the groups are stored
    (S4), and each arrival reads its own folder of them.
    """
    path = shared_dir(spark, "queries", "arrivals")
    rows = orders_from_tpch(spark, sf_dir).withColumn("arrival", F.when(F.col("date") < SPLIT_DAY, 0).otherwise(1))
    groups = aggregate_orders(rows, [*GROUP_KEYS, "arrival"])
    groups.write.partitionBy("arrival").parquet(path)
    stored = spark.read.schema(groups.schema).parquet(path)
    first, later = (stored.where(F.col("arrival") == n).select(*AGG_COLUMNS) for n in (0, 1))
    return first, later


def _two_batches(spark, sf_dir, path) -> None:
    """Each arrival's aggregate written idempotently as its own batch."""
    first, later = _arrivals(spark, sf_dir)
    write_batch(with_run_timestamp(first, RUN_TS), path, 0)
    write_batch(with_run_timestamp(later, RUN_TS), path, 1)


def incremental_append(spark, sf_dir):
    path = shared_dir(spark, "queries", "incremental_append")
    _two_batches(spark, sf_dir, path)
    return read_target(spark, path, with_field(TARGET, "batch_id", T.LongType())).select(*AGG_COLUMNS)


def append_by_name_query(spark, sf_dir):
    path = shared_dir(spark, "queries", "append_by_name")
    first, later = _arrivals(spark, sf_dir)
    a, b = with_null_order_id(first), later
    write_day_partitioned(with_run_timestamp(a, RUN_TS), path)
    append_by_name(with_run_timestamp(b, RUN_TS), path, TARGET_V3)
    return read_target(spark, path, TARGET_V3).select(*AGG_COLUMNS, "order_id")


def catalog_append_by_name(spark, sf_dir):
    """The v3 table and a later batch as a catalog table.

    An external day-partitioned table under the shared folder (a default
    warehouse folder may be machine-local); the later batch, which has no
    ``order_id``, is inserted by name. Read back through the catalog.
    """
    base = shared_dir(spark, "queries", "catalog")
    name = "v3_" + base.rstrip("/").rsplit("/", 1)[-1][:16]
    [table] = create_target_tables(spark, CATALOG_DB, [name], TARGET_V3, partition_by=("date",), location=base)
    first, later = _arrivals(spark, sf_dir)
    a, b = with_null_order_id(first), later
    insert_by_name(spark, with_run_timestamp(a, RUN_TS), table, ("date",))
    insert_by_name(spark, with_run_timestamp(b, RUN_TS), table, ("date",))
    return spark.table(table).select(*AGG_COLUMNS, "order_id")


def replayed_batch(spark, sf_dir):
    """Batch 1 stored with all its days, then replayed with fewer: the table holds the replay only."""
    path = shared_dir(spark, "queries", "replayed_batch")
    first, later = _arrivals(spark, sf_dir)
    write_batch(with_run_timestamp(first, RUN_TS), path, 0)
    write_batch(with_run_timestamp(later, RUN_TS), path, 1)
    write_batch(with_run_timestamp(later.where(F.col("date") >= REPLAY_DAY), RUN_TS), path, 1)
    return read_target(spark, path, with_field(TARGET, "batch_id", T.LongType())).select(*AGG_COLUMNS, "batch_id")


def replaced_versions(spark, sf_dir):
    """J4 on a versioned catalog table: batch 1 stored, then replayed with fewer days by a catalog switch.

    ``versions`` counts the stored versions of the row's batch: the replaced one is still there.
    """
    root = shared_dir(spark, "queries", "versions")
    table = VersionedTable(spark, f"{CATALOG_DB}.versions_{root.rstrip('/').rsplit('/', 1)[-1][:16]}", TARGET, root)
    rows = orders_from_tpch(spark, sf_dir)
    later = rows.where(F.col("date") >= SPLIT_DAY)
    jobs.replace_batch(rows.where(F.col("date") < SPLIT_DAY), table, 0, RUN_TS)
    jobs.replace_batch(later, table, 1, RUN_TS)
    jobs.replace_batch(later.where(F.col("date") >= REPLAY_DAY), table, 1, RUN_TS)
    versions = F.when(F.col("batch_id") == 0, len(table.versions(0))).otherwise(len(table.versions(1)))
    return table.read().select(*AGG_COLUMNS, "batch_id", versions.cast("bigint").alias("versions"))


def job_v1(spark, sf_dir):
    """Totals as stored by the job, with its run timestamp and post-write count."""
    out = jobs.pipeline_v1(orders_from_tpch(spark, sf_dir), shared_dir(spark, "queries", "job_v1"), PAGE_SPAN, RUN_TS)
    return _stored(spark, out, TARGET)


def job_v2(spark, sf_dir):
    """The day-partitioned table."""
    out = jobs.pipeline_v2(orders_from_tpch(spark, sf_dir), shared_dir(spark, "queries", "job_v2"), RUN_TS)
    return _stored(spark, out, TARGET)


def job_v3(spark, sf_dir):
    """J3 over a table that already holds a later batch: the overwrite leaves its own rows only."""
    path = shared_dir(spark, "queries", "job_v3")
    rows = orders_from_tpch(spark, sf_dir)
    jobs.incremental_append(rows.where(F.col("date") < SPLIT_DAY), path, 7, RUN_TS)
    out = jobs.pipeline_v3(rows, path, since=SINCE_DAY, hot_keys=["SKEWED_KEY"], salt_buckets=SALT_BUCKETS, run_ts=RUN_TS)
    return _stored(spark, out, jobs.TARGET_BATCHED)


def job_v3_detected(spark, sf_dir):
    """J3 that finds its hot keys: a sketch of one ``lineitem`` column, no second pass over the join.

    ``hot_keys`` names the keys that were salted, in order.
    """
    out = jobs.pipeline_v3(orders_from_tpch(spark, sf_dir), shared_dir(spark, "queries", "job_v3_detected"), since=SINCE_DAY,
                           min_share=HOT_SHARE, salt_buckets=SALT_BUCKETS, run_ts=RUN_TS,
                           key_source=partition_keys_from_tpch(spark, sf_dir))
    return _stored(spark, out, jobs.TARGET_BATCHED).withColumn("hot_keys", F.lit(",".join(sorted(out.hot_keys))))


def job_all_query(spark, sf_dir):
    """All phases; the lines of all its reports. The rows are those before SPLIT_DAY, the later batch the rest."""
    base = shared_dir(spark, "queries", "job_all")
    rows = orders_from_tpch(spark, sf_dir)
    database = f"{CATALOG_DB}_{base.rstrip('/').rsplit('/', 1)[-1][:12]}"
    return job_all(rows.where(F.col("date") < SPLIT_DAY), rows.where(F.col("date") >= SPLIT_DAY), base, database,
                   key_source=partition_keys_from_tpch(spark, sf_dir), run_ts=RUN_TS)


def distinct_sketches(spark, sf_dir):
    """A9 from stored sketches: per day and over all days, exact counts and whether the estimates are within the bound.

    Each arrival stores its days' sketches; estimates come from the stored table, the whole
    table's by merging the sketches of all days (``date`` is ``all``).
    """
    path = shared_dir(spark, "queries", "daily_sketches")
    rows = orders_from_tpch(spark, sf_dir)
    columns = ["customer_id", "order_id"]
    for batch, part in enumerate((rows.where(F.col("date") < SPLIT_DAY), rows.where(F.col("date") >= SPLIT_DAY))):
        daily_sketches(part, columns).write.mode("overwrite").parquet(f"{path}/batch_id={batch}")
    stored = spark.read.parquet(path)
    estimates = merged_estimates(stored, columns, ["date"]).unionByName(
        merged_estimates(stored, columns).withColumn("date", F.lit("all")))
    counts = [F.count(F.lit(1)).alias("orders"), *(F.countDistinct(c).alias(f"unique_{c}") for c in columns)]
    exact = rows.groupBy("date").agg(*counts).unionByName(rows.agg(*counts).withColumn("date", F.lit("all")))
    both = exact.join(estimates, "date")
    return both.select("date", "orders", "unique_customer_id", "unique_order_id", F.col("row_count").alias("sketched_rows"),
                       *(within_bound(f"{c}_estimate", f"unique_{c}").alias(f"{c}_within_bound") for c in columns))


def clustered_table(spark, sf_dir):
    """S9 as a bucketed catalog table: totals per key and customer, read from the buckets without a shuffle."""
    base = shared_dir(spark, "queries", "clustered_table")
    name = f"{CATALOG_DB}.clustered_{base.rstrip('/').rsplit('/', 1)[-1][:16]}"
    ensure_namespace(spark, CATALOG_DB, f"{base}/_db")
    groups = with_run_timestamp(_v(spark, sf_dir), RUN_TS).withColumn("date_month", F.substring("date", 1, 7))
    save_clustered_table(groups, name, CLUSTER_BUCKETS, partition_by=["date_month"], bucket_by=["customer_id"], location=f"{base}/table")
    return rollup_totals(spark.table(name), ["partition_key", "customer_id"])


def catalog_overwrite(spark, sf_dir):
    """S5 on a catalog table: the first arrival stored, then the whole table replaced by both.

    ``versions`` counts the stored versions: the replaced one is still there.
    """
    root = shared_dir(spark, "queries", "overwrite")
    table = ReplacedTable(spark, f"{CATALOG_DB}.replaced_{root.rstrip('/').rsplit('/', 1)[-1][:16]}", TARGET, root)
    first, later = _arrivals(spark, sf_dir)
    table.overwrite(with_run_timestamp(first, RUN_TS), ["date", "partition_key"])
    table.overwrite(with_run_timestamp(first.unionByName(later), RUN_TS), ["date", "partition_key"])
    return table.read().select(*AGG_COLUMNS, F.lit(len(table.versions())).cast("bigint").alias("versions"))


def job_append(spark, sf_dir):
    """J3, then J4: the v3 table with a later batch appended."""
    path = shared_dir(spark, "queries", "job_append")
    rows = orders_from_tpch(spark, sf_dir)
    first, later = rows.where(F.col("date") < SPLIT_DAY), rows.where(F.col("date") >= SPLIT_DAY)
    jobs.pipeline_v3(first, path, hot_keys=["SKEWED_KEY"], salt_buckets=SALT_BUCKETS, run_ts=RUN_TS)
    out = jobs.incremental_append(later, path, 1, RUN_TS)
    return _stored(spark, out, jobs.TARGET_BATCHED)


def _stored(spark, out: jobs.JobResult, schema: T.StructType) -> DataFrame:
    """A job's table as re-read, with the run timestamp as text and the post-write count."""
    stored = read_target(spark, out.path, schema)
    return stored.select(*AGG_COLUMNS, F.date_format("processed_timestamp", "yyyy-MM-dd HH:mm:ss").alias("processed_at"),
                         F.lit(out.rows).cast("bigint").alias("table_rows"))


def append_rollup(spark, sf_dir):
    path = shared_dir(spark, "queries", "append_rollup")
    _two_batches(spark, sf_dir, path)
    stored = read_target(spark, path, with_field(TARGET, "batch_id", T.LongType()))
    return rollup_totals(stored)


def partition_distribution(spark, sf_dir):
    return reports.partition_distribution(_v(spark, sf_dir))


def top_partitions(spark, sf_dir):
    return reports.top_partitions(_v(spark, sf_dir))


def total_rows(spark, sf_dir):
    return reports.total_rows(_v(spark, sf_dir))


def top_customers(spark, sf_dir):
    return reports.top_customers(_v(spark, sf_dir))


def daily_metrics(spark, sf_dir):
    return reports.daily_metrics(_v(spark, sf_dir))


def daily_metrics_basic(spark, sf_dir):
    return reports.daily_metrics(_v(spark, sf_dir), with_avg=False)


def dq_table_summary(spark, sf_dir):
    return quality.table_summary(_v(spark, sf_dir))


def dq_completeness(spark, sf_dir):
    return quality.completeness(plant_faults(orders_from_tpch(spark, sf_dir)))


def dq_skew(spark, sf_dir):
    return quality.skew(_v(spark, sf_dir))


def dq_anomalies(spark, sf_dir):
    return quality.anomalies(aggregate_orders(plant_faults(orders_from_tpch(spark, sf_dir))), AS_OF_DAY)


def table_preview(spark, sf_dir):
    return preview(_v(spark, sf_dir), 10, list(GROUP_KEYS))


def hot_keys(spark, sf_dir):
    return detect_hot_keys(orders_from_tpch(spark, sf_dir), "partition_key", HOT_SHARE)


def write_partitioned_roundtrip(spark, sf_dir):
    path = shared_dir(spark, "queries", "write_partitioned")
    write_day_partitioned(with_run_timestamp(_v(spark, sf_dir), RUN_TS), path)
    return read_target(spark, path, TARGET).select(*AGG_COLUMNS)


def write_clustered_roundtrip(spark, sf_dir):
    path = shared_dir(spark, "queries", "write_clustered")
    v3 = with_null_order_id(aggregate_salted(orders_from_tpch(spark, sf_dir), ["SKEWED_KEY"], SALT_BUCKETS))
    write_clustered(with_run_timestamp(v3, RUN_TS), path)
    return read_target(spark, path, TARGET_V3).select(*AGG_COLUMNS)


def staged_publish_query(spark, sf_dir):
    target = shared_dir(spark, "queries", "staged_target")
    staging = shared_dir(spark, "queries", "staged_staging")
    staged_publish(with_run_timestamp(_v(spark, sf_dir), RUN_TS), target, staging, TARGET)
    return read_target(spark, target, TARGET).select(*AGG_COLUMNS)


def stream_append_rollup(spark, sf_dir):
    inbox = shared_dir(spark, "queries", "stream_inbox")
    target = shared_dir(spark, "queries", "stream_target")
    checkpoint = shared_dir(spark, "queries", "stream_checkpoint")
    # The inbox keeps the join's own partitioning; a file holds at most so many
    # rows (a share of the table, counted from its footers), so a backlog that few
    # tasks wrote is several files too, and batches take whole files.
    rows = orders_from_tpch(spark, sf_dir)
    per_file = max(1, read_table(spark, sf_dir, "lineitem").count() // (4 * STREAM_BATCHES))
    rows.write.mode("overwrite").option("maxRecordsPerFile", per_file).parquet(inbox)
    stream = orders_stream(spark, inbox, ORDERS, max_bytes_per_trigger=batch_budget(spark, inbox, STREAM_BATCHES))
    # The first run is stopped after one batch; the second goes on from the checkpoint.
    run_append_stream(stream, target, checkpoint, run_ts=RUN_TS, stop_after=1)
    run_append_stream(stream, target, checkpoint, run_ts=RUN_TS)
    stored = read_target(spark, target, with_field(TARGET, "batch_id", T.LongType()))
    per_batch = stored.groupBy("batch_id").agg(F.sum("order_count").alias("orders"), F.max("processed_timestamp").alias("at"))
    stamp = per_batch.agg(F.max("at")).scalar()
    return rollup_totals(stored).select(
        "*", F.date_format(stamp, "yyyy-MM-dd HH:mm:ss").alias("processed_at"),
        per_batch.agg(F.sum("orders")).scalar().alias("batch_orders"),
        (per_batch.agg(F.count(F.lit(1))).scalar() >= 3).alias("several_batches"),
    )


QUERIES: dict[str, Query] = {
    "orders_adapter": orders_adapter,
    "scan_filter_pushdown": scan_filter_pushdown,
    "agg_collect_list": agg_collect_list,
    "agg_orders": agg_orders,
    "agg_salted_two_phase": agg_salted_two_phase,
    "agg_subcent": agg_subcent,
    "agg_subcent_salted": agg_subcent_salted,
    "agg_wide_range": agg_wide_range,
    "agg_wide_range_salted": agg_wide_range_salted,
    "agg_orders_by_date": agg_orders_by_date,
    "write_by_date_roundtrip": write_by_date_roundtrip,
    "incremental_append": incremental_append,
    "replayed_batch": replayed_batch,
    "replaced_versions": replaced_versions,
    "job_v1": job_v1,
    "job_v2": job_v2,
    "job_v3": job_v3,
    "job_v3_detected": job_v3_detected,
    "job_append": job_append,
    "job_all": job_all_query,
    "distinct_sketches": distinct_sketches,
    "clustered_table": clustered_table,
    "catalog_overwrite": catalog_overwrite,
    "append_by_name": append_by_name_query,
    "catalog_append_by_name": catalog_append_by_name,
    "append_rollup": append_rollup,
    "partition_distribution": partition_distribution,
    "top_partitions": top_partitions,
    "total_rows": total_rows,
    "top_customers": top_customers,
    "daily_metrics": daily_metrics,
    "daily_metrics_basic": daily_metrics_basic,
    "dq_table_summary": dq_table_summary,
    "dq_completeness": dq_completeness,
    "dq_skew": dq_skew,
    "dq_anomalies": dq_anomalies,
    "table_preview": table_preview,
    "hot_keys": hot_keys,
    "write_partitioned_roundtrip": write_partitioned_roundtrip,
    "write_clustered_roundtrip": write_clustered_roundtrip,
    "staged_publish": staged_publish_query,
    "stream_append_rollup": stream_append_rollup,
}
