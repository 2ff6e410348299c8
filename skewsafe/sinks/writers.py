"""Sinks: overwrite, day partitions, clustering, appends, staged publish.

Layout before a write uses the ``REBALANCE`` hint instead of
``repartition(n, hot_key)``: hashing by a hot key sends all its rows to one
writer, while AQE splits a rebalance partition that grows past the advisory
size and merges small ones, so files stay near the target size.

``fmt`` is a parameter everywhere; only file formats that ship with Spark
(parquet, orc, json, csv) can be used without extra jars.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from skewsafe.schemas import DECLARED_TARGET, ddl
from skewsafe.session import conf_override, listing_conf

# A directory-partitioned write produces at least one file per partition
# value whatever the task count, so merging small shuffle partitions saves
# no files and only serialises the writes. Oversized partitions are still
# split by AQE's rebalance skew handling.
_NO_COALESCE = {"spark.sql.adaptive.coalescePartitions.enabled": "false"}


def write_table(df: DataFrame, path: str, fmt: str = "parquet", mode: str = "overwrite") -> None:
    """Plain write of a whole frame."""
    df.write.format(fmt).mode(mode).save(path)


def write_partitioned(
    df: DataFrame,
    path: str,
    partition_by: Sequence[str] = ("date",),
    cluster_by: Sequence[str] = (),
    fmt: str = "parquet",
    mode: str = "overwrite",
    dynamic: bool = False,
) -> None:
    """Directory-partitioned write with optional clustering inside files.

    ``dynamic=True`` replaces only the partitions present in ``df`` (the
    rest of the table stays), which makes a re-run of the same batch a no-op.

    AQE coalescing is switched off on the session while a directory-
    partitioned write runs; writes started from other threads of the same
    session in that time see the same setting.
    """
    parts = list(partition_by)
    laid = df.hint("rebalance", *parts) if parts else df.hint("rebalance")
    if parts or cluster_by:
        laid = laid.sortWithinPartitions(*parts, *cluster_by)
    writer = laid.write.format(fmt).mode(mode).option("partitionOverwriteMode", "dynamic" if dynamic else "static")
    if parts:
        with conf_override(df.sparkSession, _NO_COALESCE):
            writer.partitionBy(*parts).save(path)
    else:
        writer.save(path)


def stage_rows(df: DataFrame, path: str, batch: Column, fmt: str = "parquet") -> None:
    """Stage rows once as Parquet (S4), one ``arrival=<n>`` folder per batch.

    ``batch`` gives each row its batch number. Later steps read one batch
    each with a partition filter, so the rows are computed once however
    many batches are taken from them. Written straight from the producing
    tasks (at most one file per task and batch): a layout shuffle here
    would move every row once more.
    """
    df.withColumn("arrival", batch.cast("int")).write.format(fmt).mode("overwrite").partitionBy("arrival").save(path)


def write_day_partitioned(df: DataFrame, path: str, date_col: str = "date", fmt: str = "parquet",
                          mode: str = "overwrite", granularity: str = "day") -> None:
    """One directory per day (S8); ``granularity='month'`` groups days by month.

    With ``month`` a ``date_month`` column (``yyyy-MM``) is the partition and
    ``date`` stays a data column, for inputs with many thin days.
    """
    if granularity == "month":
        df = df.withColumn("date_month", F.substring(F.col(date_col), 1, 7))
        write_partitioned(df, path, ["date_month"], [date_col], fmt, mode)
    elif granularity == "day":
        write_partitioned(df, path, [date_col], (), fmt, mode)
    else:
        raise ValueError("granularity must be 'day' or 'month'")


def write_clustered(df: DataFrame, path: str, cluster_by: Sequence[str] = ("partition_key", "customer_id"),
                    partition_by: Sequence[str] = ("date",), fmt: str = "parquet", mode: str = "overwrite") -> None:
    """Day partitions with rows sorted by ``cluster_by`` inside each file.

    Sorted files give tight min/max statistics, so key filters skip row
    groups on read.
    """
    write_partitioned(df, path, partition_by, cluster_by, fmt, mode)


def save_clustered_table(df: DataFrame, table: str, buckets: int,
                         cluster_by: Sequence[str] = ("partition_key", "customer_id"),
                         partition_by: Sequence[str] = ("date",), fmt: str = "parquet",
                         mode: str = "overwrite", bucket_by: Sequence[str] | None = None,
                         location: str | None = None) -> None:
    """Catalog form of S9: bucketed by ``bucket_by``, sorted by ``cluster_by``, partitioned by day.

    Rows are laid out by bucket before the write, one task per bucket, so the
    table has at most days x buckets files; without this every task would write
    its own file for each day and bucket it meets. ``bucket_by`` (default: all of
    ``cluster_by``) must not be a hot column alone: a bucket is one task's. With
    one column, a filter on it reads its bucket only, and any aggregate or join
    whose keys include it needs no shuffle.

    ``location`` makes it an external table there (a default warehouse folder
    may be machine-local).
    """
    by = list(bucket_by or cluster_by)
    laid = df.repartition(buckets, *by).sortWithinPartitions(*partition_by, *cluster_by)
    writer = laid.write.format(fmt).mode(mode).partitionBy(*partition_by).bucketBy(buckets, *by).sortBy(*cluster_by)
    if location:
        writer = writer.option("path", location)
    with conf_override(df.sparkSession, _NO_COALESCE):
        writer.saveAsTable(table)


def align_to_schema(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Columns of ``schema`` by name; missing nullable ones become typed NULLs."""
    have = set(df.columns)
    extra = have - set(schema.fieldNames())
    if extra:
        raise ValueError(f"columns not in target schema: {sorted(extra)}")
    cols = []
    for f in schema.fields:
        if f.name in have:
            cols.append(F.col(f.name).cast(f.dataType).alias(f.name))
        elif f.nullable:
            cols.append(F.lit(None).cast(f.dataType).alias(f.name))
        else:
            raise ValueError(f"missing non-nullable column {f.name}")
    return df.select(*cols)


def append_by_name(df: DataFrame, path: str, schema: T.StructType, partition_by: Sequence[str] = ("date",),
                   fmt: str = "parquet") -> None:
    """Append ``df`` matched to the table's columns by name.

    A plain append: running it twice stores the batch twice. Use
    :func:`write_batch` where a batch may be replayed.
    """
    write_partitioned(align_to_schema(df, schema), path, partition_by, (), fmt, mode="append")


def insert_by_name(spark: SparkSession, df: DataFrame, table: str, partition_by: Sequence[str] = ()) -> None:
    """Catalog append by column name; missing nullable columns are filled with NULL.

    ``partition_by`` names the table's partition columns: rows are laid out
    as for :func:`write_partitioned` (``REBALANCE`` on them, no coalescing),
    so each partition gets few, right-sized files and a hot one is split.
    """
    parts = list(partition_by)
    laid = df.hint("rebalance", *parts).sortWithinPartitions(*parts) if parts else df.hint("rebalance")
    view = f"_skewsafe_insert_{uuid.uuid4().hex}"
    laid.createOrReplaceTempView(view)
    try:
        with conf_override(spark, _NO_COALESCE if parts else {}):
            spark.sql(f"INSERT INTO {table} BY NAME SELECT * FROM {view}")
    finally:
        spark.catalog.dropTempView(view)


def write_batch(df: DataFrame, path: str, batch_id: int, partition_by: Sequence[str] = ("date",),
                cluster_by: Sequence[str] = (), fmt: str = "parquet", stream_id: str | None = None) -> None:
    """Idempotent append: the batch is the whole ``batch_id`` folder.

    The folder is replaced, not merged: after a replay it holds the new rows
    only, also when they cover fewer days or are none at all. Other batches
    stay. ``stream_id`` puts the batches of a stream in a folder of their
    own, so two streams (or a stream and batch jobs) never share a number.
    """
    folder = f"{path.rstrip('/')}/stream_id={stream_id}" if stream_id is not None else path.rstrip("/")
    write_partitioned(df, f"{folder}/batch_id={int(batch_id)}", partition_by, cluster_by, fmt, mode="overwrite")


def replace_with_batch(df: DataFrame, path: str, batch_id: int, partition_by: Sequence[str] = ("date",),
                       cluster_by: Sequence[str] = (), fmt: str = "parquet") -> None:
    """Whole-table overwrite that leaves ``df`` as the only batch of the table."""
    tagged = df.withColumn("batch_id", F.lit(int(batch_id)).cast("bigint"))
    write_partitioned(tagged, path, ["batch_id", *partition_by], cluster_by, fmt, mode="overwrite")


def read_target(spark: SparkSession, path: str, schema: T.StructType, fmt: str = "parquet") -> DataFrame:
    """Read a written table with its schema, so partition columns keep their types.

    Partition folders are listed when the read is resolved, here; unless the
    session sets it, that listing runs as one wave over the cores rather
    than one task per folder.
    """
    with conf_override(spark, listing_conf(spark)):
        return spark.read.format(fmt).schema(schema).load(path)


def verify_count(spark: SparkSession, path: str, schema: T.StructType, fmt: str = "parquet") -> int:
    """Row count of the table as re-read from storage."""
    return read_target(spark, path, schema, fmt).count()


def staged_publish(
    df: DataFrame,
    target_path: str,
    staging_path: str,
    schema: T.StructType,
    partition_by: Sequence[str] = ("date",),
    expected_rows: int | None = None,
    fmt: str = "parquet",
) -> int:
    """Write to a staging location, check it, then publish its partitions.

    The staged copy is plain files (no partition folders), written by the
    producing tasks, so the result is computed once and the partitioned
    layout (one shuffle) is paid for once, at publish. Row count and checksum
    are observed while the rows are staged.
    The target is touched only when the staged copy, read back, has exactly
    these (and ``expected_rows`` rows, when given). Publishing uses dynamic
    overwrite: partitions not in the batch stay as they were.
    """
    from skewsafe.sinks.versions import write_checked

    spark = df.sparkSession
    rows = write_checked(df, staging_path, schema, (), fmt)  # producing tasks write directly: no layout shuffle
    if expected_rows is not None and rows != expected_rows:
        raise RuntimeError(f"staged {rows} rows, expected {expected_rows}; target left unchanged")
    staged = spark.read.format(fmt).schema(schema).load(staging_path)
    write_partitioned(staged, target_path, partition_by, (), fmt, mode="overwrite", dynamic=True)
    return rows


def ensure_namespace(spark: SparkSession, name: str, location: str | None = None) -> None:
    """Create the database if missing (S11), optionally at ``location``."""
    where = f" LOCATION '{location}'" if location else ""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS `{name}`{where}")


def create_target_tables(spark: SparkSession, database: str, names: Sequence[str],
                         schema: T.StructType = DECLARED_TARGET, fmt: str = "parquet",
                         partition_by: Sequence[str] = (), location: str | None = None) -> list[str]:
    """``CREATE TABLE IF NOT EXISTS`` for each name from one schema.

    ``partition_by`` columns are moved to the end of the column list, as
    the table stores them. With ``location`` each table lives in
    ``location/<name>`` (an external table on shared storage) instead of the
    session's warehouse folder.
    """
    ensure_namespace(spark, database, f"{location}/_db" if location else None)
    parts = list(partition_by)
    ordered = T.StructType([f for f in schema.fields if f.name not in parts] + [schema[p] for p in parts])
    created = []
    for name in names:
        full = f"`{database}`.`{name}`"
        clauses = f" PARTITIONED BY ({', '.join(f'`{p}`' for p in parts)})" if parts else ""
        if location:
            clauses += f" LOCATION '{location}/{name}'"
        spark.sql(f"CREATE TABLE IF NOT EXISTS {full} ({ddl(ordered)}) USING {fmt}{clauses}")
        created.append(f"{database}.{name}")
    return created
