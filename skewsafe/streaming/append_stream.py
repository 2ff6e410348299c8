"""Append stream (T1, T2): order files in, per-batch aggregates out.

Each micro-batch is aggregated on its own and written to its own folder,
``stream_id=<id in the checkpoint>/batch_id=<epoch>``, which is replaced as a
whole. An epoch that is re-run after a failure rewrites the same folder, so
the table never holds a batch twice; a stream with a new checkpoint has a new
id, so it never replaces what an earlier one stored. The checkpoint folder
must be on shared storage.

By default a batch is not split into day folders: a stream writes many
batches, and batches x days makes many tiny files. Rows are sorted by day
inside the files instead, so a date filter still skips row groups by their
min/max statistics. Pass ``partition_by=("date",)`` for day folders.
"""

from __future__ import annotations

import datetime as _dt
import json
from collections.abc import Callable, Sequence

from pyspark.errors import StreamingQueryException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from skewsafe.operators.aggregate import aggregate_orders, with_run_timestamp
from skewsafe.schemas import ORDERS
from skewsafe.sinks.writers import write_batch


class StreamPaused(RuntimeError):
    """The stream was stopped on purpose between two batches."""


def orders_stream(spark: SparkSession, path: str, schema: T.StructType = ORDERS, fmt: str = "parquet",
                  max_files_per_trigger: int | None = None,
                  max_bytes_per_trigger: int | None = None) -> DataFrame:
    """Unbounded scan of order files dropped into ``path``.

    A micro-batch takes at most ``max_files_per_trigger`` files or about
    ``max_bytes_per_trigger`` bytes (Spark allows one of the two), so a
    backlog is worked off in bounded batches instead of one huge one.
    """
    if max_files_per_trigger and max_bytes_per_trigger:
        raise ValueError("give max_files_per_trigger or max_bytes_per_trigger, not both")
    reader = spark.readStream.format(fmt).schema(schema)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", int(max_files_per_trigger))
    if max_bytes_per_trigger:
        reader = reader.option("maxBytesPerTrigger", int(max_bytes_per_trigger))
    return reader.load(path)


def batch_budget(spark: SparkSession, path: str, batches: int) -> int:
    """``max_bytes_per_trigger`` that works off the files now in ``path`` in about ``batches`` micro-batches."""
    if batches < 1:
        raise ValueError("batches must be >= 1")
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    size = folder.getFileSystem(spark._jsc.hadoopConfiguration()).getContentSummary(folder).getLength()
    return max(1, -(-size // batches))


def stream_identity(spark: SparkSession, checkpoint_path: str) -> str:
    """The id that Spark keeps in a stream's checkpoint: the same after a restart, new for a new checkpoint."""
    row = spark.read.text(f"{checkpoint_path.rstrip('/')}/metadata").first()
    return json.loads(row["value"])["id"]


def append_stream(
    stream: DataFrame,
    target_path: str,
    checkpoint_path: str,
    aggregate: Callable[[DataFrame], DataFrame] = aggregate_orders,
    partition_by: Sequence[str] = (),
    cluster_by: Sequence[str] = ("date", "partition_key", "customer_id"),
    available_now: bool = True,
    processing_time: str | None = None,
    fmt: str = "parquet",
    run_ts: _dt.datetime | None = None,
    stop_after: int | None = None,
) -> StreamingQuery:
    """Start the stream: ``aggregate`` each batch, stamp it (P1), write it as batch ``epoch_id`` of this stream.

    ``stop_after`` ends the run with a :class:`StreamPaused` error before that many
    batches are passed, for planned restarts: the next run goes on from the checkpoint.
    """
    written: list[int] = []
    identity: list[str] = []

    def write(batch: DataFrame, epoch_id: int) -> None:
        if not identity:
            identity.append(stream_identity(batch.sparkSession, checkpoint_path))
        if stop_after is not None and len(written) >= stop_after:
            raise StreamPaused(f"stopped after {stop_after} batches, before batch {epoch_id}")
        written.append(epoch_id)
        result = with_run_timestamp(aggregate(batch), run_ts)
        write_batch(result, target_path, epoch_id, partition_by, cluster_by, fmt, stream_id=identity[0])

    writer = stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint_path)
    if processing_time:
        writer = writer.trigger(processingTime=processing_time)
    elif available_now:
        writer = writer.trigger(availableNow=True)
    return writer.start()


def run_append_stream(stream: DataFrame, target_path: str, checkpoint_path: str, **kw) -> None:
    """Process everything available (or ``stop_after`` batches), then stop; raises if the stream failed."""
    query = append_stream(stream, target_path, checkpoint_path, available_now=True, **kw)
    try:
        query.awaitTermination()
    except StreamingQueryException as failed:
        if kw.get("stop_after") is not None and StreamPaused.__name__ in str(failed):
            return
        raise
    if query.exception() is not None:
        raise RuntimeError(str(query.exception()))
