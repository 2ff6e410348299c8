"""Operator 2: balanced contiguous shards from global byte prefix sums.

Native: DataFrame functions only. The texts are read once and shrink to
(id, size, checksum) in the scan; only those rows are shuffled. They are dealt
into ranges of the id order; the ranges' totals (one row per range, bounded by
the number of shuffle partitions) give each range its global offset; a running
sum inside a range gives each row's global byte position. A row belongs to the
shard whose equal byte target holds the row's midpoint, so shards are
contiguous in id order and differ from the target by less than the largest row.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from skewsafe.llm.common import staged

SHARDS = 16
#: Copies of equal rows travel in runs of at most so many.
RUN = 65_536


def sized(docs: DataFrame, text: str = "text") -> DataFrame:
    """``doc_id``, ``size`` (UTF-8 bytes plus 1; null text: 1) and ``text_crc32`` (null text: that of no bytes)."""
    body = F.coalesce(F.col(text), F.lit(""))
    return docs.select(
        "doc_id", (F.octet_length(body) + 1).cast("long").alias("size"), F.crc32(body.cast("binary")).alias("text_crc32")
    )


def shard_by_bytes(rows: DataFrame, shards: int = SHARDS) -> DataFrame:
    """``rows`` (``doc_id, size, text_crc32``) with ``shard`` and ``slot``.

    Order: ``doc_id`` (nulls first), then checksum, then size. Equal rows travel
    as runs of at most ``RUN`` copies until the end, so a row that is repeated a
    billion times is dealt over many ranges and never expanded by one task; each
    copy gets its own place. ``slot`` is the
    row's number in its shard, from 0 without gaps. No rows: no result rows.
    Shards stay empty when there are fewer rows than shards or one huge row.
    """
    spark = rows.sparkSession
    ranges = int(spark.conf.get("spark.sql.shuffle.partitions"))
    order = [F.col("doc_id").asc_nulls_first(), F.col("text_crc32"), F.col("size"), F.col("run")]
    counted = rows.groupBy("doc_id", "size", "text_crc32").agg(F.count("*").alias("all"))
    runs = counted.select("*", F.explode(F.expr(f"sequence(0L, (all - 1) div {RUN})")).alias("run"))
    merged = staged(
        runs.select("doc_id", "size", "text_crc32", "run", F.expr(f"least({RUN}L, all - run * {RUN}L)").alias("copies")),
        "shard-rows",
    )
    # The range of each row is written down: every later pass sees the same ranges.
    ranged = staged(
        merged.repartitionByRange(ranges, *order).withColumn("block", F.spark_partition_id()), "shard-ranges"
    )

    totals = ranged.groupBy("block").agg(F.sum(F.col("size") * F.col("copies")).alias("b"), F.sum("copies").alias("n"))
    # One row per range: a window over them all is bounded by the number of ranges.
    before = Window.orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.orderBy("block").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    offsets = totals.select(
        "block",
        F.coalesce(F.sum("b").over(before), F.lit(0)).alias("bytes_before"),
        F.coalesce(F.sum("n").over(before), F.lit(0)).alias("rows_before"),
        F.sum("b").over(everything).alias("total"),
    )
    inside = Window.partitionBy("block").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    placed = (
        ranged.withColumn("_bytes", F.coalesce(F.sum(F.col("size") * F.col("copies")).over(inside), F.lit(0)))
        .withColumn("_rows", F.coalesce(F.sum("copies").over(inside), F.lit(0)))
        .join(F.broadcast(offsets), "block")
        .select("*", F.explode(F.sequence(F.lit(0).cast("long"), F.col("copies") - 1)).alias("_copy"))
        .withColumn("_at", F.col("bytes_before") + F.col("_bytes") + F.col("_copy") * F.col("size"))
        .withColumn("_rank", F.col("rows_before") + F.col("_rows") + F.col("_copy"))
        # Integer arithmetic in decimals: a petabyte times twice the shards overflows a long.
        .withColumn(
            "shard",
            F.expr(
                f"cast((cast(2 * _at + size as decimal(38,0)) * {shards}) div (2 * total) as int)"
            ),
        )
    )
    firsts = placed.groupBy("shard").agg(F.min("_rank").alias("_first"))
    return placed.join(F.broadcast(firsts), "shard").select(
        "doc_id", "size", "text_crc32", "shard", (F.col("_rank") - F.col("_first")).alias("slot")
    )
