"""Deterministic skewed order generator.

Rows come from ``spark.range`` so they are produced on the executors and
nothing passes through the driver. Column ``k`` of row ``id`` is drawn from
the first 8 hex digits of ``md5(id || '-' || k)`` (k = 1 key, 2 customer,
3 order_id, 4 amount, 5 product), so every run and every retry gives the
same rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from skewsafe.sources.tables import CUSTOMER_PREFIX, HOT_KEY, NORMAL_KEY_PREFIX, PRODUCT_PREFIX

# Fixed values of the two batches (they must equal the original's domains).
# Main batch: 100 normal keys, order ids 100..1000, day 2024-01-15.
# Later batch: keys batch2_key_1..10, order ids 2000..3000, day 2024-01-16.
MAIN_KEYS, MAIN_ORDER_IDS, MAIN_DAY = 100, (100, 1000), "2024-01-15"
BATCH2_KEY_PREFIX, BATCH2_KEYS, BATCH2_ORDER_IDS, BATCH2_DAY = "batch2_key_", 10, (2000, 3000), "2024-01-16"


def _draw(k: int) -> Column:
    """Uniform non-negative integer below 2**32 for column ``k`` of row ``id``."""
    digest = F.md5(F.concat(F.col("id").cast("string"), F.lit(f"-{k}")))
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("bigint")


def generate_orders(
    spark: SparkSession,
    rows: int,
    hot_rows: int,
    key_prefix: str,
    key_count: int,
    order_lo: int,
    order_hi: int,
    day: str,
    customers: int = 100,
    products: int = 50,
    amount_lo_cents: int = 1000,
    amount_hi_cents: int = 50000,
    hot_key: str = HOT_KEY,
    num_partitions: int | None = None,
) -> DataFrame:
    """``rows`` order rows; rows ``id < hot_rows`` carry ``hot_key``."""
    normal = F.concat(F.lit(key_prefix), (_draw(1) % key_count + 1).cast("string"))
    key = F.when(F.col("id") < hot_rows, F.lit(hot_key)).otherwise(normal) if hot_rows > 0 else normal
    amount_span = amount_hi_cents - amount_lo_cents + 1
    return spark.range(0, rows, 1, num_partitions).select(
        key.alias("partition_key"),
        F.concat(F.lit(CUSTOMER_PREFIX), (_draw(2) % customers + 1).cast("string")).alias("customer_id"),
        (_draw(3) % (order_hi - order_lo + 1) + order_lo).cast("bigint").alias("order_id"),
        ((_draw(4) % amount_span + amount_lo_cents).cast("double") / 100).alias("amount"),
        F.concat(F.lit(PRODUCT_PREFIX), (_draw(5) % products + 1).cast("string")).alias("product"),
        F.lit(day).alias("date"),
    )


def skewed_orders(spark: SparkSession, rows: int = 10_000, hot_share: float = 0.8, **kw) -> DataFrame:
    """Main batch: ``hot_share`` of rows on the hot key, others on 100 keys."""
    return generate_orders(
        spark, rows, int(round(rows * hot_share)), NORMAL_KEY_PREFIX, MAIN_KEYS, *MAIN_ORDER_IDS, MAIN_DAY, **kw
    )


def second_batch(spark: SparkSession, rows: int = 1_000, **kw) -> DataFrame:
    """Later batch: 10 ``batch2_key_*`` keys, next day (S3)."""
    return generate_orders(spark, rows, 0, BATCH2_KEY_PREFIX, BATCH2_KEYS, *BATCH2_ORDER_IDS, BATCH2_DAY, **kw)
