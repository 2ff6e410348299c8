"""One schema per table.

``order_id`` is BIGINT: order keys pass the INT range at large scale factors.
"""

from __future__ import annotations

from pyspark.sql import types as T

GROUP_KEYS: tuple[str, ...] = ("partition_key", "customer_id", "product")

# Staged order rows (the reference's ``temp_orders``).
ORDERS = T.StructType([
    T.StructField("partition_key", T.StringType(), True),
    T.StructField("customer_id", T.StringType(), True),
    T.StructField("order_id", T.LongType(), True),
    T.StructField("amount", T.DoubleType(), True),
    T.StructField("product", T.StringType(), True),
    T.StructField("date", T.StringType(), True),
])

# Aggregated target table as written by the v2 path and the appends.
TARGET = T.StructType([
    T.StructField("partition_key", T.StringType(), True),
    T.StructField("customer_id", T.StringType(), True),
    T.StructField("product", T.StringType(), True),
    T.StructField("total_amount", T.DoubleType(), True),
    T.StructField("order_count", T.LongType(), True),
    T.StructField("date", T.StringType(), True),
    T.StructField("processed_timestamp", T.TimestampType(), True),
    T.StructField("avg_amount", T.DoubleType(), True),
])

# The v3 table: TARGET plus the always-NULL ``order_id`` column.
TARGET_V3 = T.StructType(TARGET.fields + [T.StructField("order_id", T.LongType(), True)])

# Target tables as declared up front (S12): order rows plus a timestamp.
DECLARED_TARGET = T.StructType(ORDERS.fields + [T.StructField("processed_timestamp", T.TimestampType(), True)])


def with_field(schema: T.StructType, name: str, dtype: T.DataType) -> T.StructType:
    """``schema`` plus one nullable column (used for partition columns)."""
    return T.StructType(schema.fields + [T.StructField(name, dtype, True)])


def ddl(schema: T.StructType) -> str:
    """Column list for ``CREATE TABLE`` from a ``StructType``."""
    return ", ".join(f"`{f.name}` {f.dataType.simpleString().upper()}" for f in schema.fields)
