"""Table scans (S6, S7, S14) and the order-row adapter over the driver tables.

Every reader selects the columns it needs right at the scan so Parquet reads
only those, and expresses date bounds on the stored column so they reach the
scan as ``PushedFilters``.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from skewsafe.functions.columns import day_string
from skewsafe.schemas import ORDERS

TABLES: tuple[str, ...] = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem",
    "events", "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
)

# Fixed values of the order-row mapping (reference proportions: 80% of rows on
# one hot key, 100 other keys, 100 customers, 50 products).
HOT_KEY = "SKEWED_KEY"
NORMAL_KEY_PREFIX = "normal_key_"
CUSTOMER_PREFIX = "customer_"
PRODUCT_PREFIX = "product_"
NORMAL_KEYS = 100
CUSTOMERS = 100
PRODUCTS = 50


def table_path(sf_dir: str, name: str) -> str:
    return f"{sf_dir.rstrip('/')}/{name}.parquet"


def read_table(spark: SparkSession, sf_dir: str, name: str, columns: list[str] | None = None) -> DataFrame:
    """Scan one driver table, optionally projecting columns at the scan."""
    df = spark.read.parquet(table_path(sf_dir, name))
    return df.select(*columns) if columns else df


def _day_start(day: str | _dt.date) -> Column:
    return F.lit(str(day)).cast("date").cast("timestamp_ntz")


def orders_from_tpch(
    spark: SparkSession,
    sf_dir: str,
    since: str | None = None,
    until: str | None = None,
    hot_mod: int = 10,
    hot_below: int = 8,
    sample_fraction: float | None = None,
    seed: int = 17,
    amount: str = "l_extendedprice",
) -> DataFrame:
    """Order rows (``ORDERS`` schema) from ``lineitem`` joined to ``orders``.

    One row per line item: ``partition_key`` is the hot key when
    ``l_orderkey % hot_mod < hot_below`` (80% by default), else one of 100
    normal keys; customer and product come from ``o_custkey`` and
    ``l_partkey``; ``amount`` is an expression over the line's price and
    discount (its price by default); ``date`` is the order day as
    ``yyyy-MM-dd``.

    ``since`` (inclusive) and ``until`` (exclusive) bound ``date``. They are
    applied to ``o_orderdate`` itself so Parquet skips row groups of
    ``orders``; ``lineitem``, which has no order date, is read whole.

    The join is an equi-join of two fact-sized tables on the order key (no
    key is hot there). Spark picks a broadcast only when its size estimate
    is under ``autoBroadcastJoinThreshold``; otherwise sort-merge, with AQE
    free to switch once it has measured the sides.

    ``sample_fraction`` keeps a seeded Bernoulli sample of the line items
    before the join (each line item joins one order, so it is a sample of
    the output rows too). It is for estimates such as hot-key detection,
    never for results.
    """
    li = read_table(spark, sf_dir, "lineitem", ["l_orderkey", "l_partkey", "l_extendedprice", "l_discount"])
    li = li.select("l_orderkey", "l_partkey", F.expr(amount).alias("_amount"))
    if sample_fraction is not None:
        li = li.sample(fraction=sample_fraction, seed=seed)
    od = read_table(spark, sf_dir, "orders", ["o_orderkey", "o_custkey", "o_orderdate"])
    if since is not None:
        od = od.where(F.col("o_orderdate") >= _day_start(since))
    if until is not None:
        od = od.where(F.col("o_orderdate") < _day_start(until))
    joined = li.join(od, li.l_orderkey == od.o_orderkey, "inner")
    return joined.select(
        _partition_key(hot_mod, hot_below).alias("partition_key"),
        F.concat(F.lit(CUSTOMER_PREFIX), (F.col("o_custkey") % CUSTOMERS + 1).cast("string")).alias("customer_id"),
        F.col("l_orderkey").cast("bigint").alias("order_id"),
        F.col("_amount").alias("amount"),
        F.concat(F.lit(PRODUCT_PREFIX), (F.col("l_partkey") % PRODUCTS + 1).cast("string")).alias("product"),
        day_string("o_orderdate").alias("date"),
    )


def _partition_key(hot_mod: int, hot_below: int):
    """The order row's key, from the order number of the line item."""
    return F.when(F.col("l_orderkey") % hot_mod < hot_below, F.lit(HOT_KEY)).otherwise(
        F.concat(F.lit(NORMAL_KEY_PREFIX), (F.col("l_orderkey") % NORMAL_KEYS + 1).cast("string"))
    )


def partition_keys_from_tpch(spark: SparkSession, sf_dir: str, hot_mod: int = 10, hot_below: int = 8) -> DataFrame:
    """``partition_key`` of every line item, from one column of ``lineitem``.

    For sketches of the keys: no join, no shuffle of rows, no other column read.
    """
    lines = read_table(spark, sf_dir, "lineitem", ["l_orderkey"])
    return lines.select(_partition_key(hot_mod, hot_below).alias("partition_key"))


def filter_since(df: DataFrame, since: str, date_col: str = "date") -> DataFrame:
    """``date >= since`` (S7, F1). On a stored ``date`` column it is pushed to the scan."""
    return df.where(F.col(date_col) >= F.lit(str(since)))


def read_staged_batch(spark: SparkSession, path: str, arrival: int, schema: T.StructType = ORDERS,
                      fmt: str = "parquet") -> DataFrame:
    """One batch of rows staged by ``sinks.stage_rows`` (a partition filter: only its folder is read)."""
    staged = T.StructType(schema.fields + [T.StructField("arrival", T.IntegerType(), True)])
    return spark.read.format(fmt).schema(staged).load(path).where(F.col("arrival") == int(arrival)).drop("arrival")


def plant_faults(df: DataFrame, null_every: int = 97, negate_every: int = 101) -> DataFrame:
    """Rows with planted faults for the quality checks.

    ``amount`` becomes NULL when ``order_id % null_every = 0`` and is negated
    when ``order_id % negate_every = 0``. Pure projection, no shuffle.
    """
    amount = (
        F.when(F.col("order_id") % null_every == 0, F.lit(None).cast("double"))
        .when(F.col("order_id") % negate_every == 0, -F.col("amount"))
        .otherwise(F.col("amount"))
    )
    return df.withColumn("amount", amount)


def preview(df: DataFrame, n: int = 10, order_by: list[str] | None = None) -> DataFrame:
    """First ``n`` rows (S14). With ``order_by`` it plans as a top-k, not a full sort."""
    if order_by:
        df = df.orderBy(*order_by)
    return df.limit(n)
