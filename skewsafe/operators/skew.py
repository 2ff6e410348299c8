"""Skew tools: key distribution, share per key, hot-key detection.

The grand total for a share comes from a scalar subquery over the
per-key counts, not from ``SUM(..) OVER ()``: an empty window spec moves
every row to one partition.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skewsafe.functions.columns import percent


def key_distribution(df: DataFrame, key: str = "partition_key") -> DataFrame:
    """``key, record_count`` (unordered)."""
    return df.groupBy(key).agg(F.count(F.lit(1)).alias("record_count"))


def skew_share(df: DataFrame, key: str = "partition_key", digits: int = 2) -> DataFrame:
    """``key, record_count, percentage``, largest first."""
    dist = key_distribution(df, key)
    total = dist.agg(F.sum("record_count")).scalar()
    return dist.select(
        key, "record_count", percent("record_count", total, digits).alias("percentage")
    ).orderBy(F.desc("record_count"), F.col(key))


def detect_hot_keys(df: DataFrame, key: str = "partition_key", min_share: float = 0.05) -> DataFrame:
    """Keys holding at least ``min_share`` of the rows: ``key, record_count, share``.

    At most ``floor(1 / min_share)`` keys can qualify, so the result has a
    proven size bound whatever the input size.
    """
    if not 0 < min_share <= 1:
        raise ValueError("min_share must be in (0, 1]")
    dist = key_distribution(df, key)
    total = dist.agg(F.sum("record_count")).scalar()
    return dist.where(F.col("record_count") >= F.lit(min_share) * total).select(
        key, "record_count", (F.col("record_count") / total).alias("share")
    )


def hot_key_list(df: DataFrame, key: str = "partition_key", min_share: float = 0.05,
                 sample_fraction: float | None = None, seed: int = 17) -> list:
    """Hot keys as a Python list; bounded by ``1 / min_share`` entries.

    ``sample_fraction`` estimates the shares from a seeded sample of ``df``.
    That is enough to choose keys to salt (the salted aggregate is exact for
    any choice); a key with a third of the rows is found from a small sample.
    """
    if sample_fraction is not None:
        df = df.sample(fraction=sample_fraction, seed=seed)
    bound = int(1 / min_share)
    rows = detect_hot_keys(df, key, min_share).orderBy(F.desc("record_count")).limit(bound + 1).collect()
    if len(rows) > bound:
        raise RuntimeError(f"more than {bound} keys hold {min_share} of the rows each")
    return [r[key] for r in rows]
