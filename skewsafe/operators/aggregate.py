"""Order aggregates.

All aggregates here are sum/count/min, which Spark splits into a partial
(map-side) and a final step, so even a hot group reaches the shuffle as one
row per map task. ``date`` is taken as ``MIN`` over a DATE (not a string):
string min/max buffers force ``SortAggregate``; DATE keeps ``HashAggregate``.
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skewsafe.functions.columns import (
    as_date,
    exact_part,
    from_parts,
    money_sum,
    ratio,
    run_timestamp,
    salt,
    special_part,
)
from skewsafe.schemas import GROUP_KEYS


def _finish(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Common tail: DATE back to text and ``avg_amount = total / count``."""
    return df.select(
        *keys,
        "total_amount",
        "order_count",
        F.col("_day").cast("string").alias("date"),
        ratio("total_amount", "order_count").alias("avg_amount"),
    )


def aggregate_orders(df: DataFrame, keys: Sequence[str] = GROUP_KEYS, by_date: bool = False) -> DataFrame:
    """Totals per group.

    Output: ``keys, total_amount, order_count, date, avg_amount``.
    ``total_amount`` is the exact sum as the nearest double, ``order_count`` counts rows
    (NULL amounts included), ``date`` is the group's first day.
    ``by_date=True`` adds ``date`` to the grouping keys.
    """
    group = list(by_date_keys(keys)) if by_date else list(keys)
    agg = df.groupBy(*group).agg(
        money_sum("amount").alias("total_amount"),
        F.count(F.lit(1)).alias("order_count"),
        F.min(as_date("date")).alias("_day"),
    )
    return _finish_by_date(agg, keys) if by_date else _finish(agg, keys)


def _finish_by_date(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    return df.select(
        *keys,
        "total_amount",
        "order_count",
        "date",
        ratio("total_amount", "order_count").alias("avg_amount"),
    )


def by_date_keys(keys: Sequence[str] = GROUP_KEYS) -> tuple[str, ...]:
    """Grouping keys used by ``aggregate_orders(..., by_date=True)``."""
    return (*keys, "date")


def aggregate_salted(
    df: DataFrame,
    hot_keys: Iterable[object] | None,
    salt_buckets: int = 10,
    keys: Sequence[str] = GROUP_KEYS,
    salt_key: str = "partition_key",
    spread: Sequence[str] = ("order_id", "amount"),
) -> DataFrame:
    """Salted two-phase aggregate (A6); same rows as :func:`aggregate_orders`.

    Phase 1 groups by ``keys + salt``: rows of a hot key are spread over
    ``salt_buckets`` groups by a hash of ``spread`` (non-key columns), so
    the hot groups go to several reducers. Phase 2 re-adds sums and counts
    by ``keys``. ``hot_keys=None`` salts every key.

    The salt is a deterministic hash, never ``rand()``: a retried task must
    send each row to the same group. With an empty ``hot_keys`` nothing is
    salted, so this is :func:`aggregate_orders` (one shuffle, not two).
    """
    hot = None if hot_keys is None else list(hot_keys)
    if hot is not None and not hot:
        return aggregate_orders(df, keys)
    salted = df.withColumn("_salt", salt(salt_key, hot, salt_buckets, list(spread)))
    phase1 = salted.groupBy(*keys, "_salt").agg(
        F.sum(exact_part("amount")).alias("_sum"),
        F.sum(special_part("amount")).alias("_special"),
        F.count(F.lit(1)).alias("_cnt"),
        F.min(as_date("date")).alias("_day"),
    )
    phase2 = phase1.groupBy(*keys).agg(
        from_parts(F.sum("_sum"), F.sum("_special")).alias("total_amount"),
        F.sum("_cnt").alias("order_count"),
        F.min("_day").alias("_day"),
    )
    return _finish(phase2, keys)


def order_list_pages(
    df: DataFrame,
    page_span: int = 10_000,
    keys: Sequence[str] = GROUP_KEYS,
    id_col: str = "order_id",
    with_sums: bool = False,
) -> DataFrame:
    """Sorted ``order_id`` list per group, in pages of ``page_span`` ids (A4).

    ``list_page = order_id div page_span``. ``order_list`` is the page's
    distinct ids (an array) and ``order_repeats`` says how often each occurs.
    Concatenating a group's pages in ``list_page`` order and repeating the ids
    gives the whole sorted list; no id is dropped.

    Repeats are counted first, and a page row holds at most ``page_span``
    entries however hot its group or id. The pages of one group are built by
    different tasks. Hardly any two rows are alike in keys and id, so a task
    that counted what it scanned would hold all of it in memory: the rows are
    first dealt into partitions of AQE's advisory size. They are dealt by a hash
    of keys and id, so copies meet, and AQE may still split those of a hot id:
    partial aggregation collapses them before the next shuffle.

    Output: ``keys, list_page, order_count, order_list, order_repeats``; ``with_sums=True``
    adds ``page_sum`` and ``page_special`` (exact and non-finite parts of the sum
    of ``amount``) and ``page_day`` (first day),
    from which :func:`totals_from_pages` rebuilds the group totals.
    """
    page = F.expr(f"`{id_col}` div {int(page_span)}").alias("list_page")
    id_aggs = [F.count(F.lit(1)).alias("_n")]
    page_aggs = [F.sum("_n").alias("order_count"),
                 F.sort_array(F.collect_list(F.struct(id_col, "_n"))).alias("_ids")]
    extra = []
    if with_sums:
        id_aggs += [F.sum(exact_part("amount")).alias("_sum"), F.sum(special_part("amount")).alias("_special"),
                    F.min(as_date("date")).alias("_day")]
        page_aggs += [F.sum("_sum").alias("page_sum"), F.sum("_special").alias("page_special"),
                      F.min("_day").alias("page_day")]
        extra = ["page_sum", "page_special", "page_day"]
    dealt = df.withColumn("_deal", F.hash(*keys, id_col)).hint("rebalance", "_deal")
    per_id = dealt.groupBy(*keys, page, id_col).agg(*id_aggs)
    pages = per_id.groupBy(*keys, "list_page").agg(*page_aggs)
    return pages.select(*keys, "list_page", "order_count", F.col("_ids")[id_col].alias("order_list"),
                        F.col("_ids")["_n"].alias("order_repeats"), *extra)


def totals_from_pages(pages: DataFrame, keys: Sequence[str] = GROUP_KEYS) -> DataFrame:
    """Group totals from ``order_list_pages(..., with_sums=True)`` output.

    Same rows as :func:`aggregate_orders` on the original rows (sums are
    re-added exactly). Reads only the key and sum columns, so
    a stored page table is scanned without its id lists.
    """
    agg = pages.groupBy(*keys).agg(
        from_parts(F.sum("page_sum"), F.sum("page_special")).alias("total_amount"),
        F.sum("order_count").alias("order_count"),
        F.min("page_day").alias("_day"),
    )
    return _finish(agg, keys)


def rollup_totals(df: DataFrame, keys: Sequence[str] = GROUP_KEYS) -> DataFrame:
    """Merge several rows per group (after appends) into one.

    Sums and counts are re-added; ``avg_amount`` is rebuilt from them, never
    averaged; ``date`` is the earliest.
    """
    agg = df.groupBy(*keys).agg(
        money_sum("total_amount").alias("total_amount"),
        F.sum("order_count").alias("order_count"),
        F.min(as_date("date")).alias("_day"),
    )
    return _finish(agg, keys)


def with_run_timestamp(df: DataFrame, ts: _dt.datetime | None = None) -> DataFrame:
    """Attach ``processed_timestamp`` after aggregation."""
    return df.withColumn("processed_timestamp", run_timestamp(ts))


def with_null_order_id(df: DataFrame) -> DataFrame:
    """Typed NULL ``order_id`` so v3 rows match the declared schema."""
    return df.withColumn("order_id", F.lit(None).cast("bigint"))
