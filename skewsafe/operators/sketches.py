"""Sketches that are stored with a batch and merged over batches.

Both kinds are built by map-side partial aggregation: a task sends one sketch of
bounded size per group, whatever the number of its rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Distinct-count sketches of 2^14 registers: standard error 0.65 %.
LG_REGISTERS = 14
#: Stated bound on the error of an estimate: more than four standard errors.
ERROR_BOUND = 0.03


def tracked_items(min_share: float) -> int:
    """Items a heavy-hitter sketch tracks, so that its error is far below ``min_share`` of the rows."""
    if not 0 < min_share <= 1:
        raise ValueError("min_share must be in (0, 1]")
    # The sketch holds at most 3/4 of a power of two counters; an estimate is off by about 1 / counters of the rows.
    return min(1_000_000, max(1000, int(100 / min_share)))


def heavy_sketch(df: DataFrame, key: str, min_share: float, by: Sequence[str] = ()) -> DataFrame:
    """``by, heavy_sketch, row_count``: the frequent values of ``key``, mergeable (one row without ``by``).

    NULL keys are counted in ``row_count`` only. ``min_share`` sets the size of the sketch.
    """
    items = tracked_items(min_share)
    return df.groupBy(*by).agg(F.expr(f"approx_top_k_accumulate({_quoted(key)}, {items})").alias("heavy_sketch"),
                               F.count(F.lit(1)).alias("row_count"))


def heavy_keys(sketches: DataFrame, min_share: float) -> list:
    """Keys that hold ``min_share`` of the rows of all ``sketches`` together, most frequent first.

    Merges the sketches (bounded size) and brings at most ``2 / min_share`` keys to
    the driver. A key with such a share is always among them; one slightly below
    it may be, which a conditional salt does not mind: its result is the same for
    any choice of keys.
    """
    items, most = tracked_items(min_share), int(2 / min_share)
    merged = sketches.agg(F.expr(f"approx_top_k_combine(heavy_sketch, {items})").alias("s"), F.sum("row_count").alias("n"))
    found = merged.where(F.col("n") > 0).select(F.explode(F.expr(f"approx_top_k_estimate(s, {most})")).alias("e"), "n")
    found = found.where(F.col("e.count") >= F.lit(min_share) * F.col("n")).where(F.col("e.item").isNotNull())
    return [r["item"] for r in found.select("e.item", "e.count").orderBy(F.desc("count"), "item").collect()]


def distinct_sketch(c: Column | str, lg: int = LG_REGISTERS) -> Column:
    """Aggregate: a sketch of the distinct values of ``c`` (NULLs not counted), at most 2^``lg`` bytes and a header."""
    return F.hll_sketch_agg(c, lg)


def daily_sketches(rows: DataFrame, columns: Sequence[str], day: str = "date") -> DataFrame:
    """``day, row_count`` and one distinct-count sketch ``<column>_sketch`` per column.

    A table of one row per day, to be stored with the batch; a later batch adds
    rows for its days and :func:`merged_estimates` puts them together.
    """
    return rows.groupBy(day).agg(F.count(F.lit(1)).alias("row_count"), *(distinct_sketch(c).alias(f"{c}_sketch") for c in columns))


def merged_estimates(sketches: DataFrame, columns: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """``by, row_count`` and ``<column>_estimate``: distinct counts over all sketches of a group.

    Exact daily counts cannot be added up (a customer of two days counts once);
    sketches can, in any order and any grouping.
    """
    return sketches.groupBy(*by).agg(
        F.coalesce(F.sum("row_count"), F.lit(0)).alias("row_count"),
        *(F.coalesce(F.hll_sketch_estimate(F.hll_union_agg(f"{c}_sketch")), F.lit(0)).alias(f"{c}_estimate") for c in columns),
    )


def within_bound(estimate: Column | str, exact: Column | str, bound: float = ERROR_BOUND) -> Column:
    """Whether an estimate is within ``bound`` of the exact count (at least one half)."""
    e, x = (F.col(c) if isinstance(c, str) else c for c in (estimate, exact))
    return F.abs(e - x) <= F.greatest(F.lit(0.5), F.lit(bound) * x)


def _quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"
