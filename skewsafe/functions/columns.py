"""Column expressions shared by the operators. All built-in, all codegen'd."""

from __future__ import annotations

import datetime as _dt
from collections.abc import Iterable, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

ColumnOrName = Column | str


def _c(c: ColumnOrName) -> Column:
    return F.col(c) if isinstance(c, str) else c


# Decimals kept of each amount. A DOUBLE amount enters as its shortest decimal
# form, so amounts with up to 12 decimals (below 10^16) add up exactly.
SUM_TYPE = "decimal(28,12)"


def _finite(c: ColumnOrName) -> Column:
    value = _c(c).cast("double")
    return ~F.isnan(value) & (F.abs(value) != F.lit(float("inf")))


def exact_part(c: ColumnOrName, as_type: str = SUM_TYPE) -> Column:
    """The finite amounts as exact decimals; NULL for NaN and infinities."""
    return F.when(_finite(c), _c(c).cast(as_type))


def special_part(c: ColumnOrName) -> Column:
    """NaN and infinite amounts; NULL for the finite ones."""
    return F.when(~_finite(c), _c(c).cast("double"))


def from_parts(exact: ColumnOrName, special: ColumnOrName) -> Column:
    """A sum from its two parts as DOUBLE, rounded once; NaN or infinity if any amount was."""
    return F.coalesce(_c(special), _c(exact).cast("double"))


def money_sum(c: ColumnOrName) -> Column:
    """Exact sum of money as the nearest DOUBLE.

    Adds decimals: the same whatever order rows arrive in, so partial sums
    (salting, re-adding batches) merge exactly, and parts below a cent count.
    A DOUBLE sum drifts with the row count. NaN, infinity and opposite
    infinities give what a DOUBLE sum gives. NULL when every input is NULL;
    an overflow raises (ANSI mode).
    """
    return from_parts(F.sum(exact_part(c)), F.sum(special_part(c)))


def exact_avg(c: ColumnOrName, as_type: str = SUM_TYPE) -> Column:
    """Order-independent average: the exact sum over the non-NULL count.

    ``AVG(double)`` differs in the last bits between runs and engines; a
    decimal sum does not.
    """
    return from_parts(F.sum(exact_part(c, as_type)), F.sum(special_part(c))) / F.count(_c(c))


def distinct_count(c: ColumnOrName, approx: bool = False, rsd: float = 0.05) -> Column:
    """``COUNT(DISTINCT c)``; ``approx=True`` uses HyperLogLog++ (fixed-size state, no expand)."""
    return F.approx_count_distinct(_c(c), rsd) if approx else F.countDistinct(_c(c))


def ratio(total: ColumnOrName, count: ColumnOrName) -> Column:
    """``total / count`` (P2). ``count`` is COUNT(*), so NULL amounts weigh 0."""
    return _c(total) / _c(count)


def percent(part: ColumnOrName, whole: ColumnOrName, digits: int = 2) -> Column:
    """``ROUND(part * 100 / whole, digits)`` with a DOUBLE literal."""
    return F.round(_c(part) * F.lit(100.0) / _c(whole), digits)


def null_flag(c: ColumnOrName) -> Column:
    """1 when NULL else 0 (P10)."""
    return F.when(_c(c).isNull(), 1).otherwise(0)


def as_date(c: ColumnOrName) -> Column:
    """``yyyy-MM-dd`` text to DATE; ANSI mode raises on malformed input."""
    return _c(c).cast("date")


def day_string(c: ColumnOrName) -> Column:
    """Timestamp or date to ``yyyy-MM-dd`` text."""
    return _c(c).cast("date").cast("string")


def run_timestamp(ts: _dt.datetime | None = None) -> Column:
    """One timestamp per run (P1): a fixed literal when given, else ``current_timestamp()``."""
    return F.lit(ts).cast("timestamp") if ts is not None else F.current_timestamp()


def salt(
    key: ColumnOrName,
    hot_keys: Iterable[object] | None,
    buckets: int,
    spread: Sequence[ColumnOrName],
) -> Column:
    """Salt in ``[0, buckets)`` for rows of hot keys, 0 for the rest.

    The salt hashes ``spread`` columns, which must not be grouping keys, so the
    rows of one group are split. Unlike ``rand()`` it is the same on every
    retry of a task. ``hot_keys=None`` salts every key.
    """
    if buckets < 1:
        raise ValueError("buckets must be >= 1")
    spread_salt = F.pmod(F.xxhash64(*[_c(s) for s in spread]), F.lit(buckets)).cast("int")
    if hot_keys is None:
        return spread_salt
    keys = list(hot_keys)
    if not keys:
        return F.lit(0)
    return F.when(_c(key).isin(keys), spread_salt).otherwise(F.lit(0))
