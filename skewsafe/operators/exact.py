"""Sums of any DOUBLE amounts, rounded once (A2, A6 without a fixed scale).

A DOUBLE is cut into five signed limbs of 22 bits on a grid that depends on the
range (bin) of its exponent only, so limbs of one bin add up as integers: the
partial sums are exact whatever their order, and 2^41 rows of a group fit a
long (more raise, in ANSI mode). Groups are first summed by (keys, bin), with
map-side combine; ordinary amounts of a group share one or two bins. Then the
at most 49 bins of a group are put together and rounded once, to even. The
result equals ``math.fsum`` bit for bit, also for 4e-13, 1e300, subnormal
amounts and sums that cancel. All expressions are built in.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skewsafe.functions.columns import as_date, ratio
from skewsafe.schemas import GROUP_KEYS

LIMBS, BITS = 5, 22
#: Exponents of one bin; two limbs, so the grids of all bins coincide.
STRIDE = 2 * BITS
#: Weight of the lowest limb of bin 0: 54 bits below the smallest subnormal number.
LOWEST = -1074 - 54


def _finite(value: Column) -> Column:
    return ~F.isnan(value) & (F.abs(value) != float("inf"))


def exponent_bin(amount: Column) -> Column:
    """Bin of a finite amount other than 0 (an error of one in the logarithm has room); NULL for others."""
    top = F.floor(F.log2(F.abs(amount))) + 1074
    return F.when(_finite(amount) & (amount != 0), F.floor(top / STRIDE).cast("int"))


def limbs(amount: Column, bin_: Column) -> list[Column]:
    """The limbs of an amount of ``bin_``, lowest first; every step is exact."""
    shift = -(bin_ * STRIDE + LOWEST)
    half = F.floor(shift / 2)
    rest = amount * F.pow(F.lit(2.0), half) * F.pow(F.lit(2.0), shift - half)
    out = []
    for k in range(LIMBS - 1, -1, -1):
        weight = float(1 << (BITS * k))
        limb = (rest / weight).cast("long")
        rest = rest - limb.cast("double") * weight
        out.append(limb)
    return out[::-1]


# ``bins``: array of (bin, limbs). Digits of the whole number in base 2^22, lowest first, with the carry after the last.
_DIGITS = f"""
aggregate(
  sequence(2 * array_min(transform(bins, b -> b.bin)), 2 * array_max(transform(bins, b -> b.bin)) + {LIMBS + 3}),
  named_struct('carry', 0L, 'digits', cast(array() AS array<bigint>)),
  (s, i) -> transform(array(aggregate(bins, s.carry, (t, b) ->
      t + if(i - 2 * b.bin BETWEEN 0 AND {LIMBS - 1}, {{sign}} get(b.limbs, i - 2 * b.bin), 0L))),
    t -> named_struct('carry', shiftright(t, {BITS}), 'digits', array_append(s.digits, t & {(1 << BITS) - 1}L)))[0])
"""


def _rounded(bins: str) -> str:
    """SQL of the DOUBLE nearest to the number whose ``bins`` are given."""
    positive, negative = (_DIGITS.format(sign=s).replace("bins", bins) for s in ("", "-"))
    # The carry after the last digit is negative for a negative number, whose opposite is then taken.
    chosen = f"transform(array({positive}), p -> if(p.carry >= 0, named_struct('sign', 1.0D, 'd', p.digits), named_struct('sign', -1.0D, 'd', ({negative}).digits)))[0]"
    # Four digits from the highest other than 0 hold 67 bits or more; what is below them only matters as "more than nothing".
    high = "array_max(transform(n.d, (x, i) -> if(x != 0, i, -1)))"
    take = "cast(get(n.d, top - {k}) AS decimal(8,0)) * cast({w} AS decimal(20,0))"
    head = " + ".join(f"coalesce({take.format(k=k, w=1 << (BITS * (3 - k)))}, cast(0 AS decimal(28,0)))" for k in range(4))
    sticky = "if(exists(slice(n.d, 1, greatest(top - 3, 0)), x -> x != 0), 1, 0)"
    number = f"cast(cast(2 AS decimal(1,0)) * cast({head} AS decimal(32,0)) + cast({sticky} AS decimal(1,0)) AS double)"
    first = f"2 * array_min(transform({bins}, b -> b.bin))"
    power = f"({BITS} * (top - 3 + {first}) + {LOWEST - 1})"
    scaled = f"n.sign * {number} * pow(2.0D, floor({power} / 2)) * pow(2.0D, {power} - floor({power} / 2))"
    return (f"transform(array({chosen}), n -> transform(array({high}), top -> if(top < 0, 0.0D, {scaled}))[0])[0]")


def _one_bin(bins: str) -> str:
    """SQL of the same for ``bins`` that are all one bin, with a highest limb below 2^36: one decimal of 38 digits."""
    sums = [f"aggregate({bins}, 0L, (t, b) -> t + b.limbs[{k}])" for k in range(LIMBS)]
    number = " + ".join(f"cast({x} AS decimal(19,0)) * cast({1 << (BITS * k)} AS decimal(27,0))" for k, x in enumerate(sums))
    power = f"({bins}[0].bin * {STRIDE} + {LOWEST})"
    return f"cast({number} AS double) * pow(2.0D, floor({power} / 2)) * pow(2.0D, {power} - floor({power} / 2))"


_SAME_BIN = f"array_min(transform({{0}}, b -> b.bin)) = array_max(transform({{0}}, b -> b.bin)) AND forall({{0}}, b -> abs(b.limbs[{LIMBS - 1}]) < 68719476736L div size({{0}}))"


def exact_totals(df: DataFrame, keys: Sequence[str], amount: str = "amount", spread: Column | None = None,
                 extra: dict[str, tuple[Column, str]] | None = None) -> DataFrame:
    """``keys, total`` and ``extra`` columns: the exact sum of ``amount`` per group as the nearest DOUBLE.

    ``spread`` (for example a salt) splits each group in the first phase.
    ``extra`` names more aggregates: the first phase's expression and the SQL
    function that merges its results. NaN, infinities and opposite infinities
    give what a DOUBLE sum gives; NULL when every amount is NULL.
    """
    value = F.col(amount).cast("double")
    rows = df.withColumn("_value", value).withColumn("_bin", exponent_bin(F.col("_value")))
    first_keys = [*keys, "_bin"]
    if spread is not None:
        rows, first_keys = rows.withColumn("_spread", spread), [*first_keys, "_spread"]
    sums = [F.coalesce(F.sum(limb), F.lit(0)).alias(f"_l{k}") for k, limb in enumerate(limbs(F.col("_value"), F.col("_bin")))]
    merged = {name: how for name, (_, how) in (extra or {}).items()}
    first = rows.groupBy(*first_keys).agg(
        *sums, F.count("_value").alias("_known"), F.sum(F.when(~_finite(F.col("_value")), F.col("_value"))).alias("_special"),
        *(column.alias(name) for name, (column, _) in (extra or {}).items()),
    )
    entry = F.when(F.col("_bin").isNotNull(), F.struct(F.col("_bin").alias("bin"), F.array(*(f"_l{k}" for k in range(LIMBS))).alias("limbs")))
    second = first.groupBy(*keys).agg(
        F.collect_list(entry).alias("_bins"), F.sum("_known").alias("_known"), F.sum("_special").alias("_special"),
        *(F.call_function(how, F.col(name)).alias(name) for name, how in merged.items()),
    )
    total = F.when(F.col("_special").isNotNull(), F.col("_special")).when(F.col("_known") == 0, F.lit(None).cast("double"))
    total = total.when(F.size("_bins") == 0, F.lit(0.0)).when(F.expr(_SAME_BIN.format("_bins")), F.expr(_one_bin("_bins")))
    total = total.otherwise(F.expr(_rounded("_bins")))
    return second.select(*keys, total.alias("total"), *merged)


def aggregate_orders_exact(df: DataFrame, keys: Sequence[str] = GROUP_KEYS, salt: Column | None = None) -> DataFrame:
    """``aggregate_orders`` for amounts of any size: ``keys, total_amount, order_count, date, avg_amount``.

    ``salt`` (see ``functions.salt``) splits hot groups in the first phase; the
    rows are the same for any salt.
    """
    extra = {"order_count": (F.count(F.lit(1)), "sum"), "_day": (F.min(as_date("date")), "min")}
    totals = exact_totals(df, keys, "amount", salt, extra)
    return totals.select(*keys, F.col("total").alias("total_amount"), "order_count", F.col("_day").cast("string").alias("date"),
                         ratio("total", "order_count").alias("avg_amount"))
