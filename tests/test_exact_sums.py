"""Exact sums against ``math.fsum``, bit for bit, over the whole DOUBLE range."""

import math
import random
import struct

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from skewsafe.functions.columns import salt
from skewsafe.operators.exact import aggregate_orders_exact, exact_totals
from skewsafe.schemas import ORDERS

WIDE = [[4e-13] * 1000, [1e17], [1e17, 1.0, -1e17], [1e300, 1e-300, -1e300], [5e-324] * 7, [5e-324, 2.2250738585072014e-308, -5e-324],
        [1.7976931348623157e308, -1.7976931348623157e308, 3.0], [2.0**53, 1.0, 2.0**-60], [2.0**53, 1.0, -(2.0**-1000)],
        [2.0**53 + 2, 1.0], [2.0**53 + 2, 1.0, 2.0**-1074], [0.1] * 10, [0.1, 0.2], [-0.1, -0.2, 0.3], [0.0, -0.0], [1.0, -1.0],
        [2.0**k for k in range(-1074, 1023)], [-(2.0**k) for k in range(-1074, 1023, 7)], [1e16, 1.0, 1e-16], [3.0],
        [math.nextafter(2.0**44, 0), 2.0**44, -(2.0**-30)], [math.nextafter(2.0**k, 0) for k in range(-1000, 1000, 11)]]


def check(spark, lists):
    rows = [(f"k{n}", "c", i, a, "p", "2024-01-01") for n, amounts in enumerate(lists) for i, a in enumerate(amounts)]
    random.Random(1).shuffle(rows)
    df = spark.createDataFrame(rows, ORDERS).repartition(5)
    expected = {f"k{n}": math.fsum(a for a in amounts if a is not None) for n, amounts in enumerate(lists) if amounts}
    for form in (aggregate_orders_exact(df), aggregate_orders_exact(df, salt=salt("partition_key", None, 3, ["order_id"]))):
        got = {r["partition_key"]: r for r in form.collect()}
        for k, total in expected.items():
            assert struct.pack("<d", got[k]["total_amount"]) == struct.pack("<d", total + 0.0), (k, got[k]["total_amount"], total)
            assert got[k]["order_count"] == len(lists[int(k[1:])])


def test_listed_sums(spark):
    check(spark, WIDE)


number = st.one_of(st.floats(allow_nan=False, allow_infinity=False, width=64, min_value=-1e305, max_value=1e305),
                   st.integers(-(10**9), 10**9).map(lambda c: c / 100), st.integers(-1000, 1000).map(lambda k: math.ldexp(1.0, k)))


@settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(lists=st.lists(st.lists(number, min_size=1, max_size=30), min_size=20, max_size=40))
def test_random_sums(spark, lists):
    check(spark, lists)


def test_money_takes_the_short_way(spark):
    """Groups of one bin, many rows and both signs; sums whose highest limb is large."""
    r = random.Random(4)
    check(spark, [[r.randint(-10**7, 10**7) / 100 for _ in range(n)] for n in (1, 2, 3, 50, 400)] + [[2.0**25 - 2.0**-27] * 300, [-(2.0**25 - 2.0**-27)] * 299])


def test_special_amounts(spark):
    inf, nan = float("inf"), float("nan")
    cases = {"a": [None, None], "b": [inf, 1.0], "c": [inf, -inf], "d": [nan, 1.0], "e": [None, 2.5], "f": [0.0, None], "g": [-inf, 1e300]}
    rows = [(k, a) for k, amounts in cases.items() for a in amounts]
    df = spark.createDataFrame(rows, "k string, amount double")
    got = {r["k"]: r["total"] for r in exact_totals(df, ["k"]).collect()}
    assert got["a"] is None and got["b"] == inf and math.isnan(got["c"]) and math.isnan(got["d"])
    assert got["e"] == 2.5 and got["f"] == 0.0 and got["g"] == -inf
    assert exact_totals(df.where("false"), ["k"]).count() == 0
