"""Property tests: random order rows against a brute-force Python model.

Rows draw keys from a small alphabet (with NULL and a key holding ``_``),
repeated order ids, 2-decimal amounts (some NULL) and a few days, so groups
collide, ids repeat, and NULL paths are hit.
"""

from collections import defaultdict
from decimal import Decimal

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from pyspark.sql import types as T

from skewsafe.operators.aggregate import aggregate_orders, aggregate_salted, order_list_pages, with_run_timestamp
from skewsafe.schemas import ORDERS, TARGET, with_field
from skewsafe.session import shared_dir
from skewsafe.sinks.writers import read_target, write_batch
from skewsafe.sources.generator import second_batch
from tests.test_invariants import _expand
from tools.compare import digest

KEYS = ("partition_key", "customer_id", "product")

row = st.tuples(
    st.sampled_from(["SKEWED_KEY", "normal_key_1", "a_b", None]),
    st.sampled_from(["customer_1", "customer_2"]),
    st.integers(min_value=0, max_value=30),
    st.one_of(st.none(), st.integers(min_value=-5000, max_value=50000).map(lambda c: c / 100)),
    st.sampled_from(["product_1", "product_2"]),
    st.sampled_from(["2024-01-15", "2024-01-16", "1999-12-31"]),
)
rows_strategy = st.lists(row, min_size=0, max_size=60)
FAST = settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])


def _model(rows):
    groups = defaultdict(list)
    for r in rows:
        groups[(r[0], r[1], r[4])].append(r)
    out = {}
    for k, rs in groups.items():
        amounts = [Decimal(str(r[3])) for r in rs if r[3] is not None]
        total = float(sum(amounts)) if amounts else None
        out[k] = (total, len(rs), min(r[5] for r in rs), None if total is None else total / len(rs))
    return out


def _as_dict(df):
    return {tuple(r[k] for k in KEYS): (r["total_amount"], r["order_count"], r["date"], r["avg_amount"])
            for r in df.collect()}


@FAST
@given(rows=rows_strategy, buckets=st.integers(min_value=1, max_value=7),
       hot=st.sampled_from([None, [], ["SKEWED_KEY"], ["SKEWED_KEY", "a_b"]]))
def test_aggregates_match_brute_force(spark, rows, buckets, hot):
    df = spark.createDataFrame(rows, ORDERS)
    expected = _model(rows)
    assert _as_dict(aggregate_orders(df)) == expected
    assert _as_dict(aggregate_salted(df, hot, buckets)) == expected


@FAST
@given(rows=rows_strategy, span=st.integers(min_value=1, max_value=40))
def test_pages_expand_to_the_whole_list(spark, rows, span):
    df = spark.createDataFrame(rows, ORDERS)
    expected = defaultdict(list)
    for r in rows:
        expected[(r[0], r[1], r[4])].append(r[2])
    got = defaultdict(list)
    for p in order_list_pages(df, page_span=span).orderBy(*KEYS, "list_page").collect():
        ids = _expand(p)
        assert len(ids) == p["order_count"] and all(i // span == p["list_page"] for i in ids)
        got[tuple(p[k] for k in KEYS)].extend(ids)
    assert got == {k: sorted(v) for k, v in expected.items()}


@settings(max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(order=st.lists(st.integers(min_value=0, max_value=2), min_size=1, max_size=5))
def test_replayed_batches_are_stored_once(spark, order):
    """Any sequence of batch writes, with replays, stores each distinct batch exactly once."""
    v = with_run_timestamp(aggregate_orders(second_batch(spark, rows=300)))
    part = lambda k: v.where(F.pmod(F.xxhash64("customer_id"), F.lit(3)) == k)
    path = shared_dir(spark, "tests", "replay")
    for k in order:
        write_batch(part(k), path, k)
    stored = read_target(spark, path, with_field(TARGET, "batch_id", T.LongType())).drop("batch_id", "processed_timestamp")
    expected = v.where(F.pmod(F.xxhash64("customer_id"), F.lit(3)).isin(sorted(set(order)))).drop("processed_timestamp")
    assert digest([tuple(r) for r in stored.select(*expected.columns).collect()], expected.columns) == \
        digest([tuple(r) for r in expected.collect()], expected.columns)
