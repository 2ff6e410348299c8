"""Edge rows."""

import datetime as dt

from pyspark.sql import functions as F

from skewsafe.operators import quality, reports
from skewsafe.operators.aggregate import aggregate_orders, aggregate_salted, by_date_keys
from skewsafe.operators.skew import detect_hot_keys, hot_key_list, skew_share
from skewsafe.schemas import ORDERS
from skewsafe.sinks.writers import align_to_schema
from skewsafe.schemas import TARGET_V3

ROWS = [
    ("SKEWED_KEY", "customer_1", 1, 10.0, "product_1", "2024-01-15"),
    ("SKEWED_KEY", "customer_1", 2, 20.5, "product_1", "2024-01-14"),
    ("SKEWED_KEY", "customer_1", 3, None, "product_1", "2024-01-16"),
    ("key_with_under_score", "customer_2", 4, 5.25, "product_2", "2024-01-15"),
    (None, "customer_3", 5, 7.0, "product_3", "2024-01-15"),
    (None, "customer_3", 6, 8.0, "product_3", "2024-01-15"),
    ("all_null", "customer_4", 7, None, "product_4", "2024-01-15"),
    ("all_null", "customer_4", 8, None, "product_4", "2024-01-15"),
    ("neg", "customer_5", 9, -3.0, "product_5", "2031-01-01"),
]


def _df(spark, rows=ROWS):
    return spark.createDataFrame(rows, ORDERS)


def _by_key(df):
    return {(r["partition_key"], r["customer_id"], r["product"]): r for r in df.collect()}


def test_empty_input_gives_no_groups(spark):
    empty = _df(spark, [])
    assert aggregate_orders(empty).count() == 0
    assert aggregate_salted(empty, None, 4).count() == 0
    assert quality.table_summary(empty.withColumn("total_amount", F.col("amount"))).first()["total_records"] == 0
    anomalies = quality.anomalies(aggregate_orders(empty), "2024-01-01").collect()
    assert sorted((r.check_type, r.anomaly_count) for r in anomalies) == [("Future dates", 0), ("Negative amounts", 0)]


def test_null_amounts_and_keys(spark):
    got = _by_key(aggregate_orders(_df(spark)))
    hot = got[("SKEWED_KEY", "customer_1", "product_1")]
    assert hot.total_amount == 30.5 and hot.order_count == 3
    assert abs(hot.avg_amount - 30.5 / 3) < 1e-12  # NULL amount weighs 0
    assert hot.date == "2024-01-14"  # earliest day of a multi-day group
    assert got[(None, "customer_3", "product_3")].order_count == 2
    allnull = got[("all_null", "customer_4", "product_4")]
    assert allnull.total_amount is None and allnull.avg_amount is None and allnull.order_count == 2
    assert got[("key_with_under_score", "customer_2", "product_2")].total_amount == 5.25


def test_salted_matches_plain_on_edges(spark):
    df = _df(spark)
    assert _by_key(aggregate_salted(df, ["SKEWED_KEY", None], 7)) == _by_key(aggregate_orders(df))
    assert _by_key(aggregate_salted(df, None, 3)) == _by_key(aggregate_orders(df))


def test_by_date_keeps_days_apart(spark):
    got = aggregate_orders(_df(spark), by_date=True)
    assert got.where("partition_key = 'SKEWED_KEY'").count() == 3
    assert by_date_keys() == ("partition_key", "customer_id", "product", "date")


def test_anomalies_and_completeness(spark):
    v = aggregate_orders(_df(spark))
    got = {r.check_type: r.anomaly_count for r in quality.anomalies(v, dt.date(2024, 12, 31)).collect()}
    assert got == {"Negative amounts": 1, "Future dates": 1}
    comp = {r.date: r for r in quality.completeness(_df(spark)).collect()}
    day = comp["2024-01-15"]
    assert day.total_records == 6 and day.null_amounts == 2
    assert day.unique_partitions == 3  # NULL key is not a distinct value
    assert day.unique_customers == 4


def test_skew_share_and_hot_keys(spark):
    df = _df(spark)
    share = {r.partition_key: r.percentage for r in skew_share(df).collect()}
    assert share["SKEWED_KEY"] == round(3 * 100.0 / 9, 2)
    assert abs(sum(share.values()) - 100) < 0.05
    hot = detect_hot_keys(df, min_share=0.3).collect()
    assert [r.partition_key for r in hot] == ["SKEWED_KEY"]
    assert hot_key_list(df, min_share=0.3) == ["SKEWED_KEY"]


def test_reports_tie_break_on_key(spark):
    v = aggregate_orders(_df(spark))
    dist = [r.partition_key for r in reports.partition_distribution(v).collect()]
    assert dist == sorted(dist, key=lambda k: (k is not None, k))  # one group each: key order, NULL first
    assert reports.top_customers(v, 2).count() == 2


def test_align_to_schema_fills_missing(spark):
    v = aggregate_orders(_df(spark)).withColumn("processed_timestamp", F.current_timestamp())
    aligned = align_to_schema(v, TARGET_V3)
    assert aligned.columns == TARGET_V3.fieldNames()
    assert aligned.where("order_id IS NOT NULL").count() == 0


def test_approx_distinct_is_close(spark):
    from skewsafe.sources.tables import orders_from_tpch
    from tests.conftest import SF_SMALL

    rows = orders_from_tpch(spark, SF_SMALL)
    exact = {r.date: r.unique_customers for r in quality.completeness(rows).collect()}
    approx = {r.date: r.unique_customers for r in quality.completeness(rows, approx=True).collect()}
    assert exact.keys() == approx.keys()
    assert all(abs(approx[d] - exact[d]) <= max(1, 0.15 * exact[d]) for d in exact)
    v = aggregate_orders(rows)
    assert reports.daily_metrics(v, approx=True).count() == reports.daily_metrics(v).count()
    exact_keys = quality.table_summary(v).first().unique_keys
    assert abs(quality.table_summary(v, approx=True).first().unique_keys - exact_keys) <= 1


def test_sizing_conf_scales_with_shuffle_volume():
    from skewsafe.session import sizing_conf

    small = sizing_conf(10 * 1024**2, total_cores=8)
    assert small["spark.sql.shuffle.partitions"] == "24"  # three waves at least
    big = sizing_conf(18 * 1024**4, total_cores=8000)
    assert int(big["spark.sql.shuffle.partitions"]) == 18 * 1024**4 // (200 * 1024**2) + 1


def test_listing_parallelism_follows_cores_unless_set(spark):
    from skewsafe.session import LISTING_PARALLELISM, configure_session

    assert spark.conf.get(LISTING_PARALLELISM) == str(spark.sparkContext.defaultParallelism)
    spark.conf.set(LISTING_PARALLELISM, "123")
    try:
        configure_session(spark)
        assert spark.conf.get(LISTING_PARALLELISM) == "123"
    finally:
        spark.conf.set(LISTING_PARALLELISM, str(spark.sparkContext.defaultParallelism))


def test_money_sum_is_exact_where_double_sum_drifts(spark):
    from decimal import Decimal

    from skewsafe.functions.columns import money_sum

    n = 1_000_000
    rows = spark.range(0, n, 1, 8).selectExpr("1234567.89 + (id % 7) * 0.01 AS amount").selectExpr(
        "CAST(amount AS DOUBLE) AS amount")
    exact = sum(Decimal("1234567.89") + Decimal(i % 7) / 100 for i in range(n))
    got = rows.agg(money_sum("amount").alias("s")).first()["s"]
    assert got == float(exact)
    drift = rows.agg(F.sum("amount").alias("s")).first()["s"]
    assert abs(drift - float(exact)) < 1  # the plain DOUBLE sum is only close
