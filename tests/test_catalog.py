"""Catalog tables: whole overwrite by a switch, bucketed tables read without a shuffle."""

import datetime as dt
import os
import re
import uuid

import pytest
from pyspark.sql import functions as F

from skewsafe.operators.aggregate import aggregate_orders, rollup_totals, with_run_timestamp
from skewsafe.plans.inspect import count_nodes, plan_text
from skewsafe.schemas import ORDERS, TARGET
from skewsafe.session import conf_override, local_path
from skewsafe.sinks import versions as V
from skewsafe.sinks.writers import ensure_namespace, save_clustered_table
from skewsafe.sources.tables import orders_from_tpch
from tests.conftest import SF_SMALL
from tools.compare import digest

TS = dt.datetime(2024, 1, 15, 12, 0)


def groups(spark, days):
    rows = spark.createDataFrame([("k", f"c{i}", i, 1.5, "p", d) for i, d in enumerate(days)], ORDERS)
    return with_run_timestamp(aggregate_orders(rows), TS)


def days(table):
    return sorted(r["date"] for r in table.read().collect())


def test_overwrite_is_a_switch(spark, scratch, monkeypatch):
    table = V.ReplacedTable(spark, f"catalog_test.t{uuid.uuid4().hex[:12]}", TARGET, scratch)
    assert days(table) == [] and table.versions() == []
    assert table.overwrite(groups(spark, ["2024-01-01", "2024-01-02"])) == 2
    earlier = table.read()
    broken = groups(spark, ["2024-03-01"]).withColumn("order_count", F.raise_error(F.lit("lost")).cast("long"))
    with pytest.raises(Exception, match="lost"):
        table.overwrite(broken)
    assert days(table) == ["2024-01-01", "2024-01-02"]
    monkeypatch.setattr(V, "row_metrics", lambda columns: [F.count(F.lit(1)).alias("rows"), F.lit(uuid.uuid4().int % 10**9).alias("checksum")])
    with pytest.raises(V.WrongCopyError):
        table.overwrite(groups(spark, ["2024-04-01"]))
    monkeypatch.undo()
    assert days(table) == ["2024-01-01", "2024-01-02"]
    table.overwrite(groups(spark, ["2024-05-01"]))
    assert days(table) == ["2024-05-01"]
    assert earlier.count() == 2  # planned before the switch: its files are still there
    assert len(table.drop_old_versions()) >= 1 and len(table.versions()) == 1 and days(table) == ["2024-05-01"]
    assert table.overwrite(groups(spark, ["2024-05-01"]).where("false")) == 0 and days(table) == []


def test_clustered_table_without_a_shuffle(spark, scratch):
    ensure_namespace(spark, "clustered_test", scratch + "/_db")
    name, buckets = f"clustered_test.t{uuid.uuid4().hex[:12]}", 4
    rows = aggregate_orders(orders_from_tpch(spark, SF_SMALL))
    stored = rows.withColumn("date_year", F.substring("date", 1, 4))
    save_clustered_table(stored, name, buckets, partition_by=["date_year"], bucket_by=["customer_id"], location=scratch + "/table")
    years = stored.select("date_year").distinct().count()
    files = [f for _, _, found in os.walk(local_path(scratch) + "/table") for f in found if f.endswith(".parquet")]
    assert 0 < len(files) <= years * buckets
    totals = rollup_totals(spark.table(name), ["partition_key", "customer_id"])
    assert count_nodes(totals, "Exchange") == 0
    want = rollup_totals(rows, ["partition_key", "customer_id"])
    assert digest([tuple(r) for r in totals.collect()], totals.columns) == digest([tuple(r) for r in want.collect()], want.columns)
    one = spark.table(name).where(F.col("customer_id") == "customer_7")
    # Only a bucketed scan prints its buckets; a filter alone is planned as a plain scan of the same files.
    with conf_override(spark, {"spark.sql.sources.bucketing.autoBucketedScan.enabled": "false"}):
        assert re.search(r"SelectedBucketsCount: 1 out of 4", plan_text(one))
    assert one.count() == rows.where(F.col("customer_id") == "customer_7").count() > 0
    # Written again, the table holds the new rows only.
    save_clustered_table(stored.where("date_year = '1995'"), name, buckets, partition_by=["date_year"], bucket_by=["customer_id"], location=scratch + "/table")
    assert [r[0] for r in spark.table(name).select("date_year").distinct().collect()] == ["1995"]
