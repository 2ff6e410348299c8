"""The whole run: phases logged, resumed after a failure, reports bounded."""

import datetime as dt

import pytest

from skewsafe.plans import jobs, run
from skewsafe.sources.generator import second_batch, skewed_orders

TS = dt.datetime(2024, 1, 15, 12, 0)


def lines(df):
    return sorted(tuple(r) for r in df.collect())


def test_a_failed_run_goes_on_where_it_stopped(spark, scratch, monkeypatch, capsys):
    rows, later = skewed_orders(spark), second_batch(spark)
    calls = []
    whole = {name: getattr(jobs, name) for name in ("pipeline_v1", "pipeline_v2", "pipeline_v3", "incremental_append")}

    def counted(name):
        def work(*args, **kwargs):
            calls.append(name)
            if name == "pipeline_v3" and calls.count(name) == 1:
                whole[name](*args, **kwargs)  # written, but the phase is not finished
                raise RuntimeError("lost the cluster")
            return whole[name](*args, **kwargs)
        return work

    for name in whole:
        monkeypatch.setattr(jobs, name, counted(name))
    base = scratch + "/run"
    with pytest.raises(RuntimeError, match="lost the cluster"):
        run.job_all(rows, later, base, "run_all_test", run_ts=TS)
    log = run.RunLog(spark, base)
    assert sorted(log.finished()) == ["ddl", "v1", "v2"]
    done = run.job_all(rows, later, base, "run_all_test", run_ts=TS)
    assert calls == ["pipeline_v1", "pipeline_v2", "pipeline_v3", "pipeline_v3", "incremental_append"]
    assert sorted(log.finished()) == ["append", "ddl", "reports", "v1", "v2", "v3"]
    assert log.finished()["append"]["row_count"] == 5989 + 993
    assert sorted(t.name for t in spark.catalog.listTables("run_all_test")) == ["orders_v1", "orders_v2", "orders_v3"]
    # A finished run is left alone, and an unbroken run reports the same.
    assert lines(run.job_all(rows, later, base, "run_all_test", run_ts=TS)) == lines(done)
    assert len(calls) == 5
    assert lines(run.job_all(rows, later, scratch + "/other", run_ts=TS)) == lines(done)
    # Printed in order, never more lines than asked for.
    capsys.readouterr()
    printed = run.print_report(done, "top_customers", most=3)
    assert len(printed) == 3 and capsys.readouterr().out.splitlines() == ["== top_customers", *printed]
    assert [r["position"] for r in done.where("report = 'top_customers'").orderBy("position").collect()] == list(range(1, 11))


def test_a_run_without_rows(spark, scratch):
    rows = skewed_orders(spark).where("false")
    out = run.job_all(rows, rows, scratch + "/none", run_ts=TS)
    assert lines(out) == [("total_rows", 1, "0")]
