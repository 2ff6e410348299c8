"""Skew sweep: wall time and task-time spread, plain vs salted aggregate, over hot shares.

Task times come from Spark's event log, written to a fresh scratch folder.
Also compares the write layouts: ``REBALANCE`` vs ``repartition(4, key)``.

Usage: python -m tools.skew_sweep [sf_dir] > sweep.json
"""

from __future__ import annotations

import glob
import json
import os
import statistics
import sys
import tempfile
import time

from pyspark.sql import functions as F

from skewsafe.operators.aggregate import aggregate_orders, aggregate_salted
from skewsafe.session import build_session
from skewsafe.sources.tables import orders_from_tpch

# hot share -> (hot_mod, hot_below) for the adapter's `l_orderkey % hot_mod < hot_below`
SHARES = {"0": (10, 0), "0.5": (10, 5), "0.8": (10, 8), "0.99": (100, 99)}


def _stage_stats(log_dir: str) -> dict[str, dict]:
    """Per job description: wall ms and per-stage max / median task run time."""
    files = sorted(f for f in glob.glob(os.path.join(log_dir, "**", "*"), recursive=True) if os.path.isfile(f))
    jobs, stage_job, tasks = {}, {}, {}
    for f in files:
        for line in open(f):
            ev = json.loads(line)
            kind = ev["Event"]
            if kind == "SparkListenerJobStart":
                desc = (ev.get("Properties") or {}).get("spark.job.description")
                if desc:
                    for sid in ev["Stage IDs"]:
                        stage_job[sid] = desc
            elif kind == "SparkListenerTaskEnd":
                run_ms = ev["Task Metrics"]["Executor Run Time"] if ev.get("Task Metrics") else 0
                tasks.setdefault(ev["Stage ID"], []).append(run_ms)
    for sid, durations in tasks.items():
        desc = stage_job.get(sid)
        if desc is None:
            continue
        j = jobs.setdefault(desc, {"stages": 0, "max_task_ms": 0, "worst_max_over_median": 0.0})
        j["stages"] += 1
        mx, med = max(durations), statistics.median(durations)
        j["max_task_ms"] = max(j["max_task_ms"], mx)
        if len(durations) > 1 and med > 0:
            j["worst_max_over_median"] = round(max(j["worst_max_over_median"], mx / med), 2)
    return jobs


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    scratch = tempfile.mkdtemp(prefix="skewsafe-sweep-")
    log_dir = os.path.join(scratch, "events")
    os.makedirs(log_dir)
    spark = build_session("skewsafe-sweep", master="local[8]", shuffle_partitions=32, extra={
        "spark.eventLog.enabled": "true",
        "spark.eventLog.dir": log_dir,
        "spark.eventLog.compress": "false",
        "spark.checkpoint.dir": os.path.join(scratch, "shared"),
        "spark.driver.memory": "16g",
    })
    spark.sparkContext.setLogLevel("ERROR")
    wall: dict[str, float] = {}

    def timed(desc: str, action) -> None:
        spark.sparkContext.setJobDescription(desc)
        t0 = time.perf_counter()
        action()
        wall[desc] = round(time.perf_counter() - t0, 3)

    for share, (mod, below) in SHARES.items():
        rows = orders_from_tpch(spark, sf_dir, hot_mod=mod, hot_below=below)
        variants = {
            "plain": aggregate_orders(rows),
            "salted": aggregate_salted(rows, ["SKEWED_KEY"], 10),
            "plain_by_key": rows.groupBy("partition_key").agg(F.sum("amount"), F.count(F.lit(1))),
        }
        for name, df in variants.items():
            timed(f"{name}@{share}", lambda df=df: df.write.format("noop").mode("overwrite").save())

    v = aggregate_orders(orders_from_tpch(spark, sf_dir))
    out = os.path.join(scratch, "writes")
    timed("write_rebalance", lambda: v.hint("rebalance").write.parquet(out + "/a"))
    timed("write_repartition_by_key", lambda: v.repartition(4, "partition_key").write.parquet(out + "/b"))
    spark.stop()

    stats = _stage_stats(log_dir)
    result = {k: {"wall_sec": wall[k], **stats.get(k, {})} for k in wall}
    print(json.dumps({"sf_dir": sf_dir, "runs": result}, indent=1))


if __name__ == "__main__":
    main()
