"""Benchmark: the registered queries at ``$BENCH_SF_DIR`` on ``local[$BENCH_CPUS]``.

Each query's result is fully computed through the ``noop`` sink (nothing is
collected). Prints one JSON line:
``{"metric": "total_query_sec", "value": N, "unit": "sec", "queries": {...}, "sf": ...}``.
"""

from __future__ import annotations

import json
import os
import re
import sys
import tempfile
import time

from skewsafe.plans.registry import QUERIES
from skewsafe.session import build_session

# Headline queries first (plain vs salted aggregate), then the rest.
HEADLINE = ["agg_orders", "agg_salted_two_phase"]


def run(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def cpu_ticks() -> tuple[int, int] | None:
    """(user+system, steal) jiffies from /proc/stat, or None where it does not exist."""
    try:
        with open("/proc/stat") as f:
            fields = [int(x) for x in f.readline().split()[1:]]
        return fields[0] + fields[2], fields[7]
    except (OSError, IndexError, ValueError):
        return None


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    only = sys.argv[1:]
    extra = {"spark.driver.memory": os.environ.get("BENCH_DRIVER_MEMORY", "16g")}
    scratch = None
    if not os.environ.get("SPARK_CHECKPOINT_DIR"):
        scratch = tempfile.mkdtemp(prefix="skewsafe-bench-")
        extra["spark.checkpoint.dir"] = scratch
    else:
        extra["spark.checkpoint.dir"] = os.environ["SPARK_CHECKPOINT_DIR"]
    spark = build_session("skewsafe-bench", master=f"local[{cpus}]", shuffle_partitions=cpus * 4, extra=extra)
    spark.sparkContext.setLogLevel("ERROR")

    names = only or HEADLINE + [n for n in QUERIES if n not in HEADLINE]
    # Warm the JVM (class loading, JIT) on the smallest tables, once per code
    # path. Nothing is cached: each measured run reads its tables again.
    warm_dir = os.environ.get("BENCH_WARM_DIR", "/root/testdata/sf0.001")
    for name in names:
        run(QUERIES[name](spark, warm_dir))

    times: dict[str, float] = {}
    ticks0 = cpu_ticks()
    for name in names:
        t0 = time.perf_counter()
        run(QUERIES[name](spark, sf_dir))
        times[name] = round(time.perf_counter() - t0, 3)
        print(f"# {name}: {times[name]:.2f}s", file=sys.stderr, flush=True)
    ticks1 = cpu_ticks()
    spark.stop()
    # Host CPU steal during the measured runs, relative to the CPU time used:
    # on a shared host, a high value means the times above are inflated.
    steal = None
    if ticks0 and ticks1 and ticks1[0] > ticks0[0]:
        steal = round((ticks1[1] - ticks0[1]) / (ticks1[0] - ticks0[0]), 3)
    m = re.search(r"sf([0-9.]+)", sf_dir)
    print(json.dumps({
        "metric": "total_query_sec",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "sf": float(m.group(1)) if m else sf_dir,
        "cpus": cpus,
        "cpu_steal_per_busy": steal,
    }))


if __name__ == "__main__":
    main()
