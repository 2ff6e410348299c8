"""Operator counts per registered query, as planned without broadcast joins (the 100 TB shape).

Usage: python -m tools.plan_review [sf_dir]

Write queries return a table read back from storage, so their plans show only
that read; they are skipped.
"""

from __future__ import annotations

import re
import sys
import tempfile

from skewsafe.plans.inspect import plan_text
from skewsafe.plans.registry import QUERIES
from skewsafe.session import build_session

NODES = ["Exchange", "BroadcastExchange", "SortMergeJoin", "BroadcastHashJoin", "HashAggregate",
         "ObjectHashAggregate", "SortAggregate", "Expand", "TakeOrderedAndProject", "Window", "Sample"]
WRITES = {"incremental_append", "append_by_name", "append_rollup", "write_partitioned_roundtrip",
          "write_clustered_roundtrip", "staged_publish", "stream_append_rollup", "catalog_append_by_name"}


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.001"
    spark = build_session("skewsafe-plans", master="local[8]", shuffle_partitions=32,
                          extra={"spark.checkpoint.dir": tempfile.mkdtemp(prefix="skewsafe-plans-")})
    spark.sparkContext.setLogLevel("ERROR")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    for name, query in QUERIES.items():
        if name in WRITES:
            continue
        text = plan_text(query(spark, sf_dir))
        main_plan = text.split("===== Subqueries =====")[0]
        counts = {n: len(re.findall(rf"^\(\d+\) {n}\b", main_plan, flags=re.M)) for n in NODES}
        extra = " +subquery" if "===== Subqueries =====" in text else ""
        print(f"{name:24s} " + " ".join(f"{n}={c}" for n, c in counts.items() if c) + extra)
    spark.stop()


if __name__ == "__main__":
    main()
