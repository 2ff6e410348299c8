"""Helper for test_retries: runs jobs whose first task attempt fails, in a
session that retries tasks (``local[4,3]``). Prints one JSON line.

Usage: python -m tests.retry_job <sf_dir> <scratch>
"""

import datetime as dt
import json
import os
import sys

from pyspark import TaskContext
from pyspark.sql import functions as F
from pyspark.sql import types as T

from skewsafe.operators.aggregate import aggregate_orders, aggregate_salted, with_run_timestamp
from skewsafe.schemas import TARGET, with_field
from skewsafe.session import build_session
from skewsafe.sinks.writers import read_target, write_batch
from skewsafe.sources.tables import orders_from_tpch
from tools.compare import digest


def main() -> None:
    sf_dir, scratch = sys.argv[1], sys.argv[2]
    marks = os.path.join(scratch, "marks")
    os.makedirs(marks, exist_ok=True)
    spark = build_session("skewsafe-retry", master="local[4,3]", shuffle_partitions=4,
                          extra={"spark.checkpoint.dir": os.path.join(scratch, "shared")})
    spark.sparkContext.setLogLevel("OFF")

    @F.udf("double")
    def flaky(amount):  # test-only fault injection
        tc = TaskContext.get()
        if tc.attemptNumber() == 0 and tc.partitionId() == 0:
            open(os.path.join(marks, f"stage{tc.stageId()}"), "w").close()
            raise RuntimeError("injected task failure")
        return amount

    clean = orders_from_tpch(spark, sf_dir)
    faulty = clean.withColumn("amount", flaky("amount"))

    def rows(df):
        return digest([tuple(r) for r in df.collect()], df.columns)

    expected = rows(aggregate_orders(clean))
    salted_ok = rows(aggregate_salted(faulty, ["SKEWED_KEY"], 10)) == expected

    path = os.path.join(scratch, "table")
    write_batch(with_run_timestamp(aggregate_orders(faulty), dt.datetime(2024, 1, 15, 12)), path, 0)
    back = read_target(spark, path, with_field(TARGET, "batch_id", T.LongType())).select(*aggregate_orders(clean).columns)
    write_ok = rows(back) == expected
    spark.stop()
    print(json.dumps({"salted_ok": salted_ok, "write_ok": write_ok, "failures": len(os.listdir(marks))}))


if __name__ == "__main__":
    main()
