"""The whole run (J8): tables declared, v1, v2, v3, the append, the reports; resumable.

A run log in the run's folder holds one entry per finished phase. A run that
failed goes on after the last finished phase when it is started again with the
same folder: every phase replaces what an unfinished attempt of it left.
"""

from __future__ import annotations

import datetime as _dt
import time
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Row, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from skewsafe.operators import reports
from skewsafe.plans import jobs
from skewsafe.schemas import TARGET
from skewsafe.sinks.writers import create_target_tables, read_target, write_table

LOG = T.StructType().add("phase", "string").add("path", "string").add("row_count", "long").add("seconds", "double").add("finished_at", "timestamp")
REPORT = T.StructType().add("report", "string").add("position", "integer").add("line", "string")


class RunLog:
    """Finished phases of the run in ``base``, one small folder each, written when the phase is complete."""

    def __init__(self, spark: SparkSession, base: str):
        self.spark, self.path = spark, f"{base.rstrip('/')}/run_log"

    def read(self) -> DataFrame:
        return self.spark.read.schema(LOG).option("recursiveFileLookup", "true").parquet(self.path) if self._any() else self.spark.createDataFrame([], LOG)

    def _any(self) -> bool:
        path = self.spark._jvm.org.apache.hadoop.fs.Path(self.path)
        return path.getFileSystem(self.spark._jsc.hadoopConfiguration()).exists(path)

    def finished(self) -> dict[str, Row]:
        """At most one entry per phase."""
        return {r["phase"]: r for r in self.read().collect()}

    def run(self, phase: str, work: Callable[[], jobs.JobResult]) -> bool:
        """Do ``work`` unless the phase is finished; whether it was done now. An error leaves no entry."""
        if phase in self.finished():
            return False
        t0 = time.time()
        out = work()
        entry = (phase, out.path, out.rows, time.time() - t0, _dt.datetime.now())
        write_table(self.spark.createDataFrame([entry], LOG).coalesce(1), f"{self.path}/{phase}")
        return True


def money_text(c: str) -> Column:
    """An amount as text with six decimals (half up), the same on every run."""
    return F.col(c).cast("decimal(28,6)").cast("string")


def report_lines(name: str, report: DataFrame, order: list[Column], line: list[Column]) -> DataFrame:
    """A report as ``report, position, line``: values separated by tabs, NULL as ``-``.

    For reports of bounded size (top rows, a row per day): their positions are
    given in one task.
    """
    text = F.concat_ws("\t", *(F.coalesce(c.cast("string"), F.lit("-")) for c in line))
    position = F.row_number().over(Window.partitionBy(F.lit(name)).orderBy(*order)).cast("int")
    return report.select(F.lit(name).alias("report"), position.alias("position"), text.alias("line"))


def all_reports(final: DataFrame, v2: DataFrame) -> DataFrame:
    """The reports of a run over the v2 table and the final (appended) table, as lines."""
    most = [F.desc("record_count"), F.col("partition_key")]
    parts = [
        report_lines("partition_distribution", reports.partition_distribution(v2).limit(10), most,
                     [F.col("partition_key"), F.col("record_count")]),
        report_lines("top_partitions", reports.top_partitions(final), most,
                     [F.col("partition_key"), F.col("record_count"), money_text("avg_total_amount")]),
        report_lines("total_rows", reports.total_rows(final), [F.col("total")], [F.col("total")]),
        report_lines("top_customers", reports.top_customers(final), [F.desc("total_spent"), F.col("customer_id")],
                     [F.col("customer_id"), money_text("total_spent"), F.col("transaction_count")]),
        report_lines("daily_metrics", reports.daily_metrics(final), [F.col("date")],
                     [F.col("date"), F.col("unique_customers"), money_text("daily_revenue"), money_text("avg_order_value")]),
    ]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def print_report(lines: DataFrame, report: str, most: int = 20) -> list[str]:
    """Print the first ``most`` lines of a stored report (S16) and return them; never more reach the driver."""
    first = lines.where((F.col("report") == report) & (F.col("position") <= most)).orderBy("position")
    texts = [r["line"] for r in first.collect()]
    print(f"== {report}", *texts, sep="\n")
    return texts


def job_all(
    rows: DataFrame,
    later: DataFrame,
    base: str,
    database: str | None = None,
    since: str | None = None,
    key_source: DataFrame | None = None,
    run_ts: _dt.datetime | None = None,
    stop_session: bool = False,
) -> DataFrame | None:
    """J8 with J9's end: all phases in order, those already finished in ``base`` skipped; the stored report lines.

    ``database`` declares the target tables first (S11, S12). ``key_source``: see
    ``pipeline_v3``. ``stop_session=True`` stops the session when all is done
    (None is returned: read ``base/reports``); after an error it stays.
    """
    spark = rows.sparkSession
    base = base.rstrip("/")
    log = RunLog(spark, base)

    def declare() -> jobs.JobResult:
        names = create_target_tables(spark, database, ["orders_v1", "orders_v2", "orders_v3"], TARGET, location=f"{base}/declared")
        return jobs.JobResult("ddl", f"{base}/declared", len(names), 0.0)

    def write_reports() -> jobs.JobResult:
        final = read_target(spark, f"{base}/v3", jobs.TARGET_BATCHED)
        write_table(all_reports(final, read_target(spark, f"{base}/v2", TARGET)), f"{base}/reports")
        return jobs.JobResult("reports", f"{base}/reports", spark.read.schema(REPORT).parquet(f"{base}/reports").count(), 0.0)

    if database:
        log.run("ddl", declare)
    log.run("v1", lambda: jobs.pipeline_v1(rows, f"{base}/v1", run_ts=run_ts))
    log.run("v2", lambda: jobs.pipeline_v2(rows, f"{base}/v2", run_ts))
    log.run("v3", lambda: jobs.pipeline_v3(rows, f"{base}/v3", since=since, key_source=key_source, run_ts=run_ts))
    log.run("append", lambda: jobs.incremental_append(later, f"{base}/v3", 1, run_ts))
    log.run("reports", write_reports)
    if stop_session:
        spark.stop()
        return None
    return spark.read.schema(REPORT).parquet(f"{base}/reports")
