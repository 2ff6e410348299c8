"""Shared helpers: table access, code for the workers, staged (lineage-cutting) tables."""

from __future__ import annotations

import os
import tempfile
import zipfile

from pyspark.sql import DataFrame, SparkSession

import skewsafe
from skewsafe.session import shared_dir

_shipped: set[str] = set()


def ship_code(spark: SparkSession) -> None:
    """Give this package to the session's Python workers, once per application.

    Python functions of the operators are sent by reference, so a worker must
    be able to import the package even where it is not installed. Spark itself
    hands the archive from the driver to every executor, also to new ones.
    """
    context = spark.sparkContext
    if context.applicationId in _shipped:
        return
    root = os.path.dirname(skewsafe.__file__)
    archive = os.path.join(tempfile.mkdtemp(prefix="skewsafe-code-"), "skewsafe.zip")
    with zipfile.ZipFile(archive, "w") as z:
        for folder, _, names in sorted(os.walk(root)):
            for name in sorted(names):
                if name.endswith(".py"):
                    path = os.path.join(folder, name)
                    z.write(path, os.path.join("skewsafe", os.path.relpath(path, root)))
    context.addPyFile(archive)
    _shipped.add(context.applicationId)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """The parquet table ``name`` below ``sf_dir``, through Spark's reader."""
    ship_code(spark)
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def staged(df: DataFrame, label: str) -> DataFrame:
    """``df`` written once to the shared folder and read back.

    Cuts the lineage: later stages re-read the files, so a lost executor costs
    the tasks it ran and never the work before this point. The folder is below
    ``spark.checkpoint.dir``, which the cluster shares and cleans.
    """
    spark = df.sparkSession
    path = shared_dir(spark, "llm", label)
    df.write.parquet(path)
    table = spark.read.schema(df.schema).parquet(path)
    table.staged_path = path
    return table


def discard(table: DataFrame) -> None:
    """Delete the files of a ``staged`` table that nothing reads any more."""
    spark = table.sparkSession
    path = spark._jvm.org.apache.hadoop.fs.Path(table.staged_path)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
