"""Tables and batches replaced without a gap: versions and a catalog switch.

A versioned table is an external catalog table partitioned by ``batch_id``. Each
write of a batch goes to a folder of its own; when the files are complete and
have been read back and compared, the catalog partition is pointed to that
folder. Until then, and if the write fails, readers see the earlier version.
Earlier versions stay until they are dropped.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from skewsafe.schemas import ddl
from skewsafe.sinks.writers import ensure_namespace


class WrongCopyError(RuntimeError):
    """The files read back are not the rows that were written; the table is as it was."""


def row_metrics(columns: Sequence[str]) -> list[Column]:
    """Row count and an order-free checksum of all values."""
    return [F.count(F.lit(1)).alias("rows"), F.coalesce(F.bit_xor(F.xxhash64(*columns)), F.lit(0)).alias("checksum")]


def write_checked(df: DataFrame, path: str, schema: T.StructType, sort_by: Sequence[str] = (), fmt: str = "parquet") -> int:
    """Write ``df`` to the fresh folder ``path`` and compare the files with what was written; returns the row count.

    The metrics are observed while the rows are written, so the plan of ``df``
    runs once; the comparison reads the copy.
    """
    seen = Observation()
    laid = df.select(*schema.fieldNames())
    if sort_by:
        laid = laid.hint("rebalance").sortWithinPartitions(*sort_by)
    # Observed in the writing tasks, which count once each; an earlier stage may run again after a lost executor.
    laid = laid.observe(seen, *row_metrics(schema.fieldNames()))
    laid.write.format(fmt).mode("errorifexists").save(path)
    written = seen.get
    stored = df.sparkSession.read.format(fmt).schema(schema).load(path).agg(*row_metrics(schema.fieldNames())).first()
    if (stored["rows"], stored["checksum"]) != (written["rows"], written["checksum"]):
        raise WrongCopyError(f"{path}: wrote {written}, read {stored.asDict()}")
    return stored["rows"]


def _folders(spark: SparkSession, folder: str) -> list[str]:
    """Names in ``folder``, sorted; none when it does not exist."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    files = path.getFileSystem(spark._jsc.hadoopConfiguration())
    return sorted(f.getPath().getName() for f in files.listStatus(path)) if files.exists(path) else []


class ReplacedTable:
    """A whole catalog table that is overwritten without ever being empty or half written.

    The table is external; each overwrite goes to a fresh folder below ``root``,
    is read back and compared, and one catalog change shows it. A failed or wrong
    write leaves the rows that readers see. A query already planned goes on
    with the files it listed: they stay until :meth:`drop_old_versions`.
    """

    def __init__(self, spark: SparkSession, name: str, schema: T.StructType, root: str, fmt: str = "parquet"):
        self.spark, self.name, self.schema, self.root, self.fmt = spark, name, schema, root.rstrip("/"), fmt
        if "." in name:
            ensure_namespace(spark, name.split(".")[0], f"{self.root}/_db")
        # The empty first folder is not a version.
        spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({ddl(schema)}) USING {fmt} LOCATION '{self.root}/none'")

    def overwrite(self, df: DataFrame, sort_by: Sequence[str] = ()) -> int:
        """Make ``df`` (possibly no rows) the whole table; returns its row count."""
        version = f"{self.root}/versions/{uuid.uuid4().hex}"
        rows = write_checked(df, version, self.schema, sort_by, self.fmt)
        self.spark.sql(f"ALTER TABLE {self.name} SET LOCATION '{version}'")
        self.spark.catalog.refreshTable(self.name)
        return rows

    def read(self) -> DataFrame:
        return self.spark.table(self.name)

    def current(self) -> str:
        """Folder that readers see."""
        rows = self.spark.sql(f"DESCRIBE FORMATTED {self.name}").collect()
        return next(r[1] for r in rows if r[0] == "Location")

    def versions(self) -> list[str]:
        """Names of the stored version folders, complete or not."""
        return _folders(self.spark, f"{self.root}/versions")

    def drop_old_versions(self) -> list[str]:
        """Delete every version that readers do not see; returns their names. For times without a writer."""
        seen = self.current().rstrip("/").rsplit("/", 1)[-1]
        dropped = [v for v in self.versions() if v != seen]
        for v in dropped:
            path = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.root}/versions/{v}")
            path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, True)
        return dropped


class VersionedTable:
    """A table of batches at ``root``, each batch one of its stored versions."""

    def __init__(self, spark: SparkSession, name: str, schema: T.StructType, root: str, fmt: str = "parquet"):
        self.spark, self.name, self.schema, self.root, self.fmt = spark, name, schema, root.rstrip("/"), fmt
        if "." in name:
            ensure_namespace(spark, name.split(".")[0], f"{self.root}/_db")
        spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({ddl(schema)}, batch_id BIGINT) USING {fmt} "
                  f"PARTITIONED BY (batch_id) LOCATION '{self.root}/batches'")

    def _folder(self, batch_id: int) -> str:
        return f"{self.root}/batches/batch_id={int(batch_id)}"

    def replace(self, df: DataFrame, batch_id: int, sort_by: Sequence[str] = ("date",)) -> int:
        """Make ``df`` (possibly no rows) the whole of batch ``batch_id``; returns its row count."""
        version = f"{self._folder(batch_id)}/version={uuid.uuid4().hex}"
        rows = write_checked(df, version, self.schema, sort_by, self.fmt)
        part = f"PARTITION (batch_id = {int(batch_id)})"
        # One change of the catalog makes the version visible; a new batch starts there.
        if self.current(batch_id) is None:
            self.spark.sql(f"ALTER TABLE {self.name} ADD {part} LOCATION '{version}'")
        else:
            self.spark.sql(f"ALTER TABLE {self.name} {part} SET LOCATION '{version}'")
        self.spark.catalog.refreshTable(self.name)
        return rows

    def read(self) -> DataFrame:
        return self.spark.table(self.name)

    def batches(self) -> list[int]:
        return sorted(int(r[0].split("=")[1]) for r in self.spark.sql(f"SHOW PARTITIONS {self.name}").collect())

    def current(self, batch_id: int) -> str | None:
        """Folder of the version that readers see."""
        if int(batch_id) not in self.batches():
            return None
        rows = self.spark.sql(f"DESCRIBE FORMATTED {self.name} PARTITION (batch_id = {int(batch_id)})").collect()
        return next(r[1] for r in rows if r[0] == "Location")

    def versions(self, batch_id: int) -> list[str]:
        """Names of the batch's stored version folders, complete or not."""
        return _folders(self.spark, self._folder(batch_id))

    def drop_old_versions(self, batch_id: int) -> list[str]:
        """Delete every version that readers do not see; returns their names. For times without a writer of this batch."""
        seen = (self.current(batch_id) or "").rstrip("/").rsplit("/", 1)[-1]
        dropped = [v for v in self.versions(batch_id) if v != seen]
        for v in dropped:
            path = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self._folder(batch_id)}/{v}")
            path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, True)
        return dropped
