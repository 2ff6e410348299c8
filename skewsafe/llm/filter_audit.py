"""Operator 11: filter interaction audit by incremental retraction streaming.

All files of the documents are processed as available-now micro-batches of a
Structured Streaming query. Each document becomes a mask of the filters that it
fails; four depend on its text alone. The fifth, "identical to the text of a
smaller id", depends on all files: a keyed state holds, for each text, the
smallest id seen so far and the counter cells of the documents that have it.

A batch adds its documents to the part counters as copies, moves those of the
smallest id of their text to the cells of originals, and, where a text's
smallest id falls, retracts the earlier originals: their cells lose them and the
cells of copies gain them. Every batch writes its own folder of state changes
and of counter changes, so a replayed batch replaces what it wrote, and the sum
of all counter changes is the same however the files are dealt out.

Only counts leave a batch: the partial minimum per text and the partial sums per
cell are taken before any shuffle, and documents meet their text's minimum on
(text, id), so a text that a third of all documents share is spread like any.
"""

from __future__ import annotations

import json
from functools import reduce
from itertools import permutations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from skewsafe.llm.common import staged
from skewsafe.session import shared_dir

FILTERS = "ABCDE"
COPY = 16  # the bit of E
#: The files are dealt out to about this many micro-batches.
BATCHES = 4
CELL = ["part", "mask", "good", "toxic"]
CELL_TYPE = "part string, mask int, good boolean, toxic boolean, n long"
RESULT = ("part string, filter_order string, step int, kept long, removed long, redundant long, unique_fails long, "
          "good_lost long, toxic_lost long, shapley long")  # fmt: skip


def text_mask(text: str = "text"):
    """Bits 1, 2, 4, 8: the text (null: empty) fails filter A, B, C, D."""
    text = F.coalesce(F.col(text), F.lit(""))
    words = F.filter(F.split(text, r"[ \x09-\x0D]+"), lambda w: w != "")
    n, distinct = F.size(words), F.size(F.array_distinct(words))
    fails = [
        n < 50,
        100 * distinct.cast("long") < 65 * n.cast("long"),
        100 * F.regexp_count(text, F.lit("[A-Z]")).cast("long") > 5 * F.length(text).cast("long"),
        text.rlike(r"[#$%&*|]"),
    ]
    return reduce(lambda a, b: a + b, (F.when(f, 1 << i).otherwise(0) for i, f in enumerate(fails)))


def marked(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``text_key, doc_id, part, mask, good, toxic`` of each row; labels of several rows count if any says so."""
    known = labels.where("doc_id IS NOT NULL").groupBy("doc_id").agg(
        F.coalesce(F.max(F.col("quality") == 1), F.lit(False)).alias("good"),
        F.coalesce(F.max(F.col("toxic") == 1), F.lit(False)).alias("toxic"),
    )
    rows = docs.select(
        F.unhex(F.sha2(F.coalesce("text", F.lit("")).cast("binary"), 256)).alias("text_key"), "doc_id",
        F.coalesce("source", F.lit("")).alias("part"), text_mask().alias("mask"),
    )
    return rows.join(known, "doc_id", "left").select(
        "text_key", "doc_id", "part", "mask",
        F.coalesce("good", F.lit(False)).alias("good"), F.coalesce("toxic", F.lit(False)).alias("toxic"),
    )


def _moved(cells: DataFrame, back: bool = False) -> DataFrame:
    """Counter changes of documents that turn from copies to originals (``back``: the other way)."""
    sign = -1 if back else 1
    changes = F.array(
        F.struct(F.col("mask").alias("mask"), (sign * F.col("n")).alias("n")),
        F.struct((F.col("mask") + COPY).alias("mask"), (-sign * F.col("n")).alias("n")),
    )
    return cells.select("part", "good", "toxic", F.explode(changes).alias("c")).select("part", "c.mask", "good", "toxic", "c.n")


class RetractionAudit:
    """Keyed text state and part counters below one shared folder, one sub-folder per micro-batch."""

    def __init__(self, spark: SparkSession, folder: str, labels: DataFrame, id_type: T.DataType):
        self.spark, self.folder, self.labels = spark, folder, labels
        key = T.StructType().add("text_key", "binary").add("doc_id", id_type)
        self.mark_type = key.add("part", "string").add("mask", "integer").add("good", "boolean").add("toxic", "boolean")
        self.state_type = T.StructType([*self.mark_type.fields]).add("n", "long")

    def _write(self, df: DataFrame, kind: str, batch: int) -> DataFrame:
        path = f"{self.folder}/{kind}/batch={batch}"
        df.write.mode("overwrite").parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def _earlier(self, kind: str, schema: T.StructType, batch: int) -> DataFrame:
        paths = [f"{self.folder}/{kind}/batch={n}" for n in range(batch)]
        return self.spark.read.schema(schema).parquet(*paths) if paths else self.spark.createDataFrame([], schema)

    def process(self, docs: DataFrame, batch: int) -> None:
        """One micro-batch; running it again with the same number replaces what it wrote."""
        # Read back in the session outside the stream, where AQE is on.
        marked(docs, self.labels).write.mode("overwrite").parquet(f"{self.folder}/marks/batch={batch}")
        marks = self.spark.read.schema(self.mark_type).parquet(f"{self.folder}/marks/batch={batch}")
        state = self._earlier("state", self.state_type, batch)

        smallest = marks.where("doc_id IS NOT NULL").groupBy("text_key").agg(F.min("doc_id").alias("doc_id"))
        before = state.groupBy("text_key").agg(F.min("doc_id").alias("before"))
        changed = smallest.join(before, "text_key", "left").where("before IS NULL OR doc_id <= before")
        changed = self._write(changed, "changed", batch)
        counted = marks.groupBy(*self.mark_type.fieldNames()).agg(F.count("*").alias("n"))
        firsts = counted.join(changed.drop("before"), ["text_key", "doc_id"]).select(*self.state_type.fieldNames())
        firsts = self._write(firsts, "state", batch)

        fallen = changed.where("doc_id < before").select("text_key", F.col("before").alias("doc_id"))
        retracted = state.join(fallen, ["text_key", "doc_id"])
        no_id = marks.where("doc_id IS NULL").groupBy(*CELL).agg(F.count("*").alias("n"))
        copies = marks.groupBy(*CELL).agg(F.count("*").alias("n")).withColumn("mask", F.col("mask") + COPY)
        changes = copies.unionByName(_moved(firsts)).unionByName(_moved(no_id)).unionByName(_moved(retracted, back=True))
        summed = changes.groupBy(*CELL).agg(F.sum("n").alias("n")).where("n != 0")
        self._write(summed, "counters", batch)

    def cells(self, batches: int) -> DataFrame:
        """``part, mask, good, toxic, n`` after ``batches`` micro-batches; 128 rows per part at most."""
        changes = self._earlier("counters", T._parse_datatype_string(CELL_TYPE), batches)
        return changes.groupBy(*CELL).agg(F.sum("n").alias("n")).where("n != 0")


def stream_cells(spark: SparkSession, path: str, labels: DataFrame, batches: int = BATCHES) -> DataFrame:
    """Counter cells of the documents table at ``path`` (a folder of Parquet files, or one file)."""
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    size = hadoop.getFileSystem(spark._jsc.hadoopConfiguration()).getContentSummary(hadoop).getLength()
    schema = spark.read.parquet(path).schema
    folder = shared_dir(spark, "llm", "filter-audit")
    audit = RetractionAudit(spark, folder, labels, schema["doc_id"].dataType)
    done: list[int] = []

    def process(docs: DataFrame, batch: int) -> None:
        audit.process(docs, batch)
        done.append(batch)

    # As a pattern, a path may name a folder or a single file.
    stream = spark.readStream.schema(schema).option("maxBytesPerTrigger", max(1, -(-size // batches)))
    writer = stream.parquet(f"{path[:-1]}[{path[-1]}]").writeStream.foreachBatch(process)
    query = writer.option("checkpointLocation", f"{folder}/checkpoint").trigger(availableNow=True).start()
    query.awaitTermination()
    return audit.cells(max(done) + 1 if done else 0)


def _steps() -> str:
    """JSON of all orders and steps: the bits of the filters before, and the step's own."""
    rows = []
    for order in permutations(range(len(FILTERS))):
        for i, f in enumerate(order):
            name = "".join(FILTERS[k] for k in order)
            rows.append({"filter_order": name, "step": i + 1, "before": sum(1 << k for k in order[:i]), "bit": 1 << f})
    return json.dumps(rows)


def audit(cells: DataFrame) -> DataFrame:
    """The 600 rows (``RESULT``) of each part, from its counter cells.

    What remains after a set of filters does not depend on their order, so a
    part's counts for the 32 sets give all orders.
    """

    def per_set(which: str) -> str:
        return ("transform(sequence(0, 31), s -> aggregate(cells, 0L, (total, c) -> "
                f"total + if((c.mask & s) = 0 AND {which}, c.n, 0L)))")  # fmt: skip

    parts = cells.groupBy("part").agg(F.collect_list(F.struct("mask", "good", "toxic", "n")).alias("cells"))
    parts = parts.select(
        "part", F.expr(per_set("true")).alias("k"), F.expr(per_set("c.good")).alias("g"), F.expr(per_set("c.toxic")).alias("t"),
        F.expr("transform(sequence(0, 31), s -> aggregate(cells, 0L, (total, c) -> total + if(c.mask = s, c.n, 0L)))").alias("only"),
    )
    # Before a step its earlier filters can stand in |S|! orders, the later ones in (4 - |S|)!.
    shapley = ("aggregate(sequence(0, 31), 0L, (total, s) -> total + if((s & {bit}) = 0, "
               "element_at(array(24L, 6L, 4L, 6L, 24L), bit_count(s) + 1) * (k[s] - k[s | {bit}]), 0L))")  # fmt: skip
    parts = parts.withColumn("shapley", F.expr("map(" + ", ".join(f"{1 << i}, {shapley.format(bit=1 << i)}" for i in range(5)) + ")"))
    kind = "array<struct<filter_order:string,step:int,before:int,bit:int>>"
    rows = parts.withColumn("at", F.explode(F.from_json(F.lit(_steps()), kind))).select("*", "at.*")
    lost = "{0}[before] - {0}[before | bit]"
    return rows.selectExpr(
        "part", "filter_order", "step", "k[before | bit] AS kept", f"{lost.format('k')} AS removed",
        f"(k[0] - k[bit]) - ({lost.format('k')}) AS redundant", "only[bit] AS unique_fails",
        f"{lost.format('g')} AS good_lost", f"{lost.format('t')} AS toxic_lost", "shapley[bit] AS shapley",
    )


def audit_filters(spark: SparkSession, path: str, labels: DataFrame, batches: int = BATCHES) -> DataFrame:
    """All orders of the five filters over the documents at ``path`` (columns ``RESULT``).

    Null texts are empty; a null source is the part of the empty string. A row
    without an id is never a copy and makes none. Equal ids are not smaller than
    each other, so repeated rows of the smallest id are all originals. Columns
    other than ``doc_id, text, source`` are not read. A label row with null
    values says nothing. An empty table gives no rows.
    """
    return audit(staged(stream_cells(spark, path, labels, batches), "filter-cells"))
