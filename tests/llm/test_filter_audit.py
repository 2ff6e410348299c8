"""Filter audit: brute force over files whose smaller ids arrive later; replayed batches; odd rows."""

import itertools
import random
import re
from collections import defaultdict

from skewsafe.llm import filter_audit as A
from skewsafe.llm.common import ship_code
from tests.llm.helpers import ODD_TEXTS, SCHEMA

LABELS = "doc_id long, quality int, toxic int"


def brute_force(rows, labels):
    good = {d for d, q, _ in labels if q == 1} - {None}
    toxic = {d for d, _, t in labels if t == 1} - {None}
    first = {}
    for i, text, _, source, _ in rows:
        if i is not None:
            first[text or ""] = min(first.get(text or "", i), i)
    parts = defaultdict(list)
    for i, text, _, source, _ in rows:
        text = text or ""
        words = re.findall(r"[^\x20\x09-\x0D]+", text)
        fails = {
            "A": len(words) < 50, "B": 100 * len(set(words)) < 65 * len(words),
            "C": 100 * len(re.findall("[A-Z]", text)) > 5 * len(text), "D": bool(re.search("[#$%&*|]", text)),
            "E": i is not None and first[text] < i,
        }
        parts[source or ""].append((frozenset(f for f in fails if fails[f]), i in good, i in toxic))
    out = set()
    for part, docs in parts.items():
        removed_by = {}
        for order in itertools.permutations("ABCDE"):
            left = docs
            for step, f in enumerate(order, 1):
                gone = [d for d in left if f in d[0]]
                left = [d for d in left if f not in d[0]]
                failing = sum(f in d[0] for d in docs)
                removed_by["".join(order), step] = (part, "".join(order), step, len(left), len(gone), failing - len(gone),
                                                    sum(d[0] == {f} for d in docs), sum(d[1] for d in gone), sum(d[2] for d in gone))
        shapley = defaultdict(int)
        for (order, step), r in removed_by.items():
            shapley[order[step - 1]] += r[4]
        out |= {(*r, shapley[order[step - 1]]) for (order, step), r in removed_by.items()}
    return out


def rows_of(n, seed):
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(90)]
    texts = [*ODD_TEXTS, "CAPS ARE HERE " * 20, "a # b", *(" ".join(rng.choices(words, k=rng.choice([10, 60, 100]))) for _ in range(12)),
             *(" ".join(rng.sample(words, 70)) + rng.choice(["", " $", " A B C D E F G H I J K L M N"]) for _ in range(12))]
    out = []
    for i in range(n):
        doc = rng.choice([None, i, i, i, i // 2])
        out.append((doc, rng.choice(texts), "en", rng.choice([None, "", "s1", "s1", "s2"]), 1))
    return out


def written(spark, path, rows, files, extra=()):
    """One file after the other, the largest ids first."""
    ship_code(spark)
    ordered = sorted(rows, key=lambda r: -1 if r[0] is None else -r[0])
    for n in range(files):
        part = spark.createDataFrame(ordered[n::files] if extra else ordered[len(rows) * n // files:len(rows) * (n + 1) // files], SCHEMA)
        part.selectExpr("*", *extra).coalesce(1).write.mode("append").parquet(path)


def result(spark, path, labels, batches):
    rows = [tuple(r) for r in A.audit_filters(spark, path, spark.createDataFrame(labels, LABELS), batches).collect()]
    assert len(rows) == len(set(rows))
    return set(rows)


def test_smaller_ids_arrive_later(spark, scratch):
    rows = rows_of(150, 1)
    labels = [(i, i % 2, i % 3 == 0) for i in range(0, 150, 2)] + [(4, None, None), (None, 1, 1), (6, 1, 1), (6, 0, 0)]
    labels = [(d, q, None if t is None else int(t)) for d, q, t in labels]
    written(spark, f"{scratch}/documents.parquet", rows, 5)
    assert result(spark, f"{scratch}/documents.parquet", labels, 5) == brute_force(rows, labels)


def test_one_batch_extra_columns_and_no_labels(spark, scratch):
    rows = rows_of(60, 2) + rows_of(60, 2)
    written(spark, f"{scratch}/d.parquet", rows, 2, ("doc_id AS part", "'x' AS mask", "1 AS n", "true AS good", "'k' AS text_key"))
    assert result(spark, f"{scratch}/d.parquet", [], 1) == brute_force(rows, [])


def test_empty_table(spark, scratch):
    ship_code(spark)
    spark.createDataFrame([], SCHEMA).write.parquet(f"{scratch}/d.parquet")
    assert result(spark, f"{scratch}/d.parquet", [], 3) == set()


def test_a_replayed_batch_changes_nothing(spark, scratch):
    """A batch that ran before its checkpoint was written runs again: the same counters."""
    ship_code(spark)
    rows = rows_of(90, 3)
    rows.sort(key=lambda r: -1 if r[0] is None else -r[0])
    labels = [(i, i % 2, i % 3 % 2) for i in range(90)]
    table = spark.createDataFrame(labels, LABELS)
    audit = A.RetractionAudit(spark, scratch, table, spark.createDataFrame(rows, SCHEMA).schema["doc_id"].dataType)
    for batch, part in enumerate((rows[:30], rows[30:60], rows[60:])):
        for _ in range(2):
            audit.process(spark.createDataFrame(part, SCHEMA), batch)
    got = {tuple(r) for r in A.audit(audit.cells(3)).collect()}
    assert got == brute_force(rows, labels)
    retracted = spark.read.parquet(f"{scratch}/counters/batch=2").where("n < 0 AND mask < 16").count()
    assert retracted > 0
