"""Operator 2."""

import zlib

from pyspark.sql import functions as F

from skewsafe.llm import sharding

from skewsafe.llm.registry import op2_sharding
from skewsafe.llm.sql import ORACLE_SQL
from tests.conftest import SF_SMALL

from .helpers import ODD_TEXTS, docs, no_docs


def shards_of(df, n=16):
    return sharding.shard_by_bytes(sharding.sized(df), n).collect()


def brute(rows, n):
    """Shard of each (id, size, crc) by the midpoint rule, in id order with nulls first."""
    ordered = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[2], r[1]))
    total, at, out, slots = sum(r[1] for r in rows), 0, [], {}
    for r in ordered:
        shard = (2 * at + r[1]) * n // (2 * total)
        out.append((*r, shard, slots.setdefault(shard, 0)))
        slots[shard] += 1
        at += r[1]
    return out


def test_shards_match_brute_force(spark):
    texts = [*ODD_TEXTS, *["copy of a text"] * 300, *("w" * (i % 97) for i in range(500))]
    got = sorted(map(tuple, shards_of(docs(spark, texts))))
    raw = [(i, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for i, t in enumerate(texts)]
    assert got == sorted(brute(raw, 16))


def test_sizes_are_near_equal(spark):
    texts = ["w" * (i * 7919 % 301) for i in range(3000)]
    sums = {}
    for r in shards_of(docs(spark, texts)):
        sums[r["shard"]] = sums.get(r["shard"], 0) + r["size"]
    assert sorted(sums) == list(range(16))
    target = sum(sums.values()) / 16
    assert all(abs(s - target) <= 302 for s in sums.values())


def test_null_and_repeated_ids(spark):
    ids = [None] * 200 + [7] * 200 + [8]
    rows = shards_of(docs(spark, ["same"] * 401, ids), 4)
    assert len(rows) == 401
    assert sorted((r["shard"], r["slot"]) for r in rows) == sorted(
        (s, i) for s in range(4) for i in range(sum(r["shard"] == s for r in rows))
    )
    assert max(sum(r["shard"] == s for r in rows) for s in range(4)) - min(
        sum(r["shard"] == s for r in rows) for s in range(4)
    ) <= 1


def test_many_copies_of_one_row_travel_in_runs(spark):
    n = 1_000_000
    many = spark.range(n + 3).selectExpr("if(id < %d, 5L, id) as doc_id" % n, "if(id < %d, 'x', 'yy') as text" % n)
    placed = sharding.shard_by_bytes(sharding.sized(many), 16)
    got = placed.groupBy("shard").agg(F.count("*").alias("n"), F.countDistinct("slot").alias("d"), F.max("slot").alias("m"))
    rows = got.collect()
    assert sum(r["n"] for r in rows) == n + 3 and len(rows) == 16
    assert all(r["n"] == r["d"] == r["m"] + 1 for r in rows)
    assert max(r["n"] for r in rows) - min(r["n"] for r in rows) <= 4
    assert placed.where("size = 2").count() == n


def test_no_rows(spark):
    assert shards_of(no_docs(spark)) == []


def test_plan_has_no_python(spark):
    df = sharding.shard_by_bytes(sharding.sized(docs(spark, ["a", "b"])))
    assert "Python" not in df._jdf.queryExecution().executedPlan().toString()


def test_oracle(spark, duck_small):
    def keyed(rows):
        return sorted(tuple(str(v) for v in r) for r in rows)

    assert keyed(op2_sharding(spark, SF_SMALL).collect()) == keyed(duck_small.execute(ORACLE_SQL["op2_sharding"]).fetchall())
