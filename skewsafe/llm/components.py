"""Connected components of a link table, distributed.

Alternating large-star and small-star steps: each step replaces links by links
to smaller nodes of the same component, until every component is a star around
its smallest node. A step is an aggregate with map-side combine and a join on
the same key; AQE splits the join of a hot node. Every round is written to the
shared folder, so lineage stays short and a lost executor costs one round at
most. Nothing is collected but two numbers per round (count and hash sum).
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skewsafe.llm.common import discard, staged


class UnionFind:
    """Plain union by smaller root with path halving, for one task's links."""

    def __init__(self) -> None:
        self.parent: dict[int, int] = {}

    def find(self, x: int) -> int:
        parent = self.parent
        parent.setdefault(x, x)
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    def union(self, a: int, b: int) -> bool:
        a, b = self.find(a), self.find(b)
        if a == b:
            return False
        self.parent[max(a, b)] = min(a, b)
        return True


def _forest(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The links of one partition that join something new: a spanning forest of them."""
    seen = UnionFind()
    for batch in batches:
        pairs = zip(batch.column(0).to_pylist(), batch.column(1).to_pylist())
        new = [(max(a, b), min(a, b)) for a, b in pairs if seen.union(a, b)]
        yield pa.RecordBatch.from_pydict(
            {"u": pa.array([x[0] for x in new], pa.int64()), "v": pa.array([x[1] for x in new], pa.int64())}
        )


def _fingerprint(links: DataFrame) -> tuple[int, int]:
    row = links.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
    return row[0], int(row[1] or 0)


def connected_components(links: DataFrame) -> DataFrame:
    """``node, root``: each linked node with the smallest node of its component.

    ``links`` has two bigint columns (any names; order, repeats and self-links do
    not matter). Nodes that appear in no link are not in the result; they are
    components of their own. No links: no rows.
    """
    u, v = links.columns
    links = links.where(F.col(u).isNotNull() & F.col(v).isNotNull() & (F.col(u) != F.col(v)))
    now = staged(links.select(u, v).mapInArrow(_forest, "u long, v long"), "links")
    state = _fingerprint(now)
    while state[0]:
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        large = staged(large, "links")
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        down = large.join(least, "u").where("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        last, now = now, staged(down.unionByName(least.withColumnRenamed("m", "v")).distinct(), "links")
        discard(last)
        discard(large)
        before, state = state, _fingerprint(now)
        if state == before:
            break
    node = now.select(F.col("u").alias("node"), F.col("v").alias("root"))
    return node.unionByName(now.select(F.col("v").alias("node"), F.col("v").alias("root"))).distinct()
