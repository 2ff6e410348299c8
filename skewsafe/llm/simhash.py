"""Operator 4: near-duplicates by SimHash and multi-index hashing.

Texts shrink to 64-bit fingerprints where they are read; equal fingerprints are
one node from then on, so a group of exact copies of any size is one row.

Search: of two fingerprints at most 3 bits apart, one 32-bit half differs by at
most one bit. Every fingerprint is in the table of each half under that half's
value, and looks up all values within one bit of its own (33 per half). A match
is verified by the whole distance, in the join itself, so only links leave it.

A table entry with very many fingerprints (a hot half) would be compared with
all its visitors. For such entries the rest of the fingerprint is split the same
way: among 32 remaining bits with at most 3 differences one 16-bit part differs
by at most one bit, and then one 8-bit part of the 16 that remain. At that last
level an entry holds 256 fingerprints at most, so no group is unbounded and no
candidate is dropped.
"""

from __future__ import annotations

from itertools import repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf

from skewsafe.llm.common import staged
from skewsafe.llm.components import connected_components

SHINGLE, MAX_BITS, SEED = 3, 3, 42
#: Entries with more fingerprints than this are split at the next level.
HOT_ENTRY = 256
#: Width of the two parts that a level splits into.
LEVELS = (32, 16, 8)


def text_hashes(text: str, shingle: int = SHINGLE) -> np.ndarray:
    """XXH64 of each word shingle of the whole text, repeats included."""
    words = text.encode().lower().split()  # bytes: A-Z only, split at 0x20 and 0x09-0x0D
    if len(words) < shingle:
        shingles = [b" ".join(words)] if words else []
    else:
        shingles = list(map(b" ".join, zip(*(words[i:] for i in range(shingle)))))
    return np.fromiter(map(xxhash.xxh64_intdigest, shingles, repeat(SEED)), np.uint64, len(shingles))


_LANES = np.uint64(0x0101010101010101)


def majority(hashes: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Fingerprint of each run of ``hashes`` that ends before ``ends``: bits set in over half of the run.

    Counts eight bits per 64-bit addition: one byte lane each, over stretches of
    at most 255 hashes, which are then summed per run.
    """
    sizes = np.diff(ends, prepend=0)
    out = np.zeros(len(ends), dtype=np.uint64)
    full = np.flatnonzero(sizes)
    if not len(full):
        return out
    size, begin = sizes[full], ends[full] - sizes[full]
    stretches = -(-size // 255)
    first = np.cumsum(stretches) - stretches
    at = np.repeat(begin, stretches) + 255 * (np.arange(stretches.sum()) - np.repeat(first, stretches))
    for bit in range(8):
        lanes = np.add.reduceat((hashes >> np.uint64(bit)) & _LANES, at)
        counts = np.add.reduceat(lanes.view(np.uint8).reshape(-1, 8).astype(np.int64), first, axis=0)
        for lane in range(8):
            out[full] |= (2 * counts[:, lane] > size).astype(np.uint64) << np.uint64(8 * lane + bit)
    return out


def fingerprint(text: Column | str, shingle: int = SHINGLE) -> Column:
    """Column expression: the 64-bit fingerprint of each whole text as a (signed) long.

    Null and texts without a word have fingerprint zero; a text with fewer
    words than a shingle is one shingle.
    """

    @arrow_udf("long")
    def bits(texts: pa.Array) -> pa.Array:
        parts, done = [], [np.zeros(0, np.uint64)]
        total = 0
        ends: list[int] = []
        for t in texts:
            h = text_hashes(t.as_py() or "", shingle)
            parts.append(h)
            total += len(h)
            ends.append(total)
            if total > 1_000_000:
                done.append(majority(np.concatenate(parts), np.array(ends)))
                parts, ends, total = [], [], 0
        if ends:
            done.append(majority(np.concatenate(parts), np.array(ends)))
        return pa.array(np.concatenate(done).view(np.int64), pa.int64())

    return bits(F.col(text) if isinstance(text, str) else text)


def _flips(width: int) -> Column:
    """0 and every single bit of ``width``: what a value within one bit differs by."""
    return F.explode(F.array(*(F.lit(x).cast("long") for x in [0, *(1 << b for b in range(width))])))


def _split(rows: DataFrame, width: int, around: bool) -> DataFrame:
    """Both ``width``-bit parts of ``rest`` as ``(path, rest, fp)``; ``around``: all values within one bit."""
    mask = F.lit((1 << width) - 1).cast("long")
    low, high = F.col("rest").bitwiseAND(mask), F.shiftrightunsigned("rest", width).bitwiseAND(mask)
    part = F.explode(
        F.array(
            F.struct(F.lit(0).alias("no"), low.alias("value"), high.alias("rest")),
            F.struct(F.lit(1).alias("no"), high.alias("value"), low.alias("rest")),
        )
    )
    rows = rows.select("path", "fp", part.alias("p"))
    value = F.col("p.value")
    if around:
        rows = rows.select("*", _flips(width).alias("flip"))
        value = value.bitwiseXOR(F.col("flip"))
    # A hash of (path, part, value): a collision adds a candidate, which the distance then rejects.
    return rows.select(F.xxhash64("path", "p.no", value).alias("path"), F.col("p.rest").alias("rest"), "fp")


def near_pairs(fingerprints: DataFrame, max_bits: int = MAX_BITS, hot_entry: int = HOT_ENTRY) -> DataFrame:
    """``a, b``: pairs ``a < b`` of the distinct longs in ``fp`` at most ``max_bits`` (<= 3) bits apart.

    Complete: every such pair is found at least once (it may come more than
    once). ``fingerprints`` must be a table: it is read several times.
    """
    if not 0 <= max_bits <= 3:
        raise ValueError("two parts per level and balls of one bit find distances up to 3")
    base = fingerprints.select(F.lit(0).cast("long").alias("path"), F.col("fp").alias("rest"), "fp")
    index, probes, found = base, base, None
    near = (F.col("a") < F.col("b")) & (F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= max_bits)
    for level, width in enumerate(LEVELS):
        index, probes = _split(index, width, False), _split(probes, width, True)
        last = level == len(LEVELS) - 1
        if not last:
            hot = staged(index.groupBy("path").agg(F.count("*").alias("n")).where(F.col("n") > hot_entry), "hot-entries")
            last = hot.isEmpty()
        cold_index, cold_probes = index, probes
        if not last:
            cold_index = index.join(hot, "path", "left_anti")
            index, probes = index.join(hot, "path", "left_semi"), probes.join(hot, "path", "left_semi")
        pairs = (
            cold_probes.select("path", F.col("fp").alias("a"))
            # Merge: the planner's size estimate does not see how many rows the balls make,
            # and would send them to every executor.
            .join(cold_index.select("path", F.col("fp").alias("b")).hint("merge"), "path")
            .where(near)
            .select("a", "b")
        )
        found = pairs if found is None else found.unionByName(pairs)
        if last:
            break
        index, probes = staged(index, "hot-index"), staged(probes, "hot-probes")
    return found


def components(docs: DataFrame, shingle: int = SHINGLE, max_bits: int = MAX_BITS) -> DataFrame:
    """``doc_id, fp, root, component_id`` of every row: documents linked by chains of near fingerprints.

    ``docs`` has ``doc_id`` and ``fp``. ``root`` is a fingerprint of the component
    and tells components apart; ``component_id`` is the smallest id of the
    component (null ids do not count; a component of null ids only has null),
    which two components share where one id occurs in both.
    """
    distinct = staged(docs.groupBy("fp").agg(F.min("doc_id").alias("first_id")), "fingerprints")
    roots = staged(connected_components(near_pairs(distinct.select("fp"), max_bits)), "roots")
    of = distinct.join(roots, F.col("fp") == F.col("node"), "left").select(
        "fp", "first_id", F.coalesce("root", "fp").alias("root")
    )
    least = of.groupBy("root").agg(F.min("first_id").alias("component_id"))
    ids = of.join(least, "root").select("fp", "root", "component_id")
    return docs.join(ids, "fp").select("doc_id", "fp", "root", "component_id")


def near_duplicates(docs: DataFrame, shingle: int = SHINGLE, max_bits: int = MAX_BITS, text: str = "text") -> DataFrame:
    """Every row's ``doc_id``, ``fingerprint`` (16 hex digits) and ``component_id``.

    One output row per input row; repeated rows have the same fingerprint, so
    the same component. Documents without a word (null, empty, white space)
    share fingerprint zero and are linked by it. An empty table gives no rows.
    """
    rows = staged(docs.select("doc_id", fingerprint(text, shingle).alias("fp")), "doc-fingerprints")
    return components(rows, shingle, max_bits).select(
        "doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id"
    )


def deduplicated(docs: DataFrame, shingle: int = SHINGLE, max_bits: int = MAX_BITS, text: str = "text") -> DataFrame:
    """One row of ``docs`` per component, all columns unchanged: the one with the smallest ``doc_id``.

    A component whose ids are all null, and rows that repeat the smallest id,
    keep the row whose text has the smallest hash. The texts are shuffled once,
    by (id, fingerprint), to drop the others.
    """
    name = "_fp"
    while name in docs.columns:
        name += "_"
    rows = staged(docs.withColumn(name, fingerprint(text, shingle)), "docs-fingerprints")
    found = staged(components(rows.select("doc_id", F.col(name).alias("fp")), shingle, max_bits), "components")
    # Several fingerprints of a component may carry its smallest id, or all ids may be null: one is chosen.
    keep = (
        found.where(F.col("doc_id").eqNullSafe(F.col("component_id")))
        .groupBy("root")
        .agg(F.min(F.struct("doc_id", "fp")).alias("_keep"))
        .select(F.col("_keep.doc_id").alias("_keep_id"), F.col("_keep.fp").alias("_keep_fp"))
    )
    kept = rows.join(keep, F.col("doc_id").eqNullSafe(F.col("_keep_id")) & (F.col(name) == F.col("_keep_fp")), "left_semi")
    # Repeated rows of one id: the row filter below is applied before the shuffle too.
    one = Window.partitionBy("doc_id", name).orderBy(F.xxhash64(text))
    return kept.withColumn("_n", F.row_number().over(one)).where("_n = 1").select(*docs.columns)
