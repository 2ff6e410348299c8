"""Operator 1: best-fit packing by a configuration linear program.

Only the histogram of piece lengths (at most ``capacity`` numbers, whatever the
corpus holds) reaches the driver. There the configuration LP

    minimise sum_p x_p   subject to   sum_p a[p, l] * x_p >= n[l]  for each length l

(a configuration p is a multiset of lengths that fits one sequence) is solved by
multiplicative weights: a length's price falls exponentially with the share of
its demand that is covered, a knapsack dynamic program over the capacity prices
the best configuration for every forced first length at once, and each good
configuration raises its ``x_p``. Rounding down gives whole sequences; the
remaining pieces are packed best fit, configuration by configuration.

The plan maps (length, rank among the pieces of that length) to a sequence and
an offset. Ranks are counted in salted blocks, so neither a hot length nor the
corpus is ever ordered in one task, and the plan's size depends on the capacity
and the number of rounds, not on the corpus.
"""

from __future__ import annotations

import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf

from skewsafe.llm.common import staged
from skewsafe.llm.word_tokens import BATCH_CONF, text_ids
from skewsafe.session import conf_override

CAPACITY = 4096
ROUNDS = 24
#: Lengths below this fill gaps after rounding instead of entering the program.
FILLER = 64
#: Configurations within this share of the best price are used in a round.
SLACK = 0.005
#: Share of its scarcest length's demand that a configuration covers in a round.
STEP = 0.5
#: How fast a price falls with the covered share.
ETA = 2.0
#: A rank block holds about this share of all pieces at most.
BLOCKS = 1000


# --- tokens of the documents -------------------------------------------------

def _token_bytes(texts: pa.Array, path: str):
    """The little-endian uint32 ids of each text, as bytes."""
    for _, ids, at in text_ids(texts, path):
        for i in range(len(at) - 1):
            yield ids[at[i]:at[i + 1]].tobytes()


def token_pieces(
    docs: DataFrame,
    tokenizer_path: str,
    end_id: int = 1,
    capacity: int = CAPACITY,
    text: str = "text",
    with_ids: bool = False,
) -> DataFrame:
    """Each document's pieces: ``doc_id, piece, start, length, ids_crc32`` (and ``ids``).

    A document is its token ids followed by ``end_id`` (null text: empty, so
    ``end_id`` alone). Only documents longer than ``capacity`` are cut; all
    pieces but the last are full. Repeated rows give repeated pieces.
    """
    ids_type = ",ids:array<int>" if with_ids else ""
    end = np.array([end_id], dtype="<u4").tobytes()
    kinds = [pa.field("start", pa.int64()), pa.field("length", pa.int64()), pa.field("ids_crc32", pa.int64())]
    kinds += [pa.field("ids", pa.list_(pa.int32()))] if with_ids else []

    @arrow_udf(f"array<struct<start:long,length:long,ids_crc32:long{ids_type}>>")
    def cut(texts: pa.Array) -> pa.Array:
        offsets, starts, lengths, crcs, ids = [0], [], [], [], []
        for raw in _token_bytes(texts, tokenizer_path):
            raw += end
            for at in range(0, len(raw), 4 * capacity):
                part = raw[at:at + 4 * capacity]
                starts.append(at // 4)
                lengths.append(len(part) // 4)
                crcs.append(zlib.crc32(part))
                if with_ids:
                    ids.append(np.frombuffer(part, dtype="<i4"))
            offsets.append(len(starts))
        columns = [pa.array(x, pa.int64()) for x in (starts, lengths, crcs)]
        columns += [pa.array(ids, pa.list_(pa.int32()))] if with_ids else []
        return pa.ListArray.from_arrays(
            pa.array(offsets, pa.int32()), pa.StructArray.from_arrays(columns, fields=kinds)
        )

    return docs.select("doc_id", F.posexplode(cut(F.col(text))).alias("piece", "p")).select("doc_id", "piece", "p.*")


# --- the configuration linear program ----------------------------------------


def _prices_to_best(lengths: np.ndarray, price: np.ndarray, capacity: int) -> np.ndarray:
    """Unbounded knapsack: the best value of every capacity.

    Capacities are done in blocks no longer than the shortest length, so a
    block depends on earlier ones only and is one matrix operation.
    """
    shortest = int(lengths[0])
    block = min(shortest, 64)
    sizes = np.arange(shortest, capacity + 1)
    dense = np.full(capacity + 1, -np.inf)
    dense[lengths] = price
    dense = dense[shortest:]
    # padded[capacity + room] = best[room]; no value below room 0.
    padded = np.full(2 * capacity + 1 + block, -np.inf)
    best = padded[capacity:2 * capacity + 1]
    best[0] = 0.0
    step = padded.strides[0]
    for room in range(1, capacity + 1, block):
        n = min(block, capacity + 1 - room)
        # rests[r, s] = best[room + r - sizes[s]]
        rests = np.lib.stride_tricks.as_strided(
            padded[capacity + room - shortest:], (n, len(sizes)), (step, -step), writeable=False
        )
        best[room:room + n] = np.maximum.accumulate(np.maximum((rests + dense).max(axis=1), best[room - 1]))
    return best.copy()


def _configuration(
    i: int, size: np.ndarray, price: np.ndarray, best: np.ndarray, capacity: int
) -> Counter:
    """The best priced configuration that holds length number ``i``."""
    items, room = Counter([i]), capacity - int(size[i])
    while fits := int(np.searchsorted(size, room, side="right")):
        j = int((price[:fits] + best[room - size[:fits]]).argmax())
        items[j] += 1
        room -= int(size[j])
    return items


def solve_lp(
    lengths: np.ndarray, demand: np.ndarray, capacity: int = CAPACITY, rounds: int = ROUNDS
) -> list[tuple[Counter, float]]:
    """Fractional configurations (indices into ascending ``lengths``) by multiplicative weights.

    Starts from the volume prices ``length / capacity``. In each round every
    length may lead a configuration, best priced first; one priced near the best
    covers the share ``STEP`` of what its scarcest length still needs. What the
    rounds leave open is packed after rounding.
    """
    covered = np.zeros(len(lengths))
    solution: list[tuple[Counter, float]] = []
    large = lengths >= min(FILLER, capacity // 4)
    for _ in range(rounds):
        open_ = np.flatnonzero((covered < 1 - 1e-9) & large)
        if not len(open_):
            break
        size, need = lengths[open_], demand[open_].astype(float)
        price = size / capacity * np.exp(-ETA * covered[open_])
        best = _prices_to_best(size, price, capacity)
        values = price + best[capacity - size]
        for i in np.argsort(-values, kind="stable"):
            if values[i] < (1 - SLACK) * best[capacity]:
                break
            config = _configuration(int(i), size, price, best, capacity)
            at = np.fromiter(config, np.int64)
            share = np.fromiter(config.values(), float)
            x = STEP * float((need[at] * (1 - covered[open_[at]]) / share).min())
            covered[open_[at]] += x * share / need[at]
            if x > 1e-6:
                solution.append((Counter({int(open_[k]): n for k, n in config.items()}), x))
    return solution


def round_solution(
    solution: list[tuple[Counter, float]], lengths: np.ndarray, demand: np.ndarray, capacity: int = CAPACITY
) -> list[tuple[Counter, int]]:
    """Whole sequences: the LP's copies rounded down, then best fit for what is left.

    Covers every length exactly ``demand`` times.
    """
    left = demand.astype(np.int64).copy()
    merged: dict[tuple, float] = {}
    for config, x in solution:
        key = tuple(sorted(config.items()))
        merged[key] = merged.get(key, 0.0) + x
    out: list[tuple[Counter, int]] = []
    for key, x in merged.items():
        copies = min([int(x + 1e-9), *(int(left[i]) // n for i, n in key)])
        if copies:
            out.append((Counter(dict(key)), copies))
            for i, n in key:
                left[i] -= n * copies
    out += _best_fit(left, lengths, capacity)
    return out


def _best_fit(left: np.ndarray, lengths: np.ndarray, capacity: int) -> list[tuple[Counter, int]]:
    """Best-fit decreasing of the pieces in ``left``, as if piece by piece, done by counts.

    Sequences with equal contents are one entry with a count. Best fit puts a
    length into the fullest sequences that still take it, and goes on with the
    same sequence while it takes more; so a step fills a whole entry, and only
    the last one of a length is split. The steps depend on the number of lengths,
    not on the number of pieces.
    """
    # room -> entries (contents as (length number, pieces) pairs, copies) with that room
    open_at: dict[int, list[tuple[tuple, int]]] = {}
    mask = 0
    full: list[tuple[tuple, int]] = []

    def put(room: int, contents: tuple, copies: int) -> None:
        nonlocal mask
        if copies and room:
            open_at.setdefault(room, []).append((contents, copies))
            mask |= 1 << room
        elif copies:
            full.append((contents, copies))

    for i in range(len(lengths) - 1, -1, -1):
        size, n = int(lengths[i]), int(left[i])
        done: list[tuple[int, tuple, int]] = []  # filled as far as this length goes
        while n:
            if fits := mask >> size:
                room = size + (fits & -fits).bit_length() - 1
                contents, copies = open_at[room].pop()
                if not open_at[room]:
                    del open_at[room]
                    mask &= ~(1 << room)
            else:
                room, contents, copies = capacity, (), -(-n // (capacity // size))
            each = room // size
            filled, rest = min(copies, n // each), 0
            if filled < copies:
                rest = n - filled * each  # goes into one more copy; the others stay as they are
                if rest:
                    done.append((room - rest * size, (*contents, (i, rest)), 1))
                if untouched := copies - filled - (1 if rest else 0):
                    put(room, contents, untouched)
            if filled:
                done.append((room - each * size, (*contents, (i, each)), filled))
            n -= filled * each + rest
        for room, contents, copies in done:
            put(room, contents, copies)
    equal: Counter = Counter()
    for contents, copies in [*full, *(entry for entries in open_at.values() for entry in entries)]:
        equal[contents] += copies
    return [(Counter(dict(contents)), copies) for contents, copies in equal.items()]


def plan(histogram: dict[int, int], capacity: int = CAPACITY, rounds: int = ROUNDS) -> dict[str, np.ndarray]:
    """The packing plan as arrays, one entry per (length, configuration), by length and rank.

    ``start``: first rank of that length in the configuration's sequences;
    ``each``: pieces of that length per sequence; ``sequence``: the first of its
    sequences; ``offset``: place of the first piece.
    """
    lengths = np.array(sorted(histogram), dtype=np.int64)
    demand = np.array([histogram[int(x)] for x in lengths], dtype=np.int64)
    used = np.zeros(len(lengths), dtype=np.int64)
    sequence, rows = 0, []
    for config, copies in round_solution(solve_lp(lengths, demand, capacity, rounds), lengths, demand, capacity):
        offset = 0
        for i in sorted(config, reverse=True):
            rows.append((lengths[i], used[i], config[i], sequence, offset))
            used[i] += config[i] * copies
            offset += config[i] * int(lengths[i])
        sequence += copies
    table = np.array(rows, dtype=np.int64).reshape(-1, 5)
    table = table[np.lexsort((table[:, 1], table[:, 0]))]
    return dict(zip(("length", "start", "each", "sequence", "offset"), table.T))


# --- placing the pieces --------------------------------------------------------


def _place(spark, found: dict[str, np.ndarray]):
    """UDF (length, rank) -> struct<sequence_id, offset> by binary search in the plan."""
    shared = spark.sparkContext.broadcast({k: np.ascontiguousarray(v) for k, v in found.items()})

    @arrow_udf("struct<sequence_id:long,offset:long>")
    def place(length: pa.Array, rank: pa.Array) -> pa.Array:
        p = shared.value
        size, r = np.asarray(length), np.asarray(rank)
        names = np.unique(p["length"])
        begin = np.searchsorted(p["length"], names)
        # One ascending key over (length, start): lengths are dense numbers of their order.
        span = int(p["start"].max(initial=0)) + 1
        span = max(span, int(r.max(initial=0)) + 1)
        key = np.repeat(np.arange(len(names)), np.diff(np.append(begin, len(p["length"])))) * span + p["start"]
        at = np.searchsorted(key, np.searchsorted(names, size) * span + r, side="right") - 1
        inside = r - p["start"][at]
        return pa.StructArray.from_arrays(
            [
                pa.array(p["sequence"][at] + inside // p["each"][at], pa.int64()),
                pa.array(p["offset"][at] + inside % p["each"][at] * size, pa.int64()),
            ],
            ["sequence_id", "offset"],
        )

    return place


def _lookup(table: dict[int, int]) -> Column:
    """A map literal of longs (a few thousand entries at most)."""
    return F.create_map(*(F.lit(x).cast("long") for entry in table.items() for x in entry))


def pack(pieces: DataFrame, keys: list[str], capacity: int = CAPACITY, rounds: int = ROUNDS) -> DataFrame:
    """``pieces`` (with ``length`` from 1 to ``capacity``) plus ``sequence_id`` and ``offset``.

    ``pieces`` must be stable (a table): it is read three times. ``keys`` only
    order the pieces of one length; equal keys are ties in any order, each
    with its own place. An empty input gives an empty result.
    """
    spark = pieces.sparkSession
    histogram = {r["length"]: r["n"] for r in pieces.groupBy("length").agg(F.count("*").alias("n")).collect()}
    if not histogram:
        return pieces.select("*", F.lit(0).cast("long").alias("sequence_id"), F.lit(0).cast("long").alias("offset"))
    per_block = max(1000, sum(histogram.values()) // BLOCKS)
    hot = {size: -(-n // per_block) for size, n in histogram.items() if n > per_block}
    block = F.lit(0)
    if hot:
        salts = _lookup(hot)
        block = F.pmod(F.xxhash64(*keys), F.coalesce(salts[F.col("length")], F.lit(1))).cast("int")
    blocked = pieces.withColumn("_block", block)

    # Blocks of hot lengths only, at most 2 * BLOCKS of them: where each begins.
    begin: dict[int, dict[int, int]] = {}
    if hot:
        counts = blocked.where(F.col("length").isin(list(hot))).groupBy("length", "_block").agg(F.count("*").alias("n"))
        for r in sorted(counts.collect()):
            of = begin.setdefault(r["length"], {-1: 0})
            of[r["_block"]] = of[-1]
            of[-1] += r["n"]
    first = F.lit(0).cast("long")
    if begin:
        places = [(size, b, n) for size, of in begin.items() for b, n in of.items() if b >= 0]
        known = _lookup({s * 1_000_000 + b: n for s, b, n in places})
        first = F.coalesce(known[F.col("length") * 1_000_000 + F.col("_block")], first)
    within = Window.partitionBy("length", "_block").orderBy(*keys)
    ranked = blocked.withColumn("_rank", first + F.row_number().over(within) - 1)
    place = _place(spark, plan(histogram, capacity, rounds))
    placed = ranked.withColumn("_at", place(F.col("length"), F.col("_rank")))
    return placed.select(*pieces.columns, "_at.sequence_id", "_at.offset")


def pack_documents(docs: DataFrame, tokenizer_path: str, capacity: int = CAPACITY) -> DataFrame:
    """Pieces of all documents with their sequence and place (columns of ``token_pieces``, then of ``pack``)."""
    # A stored number tells equal rows apart, so that copies of one row are spread over the rank blocks too.
    numbered = token_pieces(docs, tokenizer_path, capacity=capacity).withColumn("_row", F.monotonically_increasing_id())
    with conf_override(docs.sparkSession, BATCH_CONF):
        pieces = staged(numbered, "pieces")
    return pack(pieces, ["doc_id", "piece", "ids_crc32", "_row"], capacity).drop("_row")


def sequences(packed: DataFrame) -> DataFrame:
    """The packed sequences themselves: ``sequence_id`` and its ``ids``, from pieces with ``ids``.

    A sequence has ``capacity`` ids at most, so a group is bounded.
    """
    parts = F.sort_array(F.collect_list(F.struct("offset", "ids")))
    return packed.groupBy("sequence_id").agg(F.flatten(F.transform(parts, lambda p: p["ids"])).alias("ids"))
