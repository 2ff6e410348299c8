"""Operator 12: packing by non-negative least squares over the length histogram.

Documents longer than a window are cut into whole windows and one rest. The
histogram of the lengths (at most ``window`` numbers, whatever the corpus
holds) reaches the driver. There the shallow combinations that fill a window
exactly are enumerated: up to three pieces of different lengths, or up to
``DEPTH`` pieces of at most two lengths. The least-squares program

    minimise |A x - h|^2   subject to   x >= 0

(``A``: pieces of each length in a combination, ``h``: the histogram) gives the
repeat count of each combination. It is solved by coordinate descent: always
the combination whose own best step lowers the residual most, until no step is
worth ``GAP``. The counts are rounded and the residual is packed greedily,
largest piece first; a window that no piece fits any more is filled with the
front of the smallest longer piece, whose rest goes back to the residual. So no
window is padded. The last, partial window is split at powers of two, which
need no padding either.

The plan is made of runs (length, ranks of the pieces of that length), so its
size depends on the window and not on the corpus, and one path serves every
size. Pieces get their rank in salted blocks of their length. Only the pieces
that are cut need their ids again; they are joined back by their number.
"""

from __future__ import annotations

import zlib
from collections import defaultdict, deque

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.functions import arrow_udf

from skewsafe.llm.common import staged
from skewsafe.llm.word_tokens import BATCH_CONF, text_ids
from skewsafe.session import conf_override

WINDOW = 2048
#: Most pieces of a combination of two lengths.
DEPTH = 8
#: The program is solved when no single step changes a repeat count by more than
#: half a window or this share of the mean count of a length.
GAP = 0.01
#: A rank block holds about this share of all pieces at most.
BLOCKS = 1000


# --- pieces of the documents -----------------------------------------------------


def document_pieces(docs: DataFrame, tokenizer_path: str, end_id: int = 1, window: int = WINDOW, text: str = "text") -> DataFrame:
    """Whole windows and the rest of each document: ``doc_id, start, length, ids_crc32, doc_tokens, ids``.

    A document is its token ids followed by ``end_id`` (null or empty text:
    ``end_id`` alone). ``ids`` are little-endian uint32 in bytes; whole windows
    are never cut again and carry none. Repeated rows give repeated pieces.
    """
    schema = docs.select("doc_id").schema.add("start", "long").add("length", "long").add("ids_crc32", "long")
    schema = schema.add("doc_tokens", "long").add("ids", "binary")

    def cut(batches):
        for batch in batches:
            for first, ids, at in text_ids(batch.column(1), tokenizer_path):
                rows, starts, lengths, crcs, totals, kept = [], [], [], [], [], []
                for i in range(len(at) - 1):
                    own = np.append(ids[at[i]:at[i + 1]], np.array([end_id], "<u4"))
                    for start in range(0, len(own), window):
                        part = own[start:start + window].tobytes()
                        rows.append(first + i)
                        starts.append(start)
                        lengths.append(len(part) // 4)
                        crcs.append(zlib.crc32(part))
                        totals.append(len(own))
                        kept.append(part if len(part) < 4 * window else None)
                numbers = [pa.array(x, pa.int64()) for x in (starts, lengths, crcs, totals)]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(pa.array(rows, pa.int64())), *numbers, pa.array(kept, pa.binary())],
                    ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "ids"],
                )

    return docs.select("doc_id", text).mapInArrow(cut, schema)


# --- the program -------------------------------------------------------------------


def combinations(lengths: np.ndarray, window: int = WINDOW, depth: int = DEPTH) -> tuple[np.ndarray, np.ndarray]:
    """Shallow combinations of ``lengths`` (ascending) that fill ``window`` exactly.

    Two arrays (combinations x 3): positions in ``lengths`` and how often each
    is taken (0: unused).
    """
    at = np.full(window + 1, -1)
    at[lengths] = np.arange(len(lengths))
    index, times = [], []
    for i, a in enumerate(lengths):
        b = lengths[i + 1:]
        c = window - a - b
        ok = (c > b) & (at[np.clip(c, 0, window)] >= 0)
        j = np.flatnonzero(ok) + i + 1
        index.append(np.column_stack([np.full(len(j), i), j, at[window - a - lengths[j]]]))
        times.append(np.ones((len(j), 3), np.int64))
    pairs, counts = [], []
    for n in range(1, depth + 1):
        if window % n == 0 and at[window // n] >= 0:
            pairs.append(np.array([[at[window // n]] * 3]))
            counts.append(np.array([[n, 0, 0]]))
        for m in range(1, depth + 1 - n):
            # n pieces of a shorter length and m of a longer one.
            rest = window - n * lengths
            b = rest // m
            ok = (rest > 0) & (rest % m == 0) & (b > lengths)
            ok[ok] = at[b[ok]] >= 0
            i = np.flatnonzero(ok)
            pairs.append(np.column_stack([i, at[b[i]], at[b[i]]]))
            counts.append(np.tile([n, m, 0], (len(i), 1)))
    return (np.concatenate(index + pairs).astype(np.int64).reshape(-1, 3),
            np.concatenate(times + counts).astype(np.int64).reshape(-1, 3))


def solve(index: np.ndarray, times: np.ndarray, demand: np.ndarray, gap: float = GAP) -> np.ndarray:
    """Repeat counts ``x >= 0`` that minimise the squared distance of ``A x`` to ``demand``."""
    n = len(index)
    x = np.zeros(n)
    if not n:
        return x
    norm = (times * times).sum(axis=1).astype(float)
    residual = demand.astype(float).copy()
    fits = (times * residual[index]).sum(axis=1)
    # For each length: the combinations that hold it, and how often.
    held_by, column = np.nonzero(times)
    order = np.argsort(index[held_by, column], kind="stable")
    of, weight = held_by[order], times[held_by, column][order]
    begin = np.searchsorted(index[held_by, column][order], np.arange(len(demand) + 1))
    least = max(0.5, gap * float(demand.mean()))
    step = np.maximum(fits / norm, -x)
    gain = np.abs(step) * np.sqrt(norm)
    while True:
        j = int(gain.argmax())
        if abs(step[j]) < least:
            # The best step by gain is small: look whether any other is not.
            if np.abs(step).max() < least:
                return x
            j = int(np.abs(step).argmax())
        moved = step[j]
        x[j] += moved
        touched = []
        for k in range(3):
            if times[j, k]:
                i = index[j, k]
                span = slice(begin[i], begin[i + 1])
                change = moved * times[j, k]
                residual[i] -= change
                fits[of[span]] -= weight[span] * change  # a combination holds a length in one column only
                touched.append(of[span])
        at = np.concatenate(touched)
        step[at] = np.maximum(fits[at] / norm[at], -x[at])
        gain[at] = np.abs(step[at]) * np.sqrt(norm[at])


# --- the plan ------------------------------------------------------------------------


class _Pool:
    """Pieces still to be placed, as runs of (class, first rank, count, start) by their present length.

    Class and ranks name original pieces; ``start`` is where the present rest
    begins inside them.
    """

    def __init__(self, histogram: dict[int, int]):
        self.runs = {size: deque([(size, 0, n, 0)]) for size, n in histogram.items() if n}
        self.left = defaultdict(int, {size: n for size, n in histogram.items() if n})
        self.mask = sum(1 << size for size in self.runs)
        self.placed: list[tuple] = []

    def total(self) -> int:
        return sum(size * n for size, n in self.left.items())

    def take(self, size: int, n: int) -> list[tuple]:
        out = []
        while n:
            cls, rank, count, start = self.runs[size].popleft()
            used = min(n, count)
            out.append((cls, rank, used, start))
            if used < count:
                self.runs[size].appendleft((cls, rank + used, count - used, start))
            n -= used
            self.left[size] -= used
        if not self.left[size]:
            self.mask &= ~(1 << size)
        return out

    def give(self, size: int, runs: list[tuple]) -> None:
        self.runs.setdefault(size, deque()).extend(runs)
        self.left[size] += sum(r[2] for r in runs)
        self.mask |= 1 << size

    def place(self, config: list[tuple[int, int]], copies: int, sequence: int, cut: tuple[int, int] | None = None) -> None:
        """``copies`` sequences of ``config`` (length, how often); ``cut``: then the first part of a longer piece."""
        offset = 0
        for size, each in config:
            done = 0
            for cls, rank, n, start in self.take(size, copies * each):
                self.placed.append((cls, rank, n, start, size, done, each, sequence, offset))
                done += n
            offset += size * each
        if cut:
            size, part = cut
            done, rests = 0, []
            for cls, rank, n, start in self.take(size, copies):
                self.placed.append((cls, rank, n, start, part, done, 1, sequence, offset))
                rests.append((cls, rank, n, start + part))
                done += n
            self.give(size - part, rests)

    def greedy(self, room: int, level: int = 1) -> tuple[list[tuple[int, int]], tuple[int, int] | None, int] | None:
        """Largest pieces first, then the front of the smallest longer one: configuration, cut, possible copies.

        Only lengths with ``level`` pieces or more are used, so the configuration
        can be repeated that often; None if they cannot fill the room. At level 1
        they can while the room is no larger than what is left.
        """
        config, mask = [], self._usable(level)
        free = mask
        while room and (fits := free & ((1 << (room + 1)) - 1)):
            size = fits.bit_length() - 1
            each = min(room // size, self.left[size] // level)
            config.append((size, each))
            room -= size * each
            free &= ~(1 << size)
        cut = None
        used = dict(config)
        if room:
            longer = mask >> (room + 1) << (room + 1)
            while longer:
                size = (longer & -longer).bit_length() - 1
                if self.left[size] // (used.get(size, 0) + 1) >= level:
                    cut = (size, room)
                    used[size] = used.get(size, 0) + 1
                    break
                longer &= longer - 1
            else:
                return None
        return config, cut, min(self.left[size] // each for size, each in used.items())

    def _usable(self, level: int) -> int:
        if level == 1:
            return self.mask
        return sum(1 << size for size, n in self.left.items() if n >= level)


def plan(histogram: dict[int, int], window: int = WINDOW, depth: int = DEPTH, gap: float = GAP) -> list[tuple]:
    """Runs of placed parts: (class, first rank, count, start, length, done, each, sequence, offset).

    The piece of the class with rank ``r`` in the run has its part [start, start
    + length) in sequence ``sequence + t // each`` at ``offset + t % each *
    length``, where ``t = done + r - first rank``.
    """
    pool = _Pool(histogram)
    sequence = 0
    if whole := pool.left.get(window, 0):
        pool.place([(window, 1)], whole, sequence)
        sequence += whole
    lengths = np.array(sorted(size for size, n in pool.left.items() if n), dtype=np.int64)
    if len(lengths):
        demand = np.array([pool.left[int(x)] for x in lengths], dtype=np.int64)
        index, times = combinations(lengths, window, depth)
        x = solve(index, times, demand, gap)
        for j in np.argsort(-x, kind="stable"):
            if x[j] < 0.5:
                break
            config = [(int(lengths[i]), int(n)) for i, n in zip(index[j], times[j]) if n]
            copies = min(int(x[j] + 0.5), *(pool.left[size] // n for size, n in config))
            if copies:
                pool.place(config, copies, sequence)
                sequence += copies
    # Lengths with many pieces first: a rest of few pieces never holds up many.
    left, level = pool.total(), 1 << max(pool.left.values(), default=0).bit_length()
    while left >= window:
        found = pool.greedy(window, level)
        if found is None:
            level //= 2
            continue
        config, cut, copies = found
        copies = min(copies, left // window)
        pool.place(config, copies, sequence, cut)
        sequence += copies
        left -= copies * window
    for bit in reversed(range(window.bit_length())):
        if left >> bit & 1:
            config, cut, _ = pool.greedy(1 << bit)
            pool.place(config, 1, sequence, cut)
            sequence += 1
    return pool.placed


def lookup_tables(placed: list[tuple]) -> dict[str, np.ndarray]:
    """``plan``'s runs as arrays by disjoint rank ranges of each class; a range lists the parts of its pieces."""
    by_class: dict[int, list[tuple]] = defaultdict(list)
    for run in placed:
        by_class[run[0]].append(run)
    ranges, first, parts = [], [0], []
    for cls in sorted(by_class):
        runs = by_class[cls]
        edges = sorted({r[1] for r in runs} | {r[1] + r[2] for r in runs})
        within: dict[int, list[tuple]] = defaultdict(list)
        number = {edge: k for k, edge in enumerate(edges)}
        for run in runs:
            for k in range(number[run[1]], number[run[1] + run[2]]):
                within[k].append(run)
        for k in range(len(edges) - 1):
            ranges.append((cls, edges[k]))
            for _, rank, _, start, size, done, each, sequence, offset in sorted(within[k], key=lambda r: r[3]):
                parts.append((rank - done, start, size, each, sequence, offset))
            first.append(len(parts))
    ranges = np.array(ranges, np.int64).reshape(-1, 2)
    parts = np.array(parts, np.int64).reshape(-1, 6)
    table = {"cls": ranges[:, 0], "rank": ranges[:, 1], "first": np.array(first, np.int64)}
    return table | dict(zip(("zero", "start", "size", "each", "sequence", "offset"), parts.T))


def parts_of(table: dict[str, np.ndarray], length: np.ndarray, rank: np.ndarray):
    """Parts of the pieces: how many each has, then start, length, sequence and offset of all, piece by piece."""
    # One ascending key over (class, rank): classes are dense numbers of their order.
    names = np.unique(table["cls"])
    span = int(max(table["rank"].max(initial=0), rank.max(initial=0))) + 1
    key = np.searchsorted(names, table["cls"]) * span + table["rank"]
    at = np.searchsorted(key, np.searchsorted(names, length) * span + rank, side="right") - 1
    count = table["first"][at + 1] - table["first"][at]
    end = np.cumsum(count)
    part = np.repeat(table["first"][at] - (end - count), count) + np.arange(end[-1] if len(end) else 0)
    t = np.repeat(rank, count) - table["zero"][part]
    each, size = table["each"][part], table["size"][part]
    return count, table["start"][part], size, table["sequence"][part] + t // each, table["offset"][part] + t % each * size


# --- placing the pieces --------------------------------------------------------------


def _place(spark, placed: list[tuple]):
    shared = spark.sparkContext.broadcast({k: np.ascontiguousarray(v) for k, v in lookup_tables(placed).items()})
    kinds = ("part_start", "part_length", "sequence_id", "offset")

    @arrow_udf("array<struct<part_start:long,part_length:long,sequence_id:long,offset:long>>")
    def place(length: pa.Array, rank: pa.Array) -> pa.Array:
        count, *columns = parts_of(shared.value, np.asarray(length), np.asarray(rank))
        offsets = np.concatenate([[0], np.cumsum(count)])
        return pa.ListArray.from_arrays(
            pa.array(offsets, pa.int32()), pa.StructArray.from_arrays([pa.array(c, pa.int64()) for c in columns], kinds)
        )

    return place


@arrow_udf(T.LongType())
def _crc_of(ids: pa.Array, start: pa.Array, length: pa.Array) -> pa.Array:
    spans = zip(ids, start.to_pylist(), length.to_pylist())
    return pa.array([zlib.crc32(i.as_buffer()[4 * s:4 * (s + n)]) for i, s, n in spans], pa.int64())


def ranked(pieces: DataFrame, histogram: dict[int, int]) -> DataFrame:
    """``uid, length`` of ``pieces`` with each piece's ``rank`` (from 0) within its length.

    A length that holds much of the table is ranked in blocks drawn by the hash
    of ``uid``, so no length and not the table is ordered in one task; where
    each block begins is a short list (at most 2 * ``BLOCKS`` entries).
    """
    per_block = max(1000, sum(histogram.values()) // BLOCKS)
    hot = {size: -(-n // per_block) for size, n in histogram.items() if n > per_block}
    if not hot:
        within = Window.partitionBy("length").orderBy("uid")
        return pieces.select("uid", "length", (F.row_number().over(within) - 1).cast("long").alias("rank"))
    salts = F.create_map(*(F.lit(x).cast("long") for entry in hot.items() for x in entry))
    block = F.pmod(F.xxhash64("uid"), F.coalesce(salts[F.col("length")], F.lit(1)))
    blocked = pieces.select("uid", "length", block.alias("_block"))
    counts = blocked.where(F.col("length").isin(list(hot))).groupBy("length", "_block").agg(F.count("*").alias("n"))
    begin, last, total = [], None, 0
    for size, b, n in sorted(map(tuple, counts.collect())):
        total = 0 if size != last else total
        begin += [F.lit(f"{size}/{b}"), F.lit(total).cast("long")]
        last, total = size, total + n
    first = F.coalesce(F.create_map(*begin)[F.concat_ws("/", "length", "_block")], F.lit(0))
    within = Window.partitionBy("length", "_block").orderBy("uid")
    return blocked.select("uid", "length", (first + F.row_number().over(within) - 1).alias("rank"))


def pack(pieces: DataFrame, window: int = WINDOW, depth: int = DEPTH, gap: float = GAP) -> DataFrame:
    """Placed parts of ``pieces`` (of ``document_pieces``): ``doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset``.

    Every id is in exactly one part; all sequences hold ``window`` ids but those
    of the last, partial window, which hold powers of two. An empty table gives
    no rows.
    """
    spark = pieces.sparkSession
    with conf_override(spark, BATCH_CONF):
        pieces = staged(pieces.withColumn("uid", F.monotonically_increasing_id()), "nnls-pieces")
    histogram = {r["length"]: r["n"] for r in pieces.groupBy("length").agg(F.count("*").alias("n")).collect()}
    place = _place(spark, plan(histogram, window, depth, gap))
    parts = ranked(pieces, histogram).select("uid", "length", F.explode(place("length", "rank")).alias("p"))
    parts = staged(parts.select("uid", F.col("length").alias("_whole"), "p.*"), "nnls-parts")
    whole = F.col("part_length") == F.col("_whole")
    known = pieces.drop("ids", "length")
    uncut = parts.where(whole).join(known, "uid")
    # Few parts are cut: as a table of their own, Spark knows their size and need not move the ids.
    cut = staged(parts.where(~whole), "nnls-cut").join(pieces.select("uid", "ids").where("ids IS NOT NULL"), "uid")
    cut = cut.select(*parts.columns, _crc_of("ids", "part_start", "part_length").alias("_crc"))
    cut = cut.join(known, "uid").withColumn("ids_crc32", F.col("_crc")).drop("_crc")
    return uncut.unionByName(cut).select(
        "doc_id", (F.col("start") + F.col("part_start")).alias("start"), F.col("part_length").alias("length"),
        "ids_crc32", "doc_tokens", "sequence_id", "offset",
    )


def pack_documents(docs: DataFrame, tokenizer_path: str, window: int = WINDOW) -> DataFrame:
    """All documents packed into sequences of at most ``window`` tokens (columns of ``pack``).

    Null and empty texts are one end id; very long texts are cut into windows;
    repeated rows are packed as often as they occur; null ids stay null; other
    columns are not read, whatever their names; an empty table gives no rows.
    """
    return pack(document_pieces(docs, tokenizer_path, window=window), window)


def sequences(docs: DataFrame, packed: DataFrame, tokenizer_path: str, end_id: int = 1) -> DataFrame:
    """The sequences themselves, ``sequence_id`` and ``ids``, for documents with distinct ``doc_id``."""

    @arrow_udf("array<int>")
    def ids_of(texts: pa.Array) -> pa.Array:
        out = []
        for _, ids, at in text_ids(texts, tokenizer_path):
            out += [np.append(ids[at[i]:at[i + 1]], np.array([end_id], "<u4")).astype(np.int32) for i in range(len(at) - 1)]
        return pa.array(out, pa.list_(pa.int32()))

    tokens = docs.select("doc_id", ids_of("text").alias("_ids"))
    parts = packed.join(tokens, "doc_id").select(
        "sequence_id", F.struct("offset", F.slice("_ids", (F.col("start") + 1).cast("int"), F.col("length").cast("int")).alias("ids")).alias("p")
    )
    ordered = F.sort_array(F.collect_list("p"))  # a window of ids at most
    return parts.groupBy("sequence_id").agg(F.flatten(F.transform(ordered, lambda p: p["ids"])).alias("ids"))
