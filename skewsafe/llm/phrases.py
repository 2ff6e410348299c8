"""Operator 13: phrase collocations from a weighted de Bruijn graph.

Nodes are pairs of neighbouring words, and each three neighbouring words of a
piece are an edge from its first pair to its second, weighted by its count. The
end of a piece is an edge too, from its last pair and from its last word to
nothing; so every word occurrence starts exactly one edge, and all shorter
counts are sums of weights: a pair's count is the flow out of its node including
piece ends, a word's count the flow out of all pairs that it begins, and the
number of words the whole weight.

Edges are counted within each task first and shuffled once, by node; edge
weights, node flows and word flows are three sums over that one shuffle. What is
too rare to be a candidate ends there, after it has been counted in the flows.

In the graph of the frequent edges, unary paths (nodes with one way in and one
way out) are compacted: each edge finds the first edge of its path by pointer
doubling, and a path becomes one row with its nodes' flows and its edges'
weights side by side. Neighbouring counts then need no further joins: both cuts
of a triple, and the longer phrases that cover a pair, are next to each other in
the row. Paths are also cut at nodes whose hash is least among their neighbours,
so a row is short however long a repeated passage is, and no path is a ring.
"""

from __future__ import annotations

import math
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from skewsafe.llm.common import discard, staged
from skewsafe.llm.tokenizers_cache import slices
from skewsafe.llm.word_tokens import find_words, flat_utf8, word_codes

MIN_COUNT = 10
#: A candidate is dropped where a longer one has this share (in percent) of its count.
COVERED_PERCENT = 50
TOP = 2000
BATCH_CHARS = 16_000_000
#: The best of a language are first found in so many parts.
RANK_PARTS = 64
EDGE_TYPE = "lang string, node string, next string, n long"

# Byte classes: 0 word, 1 between words, 2 between pieces.
_KIND = np.zeros(256, np.uint8)
_KIND[[0x20, 0x09]] = 1
_KIND[[*b".,;:!?", *range(0x0A, 0x0E)]] = 2


# --- edges of the texts ------------------------------------------------------------


def _counted(keys: list[np.ndarray], sizes: list[int]) -> tuple[list[np.ndarray], np.ndarray]:
    """Distinct rows of the columns ``keys`` (numbers below ``sizes``), and how often each occurs."""
    if math.prod(sizes) < 2**62:
        packed = keys[0].astype(np.int64)
        for key, size in zip(keys[1:], sizes[1:]):
            packed = packed * size + key
        packed, counts = np.unique(packed, return_counts=True)
        columns = []
        for size in reversed(sizes[1:]):
            packed, column = np.divmod(packed, size)
            columns.append(column)
        return [packed, *reversed(columns)], counts
    # Too wide for one number: the first two columns are numbered by themselves.
    distinct, number = np.unique(keys[0].astype(np.int64) * sizes[1] + keys[1], return_inverse=True)
    (first, *rest), counts = _counted([number, *keys[2:]], [len(distinct), *sizes[2:]])
    return [*np.divmod(distinct[first], sizes[1]), *rest], counts


def text_edges(texts: pa.Array, langs: pa.Array) -> pa.RecordBatch:
    """The weighted edges of some texts: ``lang, node, next, n``.

    ``node`` is a pair of words, or the last word of a piece alone; ``next`` is
    the word after it, or empty at the end of a piece.
    """
    data, at = flat_utf8(texts)
    kind = _KIND[data]
    is_word = kind == 0
    starts, ends = find_words(is_word, at) if len(data) else (at[:0], at[:0])
    data = np.where((data >= 0x41) & (data <= 0x5A), data + 32, data).astype(np.uint8)
    codes, distinct = word_codes(data, starts, ends, is_word)
    # Rows leave in the order of their words: alike ones next to each other compress better.
    order = pc.sort_indices(distinct)
    place = np.empty(len(distinct), np.int64)
    place[order.to_numpy()] = np.arange(len(distinct))
    codes, distinct = place[codes], distinct.take(order)
    doc = np.searchsorted(at, starts, side="right") - 1
    # By the places of the separators: no number for each byte.
    piece = np.searchsorted(np.flatnonzero(kind == 2), starts)
    del data, kind, is_word, ends
    langs = pc.fill_null(langs, "und").dictionary_encode()
    of_doc = langs.indices.to_numpy(zero_copy_only=False)

    one, size = codes.astype(np.int64) + 1, len(distinct) + 1
    joined = np.zeros(len(one) + 2, bool)  # word i and the next are in one piece
    joined[:max(len(one) - 1, 0)] = (piece[1:] == piece[:-1]) & (doc[1:] == doc[:-1])
    padded = np.concatenate([one, [0, 0]])
    two = np.where(joined[:len(one)], padded[1:len(one) + 1], 0)
    three = np.where(joined[:len(one)] & joined[1:len(one) + 1], padded[2:], 0)
    lang = of_doc[doc]
    del codes, doc, piece, starts, joined, padded
    columns, counts = _counted([lang, one, two, three], [max(1, len(langs.dictionary)), size, size, size])
    del lang, one, two, three

    words = pa.concat_arrays([pa.array([""], pa.large_string()), distinct])
    first, second, third = (words.take(pa.array(c)) for c in columns[1:])
    node = pc.if_else(pa.array(columns[2] > 0), pc.binary_join_element_wise(first, second, pa.scalar(" ", pa.large_string())), first)
    values = [langs.dictionary.take(pa.array(columns[0])), node, third]
    values = [v.cast(pa.string()) for v in values] + [pa.array(counts, pa.int64())]
    return pa.RecordBatch.from_arrays(values, ["lang", "node", "next", "n"])


def edges(docs: DataFrame, text: str = "text", lang: str = "lang") -> DataFrame:
    """Weighted edges of all texts, counted slice by slice: an edge occurs once for each slice that has it."""

    def of_batches(batches):
        for batch in batches:
            texts, langs = batch.column(0), batch.column(1)
            for a, b in slices(pc.fill_null(pc.utf8_length(texts), 0).to_pylist(), BATCH_CHARS):
                found = text_edges(texts.slice(a, b - a), langs.slice(a, b - a))
                for start in range(0, len(found), 100_000):
                    yield found.slice(start, 100_000)
                del found  # not there any more while the next slice is counted

    return docs.select(F.col(text), F.col(lang)).mapInArrow(of_batches, EDGE_TYPE)


def flows(weighted: DataFrame, min_count: int = MIN_COUNT) -> DataFrame:
    """``kind, lang, node, next, n``: frequent edges (``edge``), frequent pairs (``pair``) and all words (``word``)."""
    # One exchange, by node, for all three sums; the words' sums need a second, small one.
    # What a sum leaves out is left out inside it: a filter, or a column that is not
    # read, would be moved below the exchange, and the three would no longer share it.
    dealt = weighted.repartition("lang", "node")

    def total(which: str) -> Column:
        return F.sum(F.when(F.expr(which), F.col("n")).otherwise(0)).alias("n")

    edge = dealt.groupBy("lang", "node", "next").agg(total("next != ''"))
    pair = dealt.groupBy("lang", "node").agg(total("next IS NOT NULL AND node LIKE '% %'"))
    word = dealt.groupBy("lang", F.substring_index("node", " ", 1).alias("node")).agg(total("next IS NOT NULL"))
    columns = ["kind", "lang", "node", "next", "n"]
    return reduce(DataFrame.unionByName, (
        edge.where(F.col("n") >= min_count).withColumn("kind", F.lit("edge")).select(columns),
        pair.where(F.col("n") >= min_count).withColumn("kind", F.lit("pair")).withColumn("next", F.lit("")).select(columns),
        word.withColumn("kind", F.lit("word")).withColumn("next", F.lit("")).select(columns),
    ))


# --- compact paths -------------------------------------------------------------------


def _word(node: Column | str, k: int) -> Column:
    return F.split_part(F.col(node) if isinstance(node, str) else node, F.lit(" "), F.lit(k))


def _heads(edge: DataFrame) -> DataFrame:
    """``lang, edge, head, at``: the first edge of each edge's path and the place in the path, by pointer doubling."""
    ahead = edge.groupBy("lang", "node").agg(F.count("*").alias("outs"), F.min("next").alias("after"))
    into = edge.select("lang", F.concat_ws(" ", _word("node", 2), "next").alias("node"), _word("node", 1).alias("before"))
    into = into.groupBy("lang", "node").agg(F.count("*").alias("ins"), F.min("before").alias("before"))
    inner = ahead.join(into, ["lang", "node"]).where("outs = 1 AND ins = 1")
    mark = [F.xxhash64("lang", n) for n in (
        F.col("node"), F.concat_ws(" ", "before", _word("node", 1)), F.concat_ws(" ", _word("node", 2), "after"))]
    inner = inner.where(mark[0] > F.least(mark[1], mark[2])).select("lang", "node", "before")
    name = F.concat_ws(" ", "node", "next")
    pointers = edge.join(inner, ["lang", "node"], "left").select(
        "lang", name.alias("edge"), F.when(F.col("before").isNull(), name).otherwise(F.concat_ws(" ", "before", "node")).alias("head"),
        F.when(F.col("before").isNull(), 0).otherwise(1).alias("at"),
    )
    pointers = staged(pointers, "phrase-pointers")
    while True:
        there = pointers.select("lang", F.col("edge").alias("head"), F.col("head").alias("_head"), F.col("at").alias("_at"))
        jumped = pointers.join(there, ["lang", "head"]).select(
            "lang", "edge", F.col("_head").alias("head"), (F.col("at") + F.col("_at")).alias("at"), (F.col("_at") > 0).alias("_moved")
        )
        jumped = staged(jumped, "phrase-pointers")
        discard(pointers)
        if jumped.where("_moved").isEmpty():
            return jumped.drop("_moved")
        path, pointers = jumped.staged_path, jumped.drop("_moved")
        pointers.staged_path = path


def compact_paths(graph: DataFrame) -> DataFrame:
    """Unary paths of frequent edges: ``lang, words, nodes, weights``.

    ``words`` is the path's text, ``nodes`` its pairs in order, each with its
    count and its words' counts, ``weights`` the counts of the edges between.
    """
    edge = graph.where("kind = 'edge'").select("lang", "node", "next", "n")
    known = pairs(graph)
    nodes = known.select("lang", "node", F.struct("node", "n", "left", "right").alias("at_node"))
    steps = edge.withColumn("edge", F.concat_ws(" ", "node", "next")).join(nodes, ["lang", "node"])
    steps = steps.join(_heads(edge), ["lang", "edge"])
    # A path ends at the next local minimum of the hash, so the list is short.
    paths = steps.groupBy("lang", "head").agg(F.sort_array(F.collect_list(F.struct("at", "at_node", "next", "n"))).alias("steps"))
    last = F.element_at("steps", -1)
    end = F.concat_ws(" ", _word(last["at_node"]["node"], 2), last["next"])
    paths = paths.withColumn("node", end).join(nodes.withColumnRenamed("at_node", "end_node"), ["lang", "node"])
    return paths.select(
        "lang",
        F.concat_ws(" ", F.col("steps")[0]["at_node"]["node"], F.transform("steps", lambda s: s["next"])).alias("words"),
        F.concat(F.transform("steps", lambda s: s["at_node"]), F.array("end_node")).alias("nodes"),
        F.transform("steps", lambda s: s["n"]).alias("weights"),
    )


def pairs(graph: DataFrame) -> DataFrame:
    """Frequent pairs ``lang, node, n`` with the counts of their words, ``left`` and ``right``."""
    word = graph.where("kind = 'word'").select("lang", F.col("node").alias("word"), F.col("n").alias("count"))
    pair = graph.where("kind = 'pair'").select("lang", "node", "n", _word("node", 1).alias("one"), _word("node", 2).alias("two"))
    for name, count in (("one", "left"), ("two", "right")):
        pair = pair.join(word.select("lang", F.col("word").alias(name), F.col("count").alias(count)), ["lang", name])
    return pair.select("lang", "node", "n", "left", "right")


# --- candidates ------------------------------------------------------------------------


def _score(a: Column, left: Column, right: Column) -> Column:
    """``floor(1000000 * a * a / (left * right))``, exact for counts below 10^16."""
    a, left, right = (c.cast("decimal(16,0)") for c in (a, left, right))
    return F.call_function("div", F.lit(1_000_000).cast("decimal(7,0)") * (a * a), left * right)


def candidates(graph: DataFrame, paths: DataFrame) -> DataFrame:
    """``lang, phrase, a, l, r, score`` of the pairs and triples that no longer candidate covers."""
    at = paths.select("lang", "nodes", "weights", F.explode(F.sequence(F.lit(1), F.size("weights"))).alias("i"))
    tail, head = F.element_at("nodes", F.col("i")), F.element_at("nodes", F.col("i") + 1)
    triple = at.select(
        "lang", F.concat_ws(" ", tail["node"], _word(head["node"], 2)).alias("phrase"), F.element_at("weights", F.col("i")).alias("a"),
        tail["left"].alias("l1"), head["n"].alias("r1"), tail["n"].alias("l2"), head["right"].alias("r2"),
    )
    one, two = (_score(F.col("a"), F.col(f"l{k}"), F.col(f"r{k}")) for k in (1, 2))
    triple = triple.withColumn("s1", one).withColumn("s2", two)
    best = F.col("s2") < F.col("s1")
    triple = triple.select("lang", "phrase", "a", *(F.when(best, F.col(f"{c}2")).otherwise(F.col(f"{c}1")).alias(t)
                                                    for c, t in (("l", "l"), ("r", "r"), ("s", "score"))))
    weights = F.concat(F.array(F.lit(0).cast("long")), "weights", F.array(F.lit(0).cast("long")))
    around = F.transform("nodes", lambda n, i: F.struct(
        n["node"].alias("node"), F.greatest(F.element_at(weights, i + 1), F.element_at(weights, i + 2)).alias("longer")))
    longer = paths.select("lang", F.explode(around).alias("n")).select("lang", "n.*").groupBy("lang", "node").agg(F.max("longer").alias("longer"))
    pair = pairs(graph).join(longer, ["lang", "node"], "left")
    pair = pair.where(f"longer IS NULL OR cast(100 AS decimal(3,0)) * longer < cast({COVERED_PERCENT} AS decimal(3,0)) * n")
    pair = pair.select("lang", F.col("node").alias("phrase"), F.col("n").alias("a"), F.col("left").alias("l"), F.col("right").alias("r"),
                       _score(F.col("n"), F.col("left"), F.col("right")).alias("score"))
    return pair.unionByName(triple)


def best_phrases(found: DataFrame, graph: DataFrame, top: int = TOP) -> DataFrame:
    """The first ``top`` candidates of each language: ``lang, rank, phrase, a, l, r, n, score``."""
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    # A language may hold any share of the candidates: first the best of each part.
    part = Window.partitionBy("lang", "_part").orderBy(*order)
    found = found.withColumn("_part", F.pmod(F.xxhash64("phrase"), F.lit(RANK_PARTS)))
    found = found.withColumn("rank", F.row_number().over(part)).where(F.col("rank") <= top).drop("_part")
    found = found.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order))).where(F.col("rank") <= top)
    words = graph.where("kind = 'word'").groupBy("lang").agg(F.sum("n").alias("n"))
    return found.join(words, "lang").select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")


def collocations(docs: DataFrame, min_count: int = MIN_COUNT, top: int = TOP) -> DataFrame:
    """Best phrases of two and three words of each language (columns of ``best_phrases``).

    Null texts are empty, a null language is ``und``; texts without words add
    nothing; repeated rows count as often as they occur; columns other than
    ``text`` and ``lang`` are not read; an empty table gives no rows.
    """
    graph = staged(flows(edges(docs), min_count), "phrase-graph")
    paths = staged(compact_paths(graph), "phrase-paths")
    return best_phrases(candidates(graph, paths), graph, top)
