"""Operator 7: toxicity by class-conditional Kneser-Ney models.

Two character models of words, one of toxic and one of ordinary documents. The
highest order (a character after up to eight before it, from the word's start)
has counts of each class; all lower orders are Kneser-Ney continuation counts
shared by both classes, so a rare or unseen word gets the same backoff
probability from both and only what the classes really differ in counts:

    P_c(x | h) = max(n_c(hx) - D, 0) / n_c(h) + D * types_c(h) / n_c(h) * P_shared(x | h')

A word's evidence is the difference of its log-likelihoods. A document is judged
by length-normalised differences: over all its words, over its strongest 16
consecutive words, and over its strongest one, two and three words; a logistic
curve turns them into a score. It is fitted on what each labelled document gets
from models that were fitted without its fold; those models live one after the
other, so a Python worker holds one at a time.

The models, and the curve, are fitted on the whole texts of all labelled rows.
Words and their highest-order n-grams are counted by Spark; these are dealt by
the two characters before their last, so a task has every gram with the same
context. No process holds a whole model: the n-grams of the words that are to be
scored are dealt the same way, each deal answers with their evidence, and the
answers are added up by word. What is broadcast is one number for each distinct
word of the documents (16 bytes with its key); it grows with the vocabulary, not
with the n-grams or the rows. The curve's sums are added up in Spark. Scoring
covers every document.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Callable
from dataclasses import dataclass
from functools import cache, cached_property
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf
from pyspark.sql.types import ArrayType, DoubleType, StructField, StructType

from skewsafe.llm.common import discard, staged
from skewsafe.llm.tokenizers_cache import UnitCache, held, slices
from skewsafe.session import conf_override

ORDER = 9
DISCOUNT = 0.75
ALPHABET = 1 / 200  # probability of any character before anything is known
WINDOW = 16
THRESHOLD = 0.3
CACHE_WORDS = 150_000
BATCH_CHARS = 2_000_000
#: Characters whose words are found at once; their arrays take some 50 bytes for each.
TOKEN_CHARS = 250_000
#: Parts of the labelled documents; each is calibrated with models of the others.
FOLDS = 3
#: Lower orders of fewer characters than a deal's key and one more are counted by themselves.
DEALT = 2
#: Words whose evidence one task adds up at once.
SLICE_WORDS = 20_000
#: While fitting and scoring: small batches of texts; a shuffle's files go when the table made from it is written.
FIT_CONF = {
    "spark.sql.execution.arrow.maxRecordsPerBatch": "2000",
    "spark.sql.execution.arrow.maxBytesPerBatch": "4m",
    "spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true",
}

_WORD = re.compile(r"[^\W\d_]+")


def words(text: str) -> list[str]:
    """Runs of letters, lower-cased."""
    return _WORD.findall(text.lower())


# --- n-grams as 64-bit keys ----------------------------------------------------

_STEP = np.uint64(0x9E3779B97F4A7C15)


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _gram_keys(some: list[str], ends: np.ndarray) -> np.ndarray:
    """``[length - 1, i]``: key of the gram of that length that ends at position ``ends[i]`` of the joined strings."""
    flat = np.frombuffer("".join(some).encode("utf-32-le"), dtype="<u4")
    char = _mix(flat.astype(np.uint64) + np.uint64(1))
    keys, total, power = np.empty((ORDER, len(ends)), np.uint64), np.zeros(len(ends), np.uint64), np.uint64(1)
    with np.errstate(over="ignore"):
        for length in range(1, ORDER + 1):
            first = ends - (length - 1)
            total += np.where(first >= 0, char[np.maximum(first, 0)], np.uint64(0)) * power
            power = power * _STEP
            keys[length - 1] = _mix(total + np.uint64(length))
    return keys


@dataclass
class _Grams:
    """Keys of all n-grams of a list of words, each word between a start and an end mark."""

    keys: np.ndarray  # [length - 1, position]: the gram of that length that ends there
    place: np.ndarray  # index of each character in its word, 0 is the start mark
    starts: np.ndarray  # position of each word's start mark

    @classmethod
    def of(cls, some: list[str]) -> _Grams:
        # Marks that cannot be in a word: line feed before, space after.
        some = [f"\n{w} " for w in some]
        sizes = np.fromiter(map(len, some), np.int64, len(some))
        starts = np.cumsum(sizes) - sizes
        place = np.arange(sizes.sum()) - np.repeat(starts, sizes)
        return cls(_gram_keys(some, np.arange(len(place))), place, starts)

    def key(self, length: np.ndarray | int, position: np.ndarray) -> np.ndarray:
        """Key of the gram of ``length`` that ends at ``position``; length 0: the empty gram."""
        length = np.broadcast_to(length, position.shape)
        return np.where(length > 0, self.keys[np.maximum(length, 1) - 1, position], np.uint64(0))


class _Index:
    """Places of sorted, evenly spread 64-bit keys: their highest bits give where to begin."""

    def __init__(self, keys: np.ndarray):
        bits = max(1, len(keys).bit_length() - 2)  # two to four keys for each place, to save memory
        self.keys, self.shift = keys, np.uint64(64 - bits)
        self.heads = np.searchsorted(keys, np.arange(2**bits, dtype=np.uint64) << self.shift).astype(np.int32)

    def find(self, wanted: np.ndarray) -> np.ndarray:
        """The place of each wanted key, or of some other key where it is not known."""
        last = len(self.keys) - 1
        at = np.minimum(self.heads[wanted >> self.shift], last)
        behind = np.flatnonzero((self.keys[at] < wanted) & (at < last))
        while len(behind):
            at[behind] += 1
            here = at[behind]
            behind = behind[(self.keys[here] < wanted[behind]) & (here < last)]
        return at


def _indexed(model: dict[str, np.ndarray]) -> dict[str, _Index]:
    """Indexes of all keys of a model; each process that scores many words makes them once."""
    return {name: _Index(keys) for name, keys in model.items() if keys.dtype == np.uint64}


def _look(index: _Index, values: np.ndarray, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Whether each wanted key is known, and its values (of some other key where it is not)."""
    if not len(index.keys):
        return np.zeros(len(wanted), bool), np.ones((len(wanted), *values.shape[1:]))
    at = index.find(wanted)
    return index.keys[at] == wanted, values[at]


def _windows(some: list[str], counts: np.ndarray) -> tuple[list[str], np.ndarray]:
    """Distinct highest-order grams of the words (``ORDER`` characters, fewer from a word's start), ``counts`` (by word) summed."""
    grams = _Grams.of(some)
    at = np.flatnonzero(grams.place > 0)
    word = (np.cumsum(grams.place == 0) - 1)[at]
    length = np.minimum(ORDER, grams.place[at] + 1)
    _, first, of = np.unique(grams.key(length, at), return_index=True, return_inverse=True)
    n = np.array([np.bincount(of, c[word], len(first)) for c in counts.T]).reshape(counts.shape[1], len(first)).T
    text = "".join(f"\n{w} " for w in some)
    return [text[e - k + 1:e + 1] for e, k in zip(at[first].tolist(), length[first].tolist())], n


@dataclass
class _Ends:
    """Highest-order grams by their lengths and last positions; ``grams`` has their last two positions only."""

    grams: _Grams
    length: np.ndarray
    last: np.ndarray

    @classmethod
    def of(cls, windows: list[str]) -> _Ends:
        length = np.fromiter(map(len, windows), np.int64, len(windows))
        ends = np.cumsum(length) - 1
        # Only grams that end at a window's last two characters are asked for: two positions of each are kept.
        both = np.stack([ends - 1, ends], axis=1).ravel()
        place = np.stack([length - 2, length - 1], axis=1).ravel()
        last = 2 * np.arange(len(windows)) + 1
        return cls(_Grams(_gram_keys(windows, both), place, last - 1), length, last)

    def __getitem__(self, some) -> _Ends:
        return _Ends(self.grams, self.length[some], self.last[some])

    def keys(self) -> np.ndarray:
        return self.grams.key(self.length, self.last)


def _lower_tables(windows: _Ends, sizes) -> dict[str, np.ndarray]:
    """Continuation tables of the lower orders ``sizes`` from distinct highest-order grams: every lower one ends some of them."""
    grams, length, last, model = windows.grams, windows.length, windows.last, {}
    for size in sizes:
        ends = last[length > size]
        # One longer gram (one more character before) counts once, however many words have it.
        _, first = np.unique(grams.key(size + 1, ends), return_index=True)
        ends = ends[first]
        keys, first, seen = np.unique(grams.key(size, ends), return_index=True, return_counts=True)
        ctx, of = np.unique(grams.key(size - 1, ends[first] - 1), return_inverse=True)
        total, types = np.bincount(of, seen, len(ctx)), np.bincount(of, minlength=len(ctx))
        model[f"low{size}"], model[f"low{size}_p"] = keys, ((seen - DISCOUNT) / total[of]).astype(np.float32)
        model[f"ctx{size}"], model[f"ctx{size}_b"] = ctx, (DISCOUNT * types / total).astype(np.float32)
    return model


def _top_tables(windows: _Ends, n: np.ndarray) -> dict[str, np.ndarray]:
    """Tables of the highest order from its distinct grams with their counts ``[gram, class]``."""
    grams = windows.grams
    key, first = np.unique(windows.keys(), return_index=True)
    n, length, last = n[first], windows.length[first], windows.last[first]
    contexts, of = np.unique(grams.key(length - 1, last - 1), return_inverse=True)
    total = np.stack([np.bincount(of, n[:, c], len(contexts)) for c in (0, 1)], axis=1)
    types = np.stack([np.bincount(of, n[:, c] > 0, len(contexts)) for c in (0, 1)], axis=1)
    some = np.maximum(total, 1e-300)
    return {
        "top": key,
        "top_p": np.where(total[of] > 0, np.maximum(n - DISCOUNT, 0) / some[of], 0).astype(np.float32),
        "context": contexts,
        "context_b": np.where(total > 0, DISCOUNT * types / some, 1).astype(np.float32),
    }


def fit(vocabulary: list[str], counts: np.ndarray) -> dict[str, np.ndarray]:
    """Probability tables from distinct words and their counts ``[word, class]`` (0 ordinary, 1 toxic).

    ``train`` gets the same tables from the parts of Spark's tasks. No words: flat tables.
    """
    if not vocabulary:
        vocabulary, counts = ["a"], np.ones((1, 2))
    windows, n = _windows(vocabulary, counts)
    windows = _Ends.of(windows)
    return {**_top_tables(windows, n), **_lower_tables(windows, range(1, ORDER))}


def _per_char(grams: _Grams, at: np.ndarray, place: np.ndarray, model: dict[str, np.ndarray], indexes: dict[str, _Index]) -> np.ndarray:
    """log P(character | toxic) - log P(character | ordinary) of the characters at ``at``, at ``place`` in their words."""
    shared = np.full(len(at), ALPHABET)
    for size in range(1, ORDER):
        use = np.flatnonzero(place >= size)
        ends = at[use]
        known, p = _look(indexes[f"low{size}"], model[f"low{size}_p"], grams.key(size, ends))
        seen, back = _look(indexes[f"ctx{size}"], model[f"ctx{size}_b"], grams.key(size - 1, ends - 1))
        shared[use] = np.where(known, p, 0) + np.where(seen, back, 1) * shared[use]
    length = np.minimum(ORDER, place + 1)
    known, p = _look(indexes["top"], model["top_p"], grams.key(length, at))
    seen, back = _look(indexes["context"], model["context_b"], grams.key(length - 1, at - 1))
    both = np.where(known[:, None], p, 0) + np.where(seen[:, None], back, 1) * shared[:, None]
    return np.log(both[:, 1]) - np.log(both[:, 0])


def evidence(some: list[str], model: dict[str, np.ndarray], at_once: int = 20_000, indexes: dict[str, _Index] | None = None) -> np.ndarray:
    """log P(word | toxic) - log P(word | ordinary) of each word. ``indexes``: those of the model, if they are there."""
    indexes = indexes or _indexed(model)
    if len(some) > at_once:  # bounds the arrays of n-grams
        return np.concatenate([evidence(some[a:a + at_once], model, at_once, indexes) for a in range(0, len(some), at_once)])
    if not some:
        return np.zeros(0)
    grams = _Grams.of(some)
    at = np.flatnonzero(grams.place > 0)
    per_char = _per_char(grams, at, grams.place[at], model, indexes)
    # The end of a word's last character is position starts[i + 1] - 1.
    edges = np.searchsorted(at, grams.starts)
    return np.add.reduceat(per_char, edges)


@cache
def _points() -> tuple[np.ndarray, np.ndarray]:
    """Whether each code point is a letter of ``words``, and a hash of it."""
    letter, hashed = np.zeros(0x110000, bool), np.empty(0x110000, np.uint64)
    for a in range(0, len(letter), 0x800):
        if not 0xD800 <= a < 0xE000:  # surrogates are no text
            for m in _WORD.finditer("".join(map(chr, range(a, a + 0x800)))):
                letter[a + m.start():a + m.end()] = True
        with np.errstate(over="ignore"):
            hashed[a:a + 0x800] = _mix(np.arange(a + 1, a + 0x801, dtype=np.uint64))
    return letter, hashed


@dataclass
class _Tokens:
    """The words of some texts, in order, found for all texts at once."""

    joined: str
    starts: np.ndarray  # position of each word in ``joined``
    ends: np.ndarray
    counts: np.ndarray  # words of each text
    hashes: np.ndarray  # 64 bits for each word

    @classmethod
    def of(cls, texts: list[str]) -> _Tokens:
        lowered = [t.lower() for t in texts]
        joined = "".join(f"{t}\n" for t in lowered)
        codes = np.frombuffer(joined.encode("utf-32-le"), dtype="<u4")
        letter, hashed = _points()
        inside = letter[codes]
        edges = np.flatnonzero(np.diff(inside, prepend=False))  # the last character is no letter
        starts, ends = edges[::2], edges[1::2]
        borders = np.cumsum([0, *(len(t) + 1 for t in lowered)])
        counts = np.diff(np.searchsorted(starts, borders))
        sizes, of_letter, hashes = ends - starts, codes[inside], np.zeros(0, np.uint64)
        if len(sizes):
            first = np.cumsum(sizes) - sizes
            with np.errstate(over="ignore"):
                powers = np.cumprod(np.full(sizes.max(), _STEP))
                total = np.add.reduceat(hashed[of_letter] * powers[np.arange(len(of_letter)) - np.repeat(first, sizes)], first)
                hashes = _mix(total + sizes.astype(np.uint64))
        return cls(joined, starts, ends, counts, hashes)

    def word(self, at: int) -> str:
        return self.joined[self.starts[at]:self.ends[at]]


def _keys(hashes: np.ndarray, model: np.ndarray | int) -> np.ndarray:
    """64-bit keys of words, by their hashes, for one of the models."""
    with np.errstate(over="ignore"):
        return _mix(hashes + np.asarray(model + 1).astype(np.uint64) * _STEP)


def word_keys(some: list[str], model: int) -> np.ndarray:
    """``_keys`` of words."""
    return _keys(_Tokens.of(some).hashes, model)


def _distinct(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct values in order of appearance, and each value's place among them."""
    encoded = pa.array(values).dictionary_encode()
    return encoded.dictionary.to_numpy(), encoded.indices.to_numpy()


def _tokens_of(texts: pa.Array, at_once: int):
    """First row, end row and ``_Tokens`` of slices of the texts."""
    for a, b in slices(pc.fill_null(pc.utf8_length(texts), 0).to_pylist(), at_once):
        yield a, b, _Tokens.of([t or "" for t in texts.slice(a, b - a).to_pylist()])


def _vocabulary_of(texts: pa.Array, groups: np.ndarray, n_groups: int) -> tuple[list[str], np.ndarray]:
    """Distinct words of the texts and their counts ``[word, group]``; ``groups``: a number for each text."""
    parts = list(_tokens_of(texts, TOKEN_CHARS))
    distinct, of = _distinct(np.concatenate([t.hashes for _, _, t in parts]))
    group = np.concatenate([np.repeat(groups[a:b], t.counts) for a, b, t in parts])
    n = np.bincount(of * np.int64(n_groups) + group, minlength=len(distinct) * n_groups).reshape(len(distinct), n_groups)
    first = np.empty(len(distinct), np.int64)
    first[of[::-1]] = np.arange(len(of))[::-1]
    some, begin = [], 0
    for _, _, t in parts:  # words come in order of their first appearance
        here = first[(first >= begin) & (first < begin + len(t.hashes))] - begin
        some += map(t.word, here.tolist())
        begin += len(t.hashes)
    return some, n


FEATURES = 6


def features(scores: np.ndarray) -> list[float]:
    """Length-normalised evidence of one document from the evidence of its words, in order."""
    n = len(scores)
    if not n:
        return [0.0] * FEATURES
    best = np.sort(np.partition(scores, max(0, n - 3))[-3:])[::-1]
    best = np.concatenate([best, np.zeros(3 - len(best))])
    sums = np.concatenate([[0.0], np.cumsum(scores)])
    span = min(WINDOW, n)
    strongest = float((sums[span:] - sums[:-span]).max()) / WINDOW
    return [float(scores.mean()), best[0], best[:2].sum() / 2, best.sum() / 3, strongest, float(np.log1p(n))]


def _newton(total, penalty: float) -> np.ndarray:
    """Logistic weights (last one: intercept) of raw features by Newton's method.

    ``total(of)`` adds up the rows of numbers that ``of(x, y)`` returns for parts of the data.
    """
    n, *sums = total(lambda x, y: np.append(len(y), x.sum(axis=0)))
    mean = np.array(sums) / n
    scale = np.sqrt(total(lambda x, y: ((x - mean) ** 2).sum(axis=0)) / n) + 1e-9
    size = len(mean) + 1
    w = np.zeros(size)
    ridge = penalty * np.eye(size)
    for _ in range(50):

        def slopes(x, y, w=w):
            a = np.column_stack([(x - mean) / scale, np.ones(len(y))])
            p = 1 / (1 + np.exp(-np.clip(a @ w, -30, 30)))
            return np.append(((a * (p * (1 - p))[:, None]).T @ a).ravel(), a.T @ (y - p))

        found = total(slopes)
        step = np.linalg.solve(found[:size * size].reshape(size, size) + ridge, found[size * size:] - penalty * w)
        w = w + step
        if np.abs(step).max() < 1e-10:
            break
    return np.append(w[:-1] / scale, w[-1] - (w[:-1] * mean / scale).sum())


def calibrate(x: np.ndarray, y: np.ndarray, penalty: float = 1.0) -> np.ndarray:
    """Logistic weights (last one: intercept) of raw features, fitted by Newton's method."""
    return _newton(lambda of: of(x, y), penalty)


# --- in Spark --------------------------------------------------------------------


_PARTS = [f"n{i}" for i in range(2 * FOLDS)]  # one count by fold and class: 2 * fold + class


def _word_counts(known: DataFrame) -> DataFrame:
    """``word`` and its occurrences in all labelled documents' whole texts by fold and class."""

    def count(batches):
        for batch in batches:
            group = 2 * batch["fold"].to_numpy().astype(np.int64) + batch["toxic"].to_numpy()
            for a, b in slices(pc.fill_null(pc.utf8_length(batch["text"]), 0).to_pylist(), 4 * BATCH_CHARS):
                some, n = _vocabulary_of(batch["text"].slice(a, b - a), group[a:b], len(_PARTS))
                yield pa.RecordBatch.from_pydict({"word": pa.array(some, pa.string()), **{p: pa.array(c) for p, c in zip(_PARTS, n.T.copy())}})

    schema = "word string, " + ", ".join(f"{p} long" for p in _PARTS)
    parts = known.select("text", "toxic", "fold").mapInArrow(count, schema)
    return parts.groupBy("word").agg(*(F.sum(p).alias(p) for p in _PARTS))


def _counts(batch: pa.RecordBatch) -> tuple[list[str], np.ndarray]:
    return batch["word"].to_pylist(), np.stack([batch[p].to_numpy() for p in _PARTS], axis=1)


def _long(keys: np.ndarray) -> pa.Array:
    return pa.array(np.ascontiguousarray(keys).view(np.int64))


def _window_counts(counted: DataFrame) -> DataFrame:
    """``deal, window`` and counts by fold and class of every highest-order gram; ``deal``: the end of its context."""

    def explode(batches):
        for batch in batches:
            if batch.num_rows:
                windows, n = _windows(*_counts(batch))
                yield pa.RecordBatch.from_pydict(
                    {"deal": pa.array([w[-1 - DEALT:-1] for w in windows], pa.string()), "window": pa.array(windows, pa.string()),
                     **{p: pa.array(c.astype(np.int64)) for p, c in zip(_PARTS, n.T)}}
                )

    schema = "deal string, window string, " + ", ".join(f"{p} long" for p in _PARTS)
    return counted.mapInArrow(explode, schema).groupBy("deal", "window").agg(*(F.sum(p).alias(p) for p in _PARTS))


_LOCAL = ["top", "context", *(f"{t}{size}" for size in range(DEALT + 1, ORDER) for t in ("low", "ctx"))]


#: The first tables of each fetch: the two of the highest order, small sizes together, the larger sizes.
_FETCHED = [0, 1, 2, *range(len(_LOCAL) - 4, len(_LOCAL), 2)]


def _values(name: str) -> str:
    """The array with the values of the keys ``name``."""
    return name + ("_p" if name == "top" or name.startswith("low") else "_b")


def _model_rows(windows: DataFrame) -> DataFrame:
    """``part, key, ordinary, toxic``: the tables ``_LOCAL[part]`` of one model (one value both ways in the shared ones).

    A task has all grams of a context, since they are dealt by its end.
    """

    def tables(batches):
        parts = [b for b in batches if b.num_rows]
        if not parts:
            return
        all_rows = pa.Table.from_batches(parts)
        some, n = all_rows["window"].to_pylist(), np.stack([all_rows[c].to_numpy() for c in ("ordinary", "toxic")], axis=1)
        ends = _Ends.of(some)
        model = {**_top_tables(ends, n), **_lower_tables(ends, range(DEALT + 1, ORDER))}
        for part, name in enumerate(_LOCAL):
            values = model[_values(name)]
            values = values if values.ndim == 2 else values[:, None]
            yield pa.RecordBatch.from_pydict(
                {"part": pa.array(np.full(len(values), part, np.int32)), "key": _long(model[name]),
                 "ordinary": pa.array(np.ascontiguousarray(values[:, 0])), "toxic": pa.array(np.ascontiguousarray(values[:, -1]))}
            )

    return windows.repartition("deal").mapInArrow(tables, "part int, key long, ordinary float, toxic float")


def _gathered(windows: DataFrame) -> dict[str, np.ndarray]:
    """The tables of ``fit`` from all ``deal, window, ordinary, toxic`` of one model."""
    # The lowest orders are shared by all deals: they follow from the distinct ends of the grams, which are few.
    ends = windows.select(F.substring("window", -1 - DEALT, 1 + DEALT).alias("end")).distinct().toArrow()["end"].to_pylist()
    ends = [e for e in ends if e] or ["\na"]
    model = _lower_tables(_Ends.of(ends), range(1, DEALT + 1))
    rows = staged(_model_rows(windows), "toxicity-model")
    # The large tables come one by one, so the driver holds little besides the model.
    for first, end in zip(_FETCHED, [*_FETCHED[1:], len(_LOCAL)]):
        found = rows.where(F.col("part").between(first, end - 1)).toArrow()
        at = found["part"].to_numpy()
        for part in range(first, end):
            here = np.flatnonzero(at == part)
            keys = found["key"].to_numpy().view(np.uint64)[here]
            order = np.argsort(keys)
            model[_LOCAL[part]], here = keys[order], here[order]
            values = [found[c].to_numpy()[here] for c in (("ordinary", "toxic") if part < 2 else ("ordinary",))]
            model[_values(_LOCAL[part])] = np.stack(values, axis=1) if part < 2 else values[0]
        del found, at, here, keys, order, values
    discard(rows)
    return model


#: The model that all folds are learned by; model ``f`` below it is learned without fold ``f``.
_ALL = FOLDS


def _learned(n: np.ndarray, model: int) -> np.ndarray:
    """Counts ``[gram, class]`` of one model from those by fold and class."""
    folds = [f for f in range(FOLDS) if f != model]
    return np.stack([sum(n[:, 2 * f + c] for f in folds) for c in (0, 1)], axis=1)


def _n(rows: pa.Table) -> np.ndarray:
    return np.stack([rows[p].to_numpy() for p in _PARTS], axis=1)


def _lowest(windows: DataFrame) -> list[dict[str, np.ndarray]]:
    """The tables of the lowest orders of each model, from the distinct ends of the grams, which are few."""
    end = F.substring("window", -1 - DEALT, 1 + DEALT).alias("end")
    ends = windows.groupBy(end).agg(*(F.sum(p).alias(p) for p in _PARTS)).where("end != ''").toArrow()
    some, n = ends["end"].to_pylist(), _n(ends)
    of_model = [[e for e, known in zip(some, _learned(n, m).any(axis=1).tolist()) if known] for m in range(FOLDS + 1)]
    return [_lower_tables(_Ends.of(e or ["\na"]), range(1, DEALT + 1)) for e in of_model]


def _word_evidence(windows: DataFrame, lowest: list[dict[str, np.ndarray]], vocabulary: DataFrame) -> DataFrame:
    """``key, e``: the evidence of each distinct ``word, model`` of ``vocabulary``, by ``word_keys``.

    Slices of words ask for their distinct grams; a deal has all learned grams
    of its contexts and answers with the evidence of those that are asked for.
    """
    slices_ = -(-max(1, vocabulary.count()) // SLICE_WORDS)
    sliced = vocabulary.select("model", F.pmod(F.xxhash64("word"), F.lit(slices_)).cast("int").alias("slice"), "word")

    def ask(some: pa.Table) -> pa.Table:
        grams, _ = _windows(some["word"].to_pylist(), np.zeros((some.num_rows, 0)))
        by_deal: dict[str, list[str]] = {}
        for w in grams:
            by_deal.setdefault(w[-1 - DEALT:-1], []).append(w)
        model, part = some["model"][0].as_py(), some["slice"][0].as_py()
        return pa.table(
            {"model": pa.array([model] * len(by_deal), pa.int32()), "slice": pa.array([part] * len(by_deal), pa.int32()),
             "deal": pa.array(list(by_deal), pa.string()), "windows": pa.array(list(by_deal.values()), pa.list_(pa.string()))}
        )

    def answer(learned: pa.Table, asked: pa.Table) -> pa.Table:
        found = []
        if asked.num_rows:
            by_model: dict[int, list[int]] = {}
            for row, model in enumerate(asked["model"].to_pylist()):
                by_model.setdefault(model, []).append(row)
            ends, n = _Ends.of(learned["window"].to_pylist()), _n(learned)
            for model, rows in by_model.items():
                counts = _learned(n, model)
                use = np.flatnonzero(counts.any(axis=1))
                tables = {**lowest[model], **_top_tables(ends[use], counts[use]), **_lower_tables(ends[use], range(DEALT + 1, ORDER))}
                indexes = _indexed(tables)
                of_rows = asked.take(rows)
                for a, b in slices(pc.list_value_length(of_rows["windows"]).to_pylist(), SLICE_WORDS):
                    for_slice, some = of_rows["slice"].slice(a, b - a).to_pylist(), of_rows["windows"].slice(a, b - a).to_pylist()
                    wanted = _Ends.of(list(chain.from_iterable(some)))
                    keys = wanted.keys().view(np.int64)
                    e = _per_char(wanted.grams, wanted.last, wanted.length - 1, tables, indexes)
                    edges = np.cumsum([0, *map(len, some)])
                    found += [(model, s, keys[i:j], e[i:j]) for s, i, j in zip(for_slice, edges, edges[1:])]
        model, part, keys, e = zip(*found) if found else ((), (), (), ())
        return pa.table(
            {"model": pa.array(model, pa.int32()), "slice": pa.array(part, pa.int32()),
             "keys": pa.array(keys, pa.list_(pa.int64())), "e": pa.array(e, pa.list_(pa.float64()))}
        )

    def add(some: pa.Table, answers: pa.Table) -> pa.Table:
        words_, keys, sums = some["word"].to_pylist(), np.zeros(0, np.uint64), np.zeros(0)
        if words_:
            known = pc.list_flatten(answers["keys"]).to_numpy().view(np.uint64)
            order = np.argsort(known)
            known, e = known[order], pc.list_flatten(answers["e"]).to_numpy()[order]
            grams = _Grams.of(words_)
            at = np.flatnonzero(grams.place > 0)
            per_char = e[np.searchsorted(known, grams.key(np.minimum(ORDER, grams.place[at] + 1), at))]
            sums = np.add.reduceat(per_char, np.searchsorted(at, grams.starts))
            keys = word_keys(words_, some["model"][0].as_py())
        return pa.table({"key": _long(keys), "e": pa.array(sums, pa.float64())})

    asked = sliced.groupBy("model", "slice").applyInArrow(ask, "model int, slice int, deal string, windows array<string>")
    answers = windows.groupBy("deal").cogroup(asked.groupBy("deal")).applyInArrow(answer, "model int, slice int, keys array<long>, e array<double>")
    answers = staged(answers, "toxicity-answers")
    found = sliced.groupBy("model", "slice").cogroup(answers.groupBy("model", "slice")).applyInArrow(add, "key long, e double")
    found = staged(found, "toxicity-evidence")
    discard(answers)
    return found


class _Words:
    """The evidence of every word that is to be scored, as a broadcast."""

    def __init__(self, found: DataFrame):
        rows = found.toArrow()
        order = np.argsort(rows["key"].to_numpy().view(np.uint64))
        tables = {"word": rows["key"].to_numpy().view(np.uint64)[order], "e": rows["e"].to_numpy()[order]}
        del rows, order
        discard(found)
        self.shared, self.name = found.sparkSession.sparkContext.broadcast(tables), uuid.uuid4().hex


def _remembered(shared, name: str) -> UnitCache:
    """Memory of the words' evidence by a whole model."""

    # The broadcast is read when the memory of the model before is gone.
    def memory() -> UnitCache:
        indexes = _indexed(shared.value)
        return UnitCache(lambda new: evidence(new, shared.value, indexes=indexes).tolist(), CACHE_WORDS)

    return held(("toxicity", name), memory)


def _features_by_words(texts: pa.Array, models: np.ndarray, shared, name: str):
    """Features of each text by the evidence that was found for its words by its model."""
    index = held(("toxicity", name), lambda: _Index(shared.value["word"]))
    for a, b, tokens in _tokens_of(texts, TOKEN_CHARS):
        distinct, of = _distinct(_keys(tokens.hashes, np.repeat(models[a:b], tokens.counts)))
        known, e = _look(index, shared.value["e"], distinct)
        if not known.all():
            raise ValueError("the documents hold words that were not there when their words were collected")
        yield from map(features, np.split(e[of], np.cumsum(tokens.counts)[:-1]))


def _document_features(texts: pa.Array, memory: UnitCache):
    for a, b in slices(pc.fill_null(pc.utf8_length(texts), 0).to_pylist(), BATCH_CHARS):
        split = [words(t or "") for t in texts.slice(a, b - a).to_pylist()]
        known = memory.learn(set().union(*split))
        for some in split:
            yield features(np.fromiter(map(known.__getitem__, some), float, len(some)))


def _curve(x: list[list[float]], weights: np.ndarray) -> pa.Array:
    raw = np.array(x).reshape(-1, FEATURES) @ weights[:-1] + weights[-1]
    return pa.array(1 / (1 + np.exp(-np.clip(raw, -30, 30))), pa.float64())


class ToxicityModel:
    """A fitted model with its calibration; ``score`` works on any table with texts, ``score_of`` on a known one of any size."""

    def __init__(self, windows: DataFrame, lowest: list[dict[str, np.ndarray]], weights: np.ndarray):
        self.windows, self.lowest, self.weights, self.name = windows, lowest, weights, uuid.uuid4().hex

    @cached_property
    def shared(self):
        """All tables as a broadcast; it grows with the distinct n-grams that were learned."""
        n = [sum(F.col(_PARTS[2 * f + c]) for f in range(FOLDS)) for c in (0, 1)]
        of_all = self.windows.select("deal", "window", n[0].alias("ordinary"), n[1].alias("toxic"))
        tables = fit([], np.zeros((0, 2))) if of_all.isEmpty() else _gathered(of_all)
        return self.windows.sparkSession.sparkContext.broadcast(tables)

    def score(self, text: Column | str) -> Column:
        """Column expression: 0 to 1, higher where the toxic label is likelier. Null is empty text."""
        shared, name, weights = self.shared, self.name, self.weights

        @arrow_udf("double")
        def scored(texts: pa.Array) -> pa.Array:
            return _curve(list(_document_features(texts, _remembered(shared, name))), weights)

        return scored(F.col(text) if isinstance(text, str) else text)

    def _of_words(self, docs: DataFrame, text: str) -> tuple[_Words, Column]:
        with conf_override(docs.sparkSession, FIT_CONF):
            vocabulary = staged(_vocabulary(docs.select(F.col(text).alias("text"))), "toxicity-vocabulary")
            of_words = _Words(_word_evidence(self.windows, self.lowest, vocabulary))
            discard(vocabulary)
        shared, name, weights = of_words.shared, of_words.name, self.weights

        @arrow_udf("double")
        def scored(texts: pa.Array) -> pa.Array:
            return _curve(list(_features_by_words(texts, np.full(len(texts), _ALL), shared, name)), weights)

        return of_words, scored(F.col(text))

    def score_of(self, docs: DataFrame, text: str = "text") -> Column:
        """``score`` for the texts of ``docs`` only: no process holds the model, just the evidence of their words."""
        return self._of_words(docs, text)[1]

    def scored(self, docs: DataFrame, rows: Callable[[Column], DataFrame], text: str = "text") -> DataFrame:
        """``rows`` of ``score_of``, written here: in small batches of texts, and the words' evidence goes with the last one."""
        of_words, score = self._of_words(docs, text)
        with conf_override(docs.sparkSession, FIT_CONF):
            found = staged(rows(score), "toxicity-scored")
        of_words.shared.destroy()
        return found

    def discard(self) -> None:
        """Delete the learned n-grams; columns that were made before still work."""
        discard(self.windows)


def _vocabulary(texts: DataFrame) -> DataFrame:
    """``word, model``: the distinct words of all ``text``."""

    def distinct(batches):
        for batch in batches:
            texts = batch["text"]
            for a, b in slices(pc.fill_null(pc.utf8_length(texts), 0).to_pylist(), 4 * BATCH_CHARS):
                some, _ = _vocabulary_of(texts.slice(a, b - a), np.zeros(b - a, np.int64), 1)
                yield pa.RecordBatch.from_pydict({"word": pa.array(some, pa.string())})

    return texts.mapInArrow(distinct, "word string").distinct().select("word", F.lit(_ALL).alias("model"))


def _features_unseen(known: DataFrame, of_words: _Words) -> DataFrame:
    """``toxic, x``: the features of each labelled document by the model without its fold."""
    shared, name = of_words.shared, of_words.name

    def found(batches):
        for batch in batches:
            if batch.num_rows:
                x = list(_features_by_words(batch["text"], batch["fold"].to_numpy(), shared, name))
                yield pa.RecordBatch.from_pydict({"toxic": batch["toxic"], "x": pa.array(x, pa.list_(pa.float64()))})

    schema = StructType([known.schema["toxic"], StructField("x", ArrayType(DoubleType()))])
    return known.mapInArrow(found, schema)


def _sums(rows: DataFrame):
    """``total`` of ``_newton`` over ``x, toxic``: each task adds up its rows, the driver the tasks' sums."""

    def total(of) -> np.ndarray:
        def part(batches):
            found = [of(np.stack(b["x"].to_numpy(zero_copy_only=False)), b["toxic"].to_numpy().astype(float)) for b in batches if b.num_rows]
            if found:
                yield pa.RecordBatch.from_pydict({"s": pa.array([np.sum(found, axis=0)], pa.list_(pa.float64()))})

        return np.sum([r["s"] for r in rows.mapInArrow(part, "s array<double>").collect()], axis=0)

    return total


def train(docs: DataFrame, labels: DataFrame, text: str = "text") -> ToxicityModel:
    """Fit on all labelled rows of ``labels`` (``doc_id``, ``toxic`` 0/1; others are skipped).

    An id with several labels counts as toxic if one says so; of an id with
    several rows the smallest text is learned. Without any label,
    or without one of the classes, the models are flat and scores follow the
    share of toxic labels.
    """
    spark = docs.sparkSession
    toxic = labels.where("doc_id is not null and toxic in (0, 1)").groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    one = docs.select("doc_id", F.col(text).alias("text")).join(toxic, "doc_id")
    one = one.groupBy("doc_id", "toxic").agg(F.min("text").alias("text"))
    fold = F.pmod(F.xxhash64("doc_id", F.lit("fold")), F.lit(FOLDS)).cast("int")
    with conf_override(spark, FIT_CONF):
        known = staged(one.select("toxic", "text", fold.alias("fold")), "toxicity-known")
        counted = staged(_word_counts(known), "toxicity-words")
        windows = staged(_window_counts(counted), "toxicity-windows")
        lowest = _lowest(windows)
        in_folds = F.array(*(F.when(F.col(_PARTS[2 * f]) + F.col(_PARTS[2 * f + 1]) > 0, F.lit(f)) for f in range(FOLDS)))
        vocabulary = counted.select("word", F.explode(F.array_compact(in_folds)).alias("model"))
        unseen = _Words(_word_evidence(windows, lowest, vocabulary))
        discard(counted)
        rows = staged(_features_unseen(known, unseen), "toxicity-features")
        unseen.shared.destroy()
        discard(known)
        weights = np.zeros(FEATURES + 1) if rows.isEmpty() else _newton(_sums(rows), 1.0)
        discard(rows)
    return ToxicityModel(windows, lowest, weights)


def held_out(doc_id: Column) -> Column:
    """The rows that labels are never learned from: crc32 of the id as text, modulo 4, is 2."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def _train_unheld(docs: DataFrame, labels: DataFrame) -> ToxicityModel:
    # Filtered on both sides of the join: no text of a held-out row is shuffled.
    learned = ~held_out(F.col("doc_id"))
    return train(docs.where(learned), labels.where(learned))


def score_documents(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """Every row's ``doc_id, held_out, score, predicted``.

    One output row per input row; a null or empty text is scored like any
    other (no evidence either way); a null id is not held out.
    """
    model = _train_unheld(docs, labels)
    scored = model.scored(docs, lambda score: docs.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), score.alias("score")))
    model.discard()
    return scored.withColumn("predicted", (F.col("score") >= threshold).cast("int"))


def without_toxic(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``docs`` whose score is below the threshold, all columns unchanged."""
    model = _train_unheld(docs, labels)
    kept = model.scored(docs, lambda score: docs.where(score < threshold))
    model.discard()
    return kept
