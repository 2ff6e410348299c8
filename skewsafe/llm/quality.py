"""Operator 5: line sequence labelling with a linear-chain conditional random field.

A document is the sequence of its lines that hold a word. A two-state CRF
(boilerplate, content) scores each line by its features and each pair of
neighbours by a transition; Viterbi decoding marks every line, and the share of
words in content lines decides whether the document stays.

The CRF is fitted by maximum likelihood on a bounded sample of labelled
documents (``SAMPLE`` of each quality, chosen by a hash of their id): all lines
of a good document count as content, all of a bad one as boilerplate; the
features and the neighbours sort out the exceptions. Training sequences are the
whole documents in stretches of ``STRETCH`` lines. Decoding covers every line of
every document.
"""

from __future__ import annotations

from itertools import pairwise
from operator import eq

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf

from skewsafe.llm.common import staged
from skewsafe.llm.tokenizers_cache import slices

SAMPLE = 1500
STRETCH = 64
MIN_SHARE = 0.5
MIN_WORDS, MAX_REPEAT_PERCENT = 50, 50
BATCH_CHARS = 4_000_000
SYMBOLS = "#*$%&|<>"
SPACES = " \t\n\x0b\x0c\r"


# --- base rules --------------------------------------------------------------------


def base_counts(text: str) -> tuple[int, int, int, int, int]:
    """``n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words`` of the whole text."""
    words = text.encode().split()  # bytes: 0x20 and 0x09-0x0D only
    chars = len(text) - sum(map(text.count, SPACES))
    symbols = sum(map(text.count, SYMBOLS))
    seen: set[str] = set()
    dup = 0
    for line in text.split("\n"):
        if line in seen:
            dup += 1
        elif line.strip(SPACES):
            seen.add(line)
    return len(words), chars, symbols, dup, _repeated_words(words)


def _repeated_words(words: list[bytes]) -> int:
    """Words inside 3-word windows that occur at least twice in the text."""
    n = len(words) - 2
    if n < 2:
        return 0
    number: dict[bytes, int] = {}
    ids = np.fromiter((number.setdefault(w, len(number)) for w in words), np.int64, len(words))
    size = len(number)
    if size < 2_000_000:
        windows = (ids[:-2] * size + ids[1:-1]) * size + ids[2:]
    else:  # the product would overflow: number the pairs first
        _, pairs = np.unique(ids[:-1] * size + ids[1:], return_inverse=True)
        windows = pairs[:-1] * size + ids[2:]
    order = np.argsort(windows, kind="stable")
    ranked = windows[order]
    same = ranked[1:] == ranked[:-1]
    twice = np.zeros(n, bool)
    twice[order[1:][same]] = True
    twice[order[:-1][same]] = True
    covered = np.zeros(len(words), bool)
    for k in range(3):
        covered[k:n + k] |= twice
    return int(covered.sum())


# --- lines and their features --------------------------------------------------------

FEATURES = 17


def line_features(text: str) -> tuple[list[list[float]], list[int]]:
    """Features and word counts of the text's lines that hold a word."""
    rows, sizes = [], []
    seen: set[str] = set()
    for line in text.split("\n"):
        words = line.encode().split()
        n = len(words)
        if not n:
            continue
        symbols = sum(map(line.count, SYMBOLS)) / n
        distinct = len(set(words)) / n
        neighbours = sum(map(eq, words, words[1:])) / n
        bangs = line.count("!") / n
        last = line.rstrip(SPACES)[-1]
        rows.append(
            [
                1.0,
                float(n < 5),
                float(n < 12),
                min(np.log1p(n) / 5, 2.0),
                float(symbols > 0),
                min(symbols, 2.0),
                float(symbols > 0.3),
                min(line.count("|") / n, 1.0),
                float(line.isupper() and n > 2),
                min(bangs, 1.0),
                1.0 - distinct if n >= 10 else 0.0,
                float(n >= 10 and distinct < 0.5),
                min(neighbours, 1.0),
                float(line in seen),
                float(last in ".!?"),
                min(len(line) / n / 10, 2.0),
                min(sum(map(line.count, "0123456789")) / len(line), 1.0),
            ]
        )
        sizes.append(n)
        seen.add(line)
    return rows, sizes


# --- the conditional random field -------------------------------------------------------


def _log_sum(a: np.ndarray, axis: int) -> np.ndarray:
    top = a.max(axis=axis, keepdims=True)
    return (top + np.log(np.exp(a - top).sum(axis=axis, keepdims=True))).squeeze(axis)


def fit_crf(
    sequences: list[np.ndarray], labels: list[int], rounds: int = 300, penalty: float = 1.0
) -> tuple[np.ndarray, np.ndarray]:
    """Maximum-likelihood weights: per feature (of state 1 against state 0) and 2 x 2 transitions.

    Each sequence has one label for all its lines. Forward-backward over all
    sequences at once, gradient steps with adaptive rates (Adam), L2 penalty.
    """
    if not sequences or len(set(labels)) < 2:
        w = np.zeros(FEATURES)
        w[0] = 1.0 if not labels or labels[0] else -1.0
        return w, np.zeros((2, 2))
    order = sorted(range(len(sequences)), key=lambda i: -len(sequences[i]))
    seqs, y = [sequences[i] for i in order], np.array([labels[i] for i in order])
    sizes = np.array([len(s) for s in seqs])
    steps = int(sizes[0])
    x = np.zeros((steps, len(seqs), FEATURES))
    for i, s in enumerate(seqs):
        x[: len(s), i] = s
    active = [int((sizes > t).sum()) for t in range(steps)]  # sequences are ordered: a prefix is active
    mask = np.arange(steps)[:, None] < sizes[None, :]
    lines = int(sizes.sum())
    want = np.einsum("tsf,ts->f", x, mask * y[None, :])
    moves = np.zeros((2, 2))
    np.add.at(moves, (y, y), sizes - 1)
    w, trans = np.zeros(FEATURES), np.zeros((2, 2))
    theta = np.zeros(FEATURES + 4)
    m, v = np.zeros_like(theta), np.zeros_like(theta)
    for step in range(1, rounds + 1):
        w, trans = theta[:FEATURES], theta[FEATURES:].reshape(2, 2)
        emit = np.zeros((steps, len(seqs), 2))
        emit[:, :, 1] = x @ w
        forward, backward = np.zeros_like(emit), np.zeros_like(emit)
        forward[0] = emit[0]
        for t in range(1, steps):
            k = active[t]
            forward[t, :k] = emit[t, :k] + _log_sum(forward[t - 1, :k, :, None] + trans, 1)
        pair = np.zeros((2, 2))
        total = np.zeros(len(seqs))
        for t in range(steps - 1, -1, -1):
            k, after = active[t], active[t + 1] if t + 1 < steps else 0
            if after:
                follow = trans + (emit[t + 1, :after] + backward[t + 1, :after])[:, None, :]
                backward[t, :after] = _log_sum(follow, 2)
            total[after:k] = _log_sum(forward[t, after:k], 1)
            if after:
                pair += np.exp(forward[t, :after, :, None] + follow - total[:after, None, None]).sum(axis=0)
        content = np.exp(forward[:, :, 1] + backward[:, :, 1] - total) * mask
        gradient = np.concatenate([want - np.einsum("tsf,ts->f", x, content), (moves - pair).ravel()])
        gradient = (gradient - penalty * theta) / lines
        m, v = 0.9 * m + 0.1 * gradient, 0.999 * v + 0.001 * gradient**2
        rate = 0.1 * (1 - (step - 1) / rounds)
        theta = theta + rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
    return theta[:FEATURES], theta[FEATURES:].reshape(2, 2)


def viterbi(emit: np.ndarray, ends: np.ndarray, trans: np.ndarray) -> np.ndarray:
    """The best states of many sequences at once.

    ``emit`` holds the content score of every line (boilerplate: 0), sequence
    after sequence; ``ends`` where each sequence ends. Ties go to content.
    """
    sizes = np.diff(ends, prepend=0)
    order = np.argsort(-sizes, kind="stable")
    begin, sizes = (ends - np.diff(ends, prepend=0))[order], sizes[order]
    best = np.zeros((len(emit), 2))
    came = np.zeros((len(emit), 2), np.int8)
    best[:, 1] = emit
    states = np.zeros(len(emit), np.int8)
    steps = int(sizes[0]) if len(sizes) else 0
    active = np.searchsorted(-sizes, -np.arange(steps), side="left")  # sequences longer than t
    for t in range(1, steps):
        at = begin[: active[t]] + t
        options = best[at - 1][:, :, None] + trans
        came[at] = options[:, 1] >= options[:, 0]
        best[at] += options.max(axis=1)
    for t in range(steps - 1, -1, -1):
        at = begin[: active[t]] + t
        last = sizes[: active[t]] == t + 1
        choice = (best[at, 1] >= best[at, 0]).astype(np.int8)
        if t + 1 < steps:
            follow = np.where(last, 0, at + 1)
            choice = np.where(last, choice, came[follow, states[follow]])
        states[at] = choice
    return states


# --- in Spark ------------------------------------------------------------------------------


def _sequences(text: Column) -> Column:
    """Column expression: the line features of each text, as rows of doubles."""

    @arrow_udf("array<array<double>>")
    def rows(texts: pa.Array) -> pa.Array:
        return pa.array([line_features(t.as_py() or "")[0] for t in texts], pa.list_(pa.list_(pa.float64())))

    return rows(text)


class LineModel:
    """A fitted CRF."""

    def __init__(self, weights: np.ndarray, transitions: np.ndarray):
        self.weights, self.transitions = weights, transitions

    def content_lines(self, text: str) -> list[bool]:
        """For each line of ``text``: whether it is content (lines without a word: no)."""
        rows, _ = line_features(text)
        states = iter(viterbi(np.array(rows).reshape(-1, FEATURES) @ self.weights, np.array([len(rows)]), self.transitions))
        return [bool(next(states)) if line.strip(SPACES) else False for line in text.split("\n")]

    def judge(self, text: Column | str, min_share: float = MIN_SHARE) -> Column:
        """Column expression: struct of the base counts, ``base_failed``, ``content_share`` and ``kept``."""
        weights, transitions = self.weights, self.transitions

        @arrow_udf(
            "struct<n_words:long,word_chars:long,n_symbols:long,n_dup_lines:long,n_repeat_words:long,"
            "base_failed:boolean,content_share:double,kept:boolean>"
        )
        def judged(texts: pa.Array) -> pa.Array:
            counts, shares = [], []
            for a, b in slices(pc.fill_null(pc.utf8_length(texts), 0).to_pylist(), BATCH_CHARS):
                rows, sizes, ends = [], [], []
                for t in texts.slice(a, b - a):
                    body = t.as_py() or ""
                    counts.append(base_counts(body))
                    found, n = line_features(body)
                    rows += found
                    sizes += n
                    ends.append(len(sizes))
                states = viterbi(np.array(rows).reshape(-1, FEATURES) @ weights, np.array(ends), transitions)
                n = np.concatenate([[0], np.cumsum(sizes)])
                content = np.concatenate([[0], np.cumsum(np.array(sizes, dtype=np.int64) * states)])
                shares += [(content[j] - content[i]) / max(1, n[j] - n[i]) for i, j in pairwise([0, *ends])]
            table = np.array(counts, dtype=np.int64).reshape(-1, 5)
            failed = (table[:, 0] < MIN_WORDS) | (100 * table[:, 4] > MAX_REPEAT_PERCENT * table[:, 0])
            share = np.array(shares, dtype=float)
            columns = [pa.array(table[:, k]) for k in range(5)]
            columns += [pa.array(failed), pa.array(share), pa.array(~failed & (share >= min_share))]
            names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
            return pa.StructArray.from_arrays(columns, [*names, "base_failed", "content_share", "kept"])

        return judged(F.col(text) if isinstance(text, str) else text)


def train(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, text: str = "text") -> LineModel:
    """Fit on ``sample`` labelled documents of each quality (``doc_id``, ``quality`` 0/1; others are skipped).

    An id with several labels counts as good if one says so. With no label, or
    only good ones, every line is content (only bad ones: boilerplate).
    """
    known = labels.where("doc_id is not null and quality in (0, 1)").groupBy("doc_id")
    known = known.agg(F.max("quality").alias("quality"))
    chosen = [
        known.where(F.col("quality") == q).orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample) for q in (0, 1)
    ]
    ids = chosen[0].unionByName(chosen[1])  # bounded by the sample size
    rows = docs.select("doc_id", F.col(text).alias("text")).join(F.broadcast(ids), "doc_id")
    lines = staged(rows.select("doc_id", "quality", _sequences(F.col("text")).alias("x")), "quality-sample").collect()
    sequences, y = [], []
    for r in sorted(lines, key=lambda r: (r["doc_id"], r["x"])):
        x = np.array(r["x"]).reshape(-1, FEATURES)
        for a in range(0, len(x), STRETCH):
            sequences.append(x[a:a + STRETCH])
            y.append(r["quality"])
    return LineModel(*fit_crf(sequences, y))


def judge_documents(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Every row's ``doc_id``, base counts, ``base_failed``, ``kept`` and ``content_share``.

    One output row per input row. A null text is empty: no words, so it fails
    the base rules. ``kept`` is false for those, else the CRF's verdict.
    """
    judged = docs.select("doc_id", train(docs, labels).judge("text").alias("j"))
    return judged.select("doc_id", "j.*")


def good_documents(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of ``docs`` that are kept, all columns unchanged."""
    return docs.where(train(docs, labels).judge("text")["kept"])
