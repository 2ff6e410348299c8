"""Operator 5: base counts by brute force, decoding by brute force, held-out accuracy."""

from collections import Counter
from itertools import product

import numpy as np
import pytest

from skewsafe.llm import quality
from skewsafe.llm.common import table
from tests.conftest import SF_MID

from .helpers import ODD_TEXTS, docs, no_docs

SPACES = " \t\n\x0b\x0c\r"


def split(text):
    out, word = [], ""
    for c in text + " ":
        if c in SPACES:
            out += [word] if word else []
            word = ""
        else:
            word += c
    return out


def brute_counts(text):
    words = split(text)
    windows = [tuple(words[i:i + 3]) for i in range(len(words) - 2)]
    seen = Counter(windows)
    repeated = {i + k for i, w in enumerate(windows) if seen[w] > 1 for k in range(3)}
    lines = text.split("\n")
    dup = sum(bool(split(line)) and line in lines[:i] for i, line in enumerate(lines))
    return len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), dup, len(repeated)


@pytest.fixture(scope="module")
def labels(spark):
    return table(spark, SF_MID, "labels")


def test_base_counts_and_verdicts(spark, labels):
    texts = [*ODD_TEXTS, "a b c a b c\na b c\n\n \na b c", "x\xa0y z\x1cw " * 20, "#*$%&|<> b\n" * 30,
             "Good plain words stand here, each of them once or so. " + " ".join(f"w{i}" for i in range(60))]
    good = table(spark, SF_MID, "documents")
    judged = docs(spark, texts).withColumnRenamed("lang", "kept")
    judged = judged.select("doc_id", quality.train(good, labels).judge("text").alias("j")).select("doc_id", "j.*")
    for r in judged.collect():
        want = brute_counts(texts[r["doc_id"]] or "")
        assert (r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"]) == want
        failed = want[0] < 50 or 100 * want[4] > 50 * want[0]
        assert r["base_failed"] == failed
        assert not (failed and r["kept"])
    assert [r["kept"] for r in judged.where(f"doc_id = {len(texts) - 1}").collect()] == [True]


def test_viterbi_matches_brute_force():
    rng = np.random.default_rng(3)
    emit = rng.normal(size=40)
    trans = rng.normal(size=(2, 2))
    ends = np.array([0, 1, 4, 4, 11, 20, 28, 40])
    states = quality.viterbi(emit, ends, trans)
    for a, b in zip([0, *ends], ends):
        scores = {
            path: sum(emit[a + t] * s for t, s in enumerate(path)) + sum(trans[i, j] for i, j in zip(path, path[1:]))
            for path in product((0, 1), repeat=b - a)
        }
        assert scores[tuple(states[a:b])] == pytest.approx(max(scores.values()))


def test_gradient_reaches_the_likelihood_optimum():
    """Against the exact log-likelihood by enumeration, no small step improves it."""
    rng = np.random.default_rng(4)
    sequences = [rng.normal(size=(n, quality.FEATURES)) for n in (1, 2, 3, 4, 2, 3)]
    labels = [0, 1, 1, 0, 1, 0]
    w, trans = quality.fit_crf(sequences, labels, rounds=2000)

    def objective(w, trans):
        total = -0.5 * (np.sum(w**2) + np.sum(trans**2))
        for x, y in zip(sequences, labels):
            emit = x @ w
            paths = list(product((0, 1), repeat=len(x)))
            score = [sum(emit[t] * s for t, s in enumerate(p)) + sum(trans[i, j] for i, j in zip(p, p[1:])) for p in paths]
            total += score[paths.index((y,) * len(x))] - np.log(np.sum(np.exp(score)))
        return total

    best = objective(w, trans)
    for _ in range(50):
        step = 0.01 * rng.normal(size=quality.FEATURES + 4)
        assert objective(w + step[:-4], trans + step[-4:].reshape(2, 2)) <= best + 1e-3


def test_held_out_accuracy(spark, labels):
    """Fitted on the even ids only, nearly all odd ids are judged as labelled."""
    good = table(spark, SF_MID, "documents")
    model = quality.train(good, labels.where("doc_id % 2 = 0"))
    odd = good.join(labels.where("doc_id % 2 = 1"), "doc_id").select("quality", model.judge("text").alias("j"))
    rows = odd.where("not j.base_failed").select("quality", "j.kept").collect()
    assert np.mean([bool(r["quality"]) == r["kept"] for r in rows]) > 0.95
    assert np.mean([r["kept"] for r in rows if r["quality"]]) > 0.97


def test_no_labels_and_no_rows(spark, labels):
    empty = labels.where("false")
    assert quality.judge_documents(no_docs(spark), labels).count() == 0
    kept = quality.good_documents(docs(spark, [" ".join(f"w{i}" for i in range(60)), "short", None]), empty)
    assert [r["doc_id"] for r in kept.collect()] == [0]
    odd = spark.createDataFrame([(None, None, None), (1, None, 2)], "doc_id long, quality int, toxic int")
    assert quality.judge_documents(docs(spark, ODD_TEXTS), odd).count() == len(ODD_TEXTS)
