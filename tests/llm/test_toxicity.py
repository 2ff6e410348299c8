"""Operator 7: probabilities by brute force, held-out accuracy."""

import math
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from skewsafe.llm import toxicity
from skewsafe.llm.common import table
from tests.conftest import SF_MID

from .helpers import ODD_TEXTS, docs, no_docs


def brute_model(vocabulary, counts):
    """Evidence function of the same model from dictionaries of strings."""
    order, discount = toxicity.ORDER, toxicity.DISCOUNT
    top, total, types = [Counter(), Counter()], [Counter(), Counter()], [Counter(), Counter()]
    grams = set()
    for word, n in zip(vocabulary, counts):
        s = f"^{word}$"
        for i in range(1, len(s)):
            g = s[max(0, i - order + 1):i + 1]
            grams.add(g)
            for c in (0, 1):
                top[c][g] += n[c]
    for c in (0, 1):
        for g, n in top[c].items():
            total[c][g[:-1]] += n
            types[c][g[:-1]] += n > 0
    low, frontier = Counter(), {g for g in grams if len(g) == order}
    for size in range(order, 1, -1):
        shorter = Counter(g[1:] for g in frontier)
        low.update(shorter)
        frontier = set(shorter) | {g for g in grams if len(g) == size - 1}
    low_total, low_types = Counter(), Counter()
    for g, n in low.items():
        low_total[g[:-1], len(g)] += n
        low_types[g[:-1], len(g)] += 1

    def shared(g):
        if not g:
            return toxicity.ALPHABET
        n = low_total[g[:-1], len(g)]
        rest = shared(g[1:])
        if not n:
            return rest
        return max(low[g] - discount, 0) / n + discount * low_types[g[:-1], len(g)] / n * rest

    def evidence(word):
        s, out = f"^{word}$", 0.0
        for i in range(1, len(s)):
            g = s[max(0, i - order + 1):i + 1]
            rest, p = shared(g[1:]), []
            for c in (0, 1):
                n = total[c][g[:-1]]
                p.append(max(top[c][g] - discount, 0) / n + discount * types[c][g[:-1]] / n * rest if n else rest)
            out += math.log(p[1]) - math.log(p[0])
        return out

    return evidence


def test_evidence_matches_brute_force():
    rng = np.random.default_rng(1)
    vocabulary = sorted({"".join(rng.choice(list("abcé"), rng.integers(1, 14))) for _ in range(120)})
    counts = rng.integers(0, 4, (len(vocabulary), 2)).astype(float)
    counts[counts.sum(axis=1) == 0] = 1
    unseen = ["zzz", "abab", "a", "ccccccccccccccc", "éa"]
    got = toxicity.evidence([*vocabulary, *unseen], toxicity.fit(vocabulary, counts))
    want = brute_model(vocabulary, counts)
    assert np.allclose(got, [want(w) for w in [*vocabulary, *unseen]], atol=1e-4)


@pytest.fixture(scope="module")
def scored(spark):
    return toxicity.score_documents(table(spark, SF_MID, "documents"), table(spark, SF_MID, "labels")).collect()


def test_held_out_rows_and_accuracy(spark, scored):
    labels = {r["doc_id"]: r["toxic"] for r in table(spark, SF_MID, "labels").collect()}
    assert len(scored) == 1000
    for r in scored:
        assert r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2)
        assert 0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.3)
    held = [(labels[r["doc_id"]], r["predicted"]) for r in scored if r["held_out"] and r["doc_id"] in labels]
    assert sum(p for y, p in held if not y) <= 0.05 * sum(not y for y, _ in held)
    # 34 toxic documents to learn from.
    assert sum(p for y, p in held if y) >= 0.6 * sum(y for y, _ in held)


def test_the_models_learn_from_the_whole_sample(spark):
    """1500 toxic and 3000 ordinary documents, each with a word of its own: every word is in the final model."""
    texts = ["".join(chr(97 + i // 26**k % 26) for k in range(4)) for i in range(4500)]
    labels = spark.createDataFrame([(i, 1, int(i % 3 == 0)) for i in range(4500)], "doc_id long, quality int, toxic int")
    tables = toxicity.train(docs(spark, texts), labels).shared.value
    grams = toxicity._Grams.of(texts)
    ends = grams.starts + 5  # start mark, four letters, end mark
    assert np.isin(grams.key(6, ends), tables["top"]).all()


def test_the_models_learn_from_every_labelled_row(spark):
    """More labelled rows of both classes than the sample once took; the tables are those of all words."""
    texts = ["".join(chr(97 + i // 26**k % 26) for k in range(4)) for i in range(5600)]
    labels = spark.createDataFrame([(i, 1, int(i % 3 == 0)) for i in range(5600)], "doc_id long, quality int, toxic int")
    model = toxicity.train(docs(spark, texts).repartition(4), labels)
    tables = model.shared.value
    want = toxicity.fit(texts, np.array([[i % 3 != 0, i % 3 == 0] for i in range(5600)], float))
    assert set(tables) == set(want)
    for name, values in want.items():
        assert np.array_equal(tables[name], values), name


def test_words_of_all_texts_at_once():
    texts = [t or "" for t in ODD_TEXTS] + ["ΌΔΟΣ ΣΑΣ. İstanbul_x1 ²a٣b", "ß", "", "\x00\U0001d400b", "don't"]
    tokens = toxicity._Tokens.of(texts)
    want = [toxicity.words(t) for t in texts]
    assert [tokens.word(i) for i in range(len(tokens.hashes))] == [w for some in want for w in some]
    assert tokens.counts.tolist() == [len(some) for some in want]
    flat = sorted({w for some in want for w in some})
    assert len(set(toxicity.word_keys(flat, 0).tolist() + toxicity.word_keys(flat, 1).tolist())) == 2 * len(flat)
    some, n = toxicity._vocabulary_of(pa.array(texts), np.arange(len(texts)) % 3, 3)
    count = [Counter(w for t in want[g::3] for w in t) for g in range(3)]
    assert sorted(some) == flat and [tuple(r) for r in n.tolist()] == [tuple(c[w] for c in count) for w in some]


def test_scores_by_words_need_no_whole_model(spark, monkeypatch):
    """Scores found without any process holding the tables are those by the tables, also of words that were not learned."""
    monkeypatch.setattr(toxicity, "SLICE_WORDS", 50)
    rng = np.random.default_rng(5)
    letters = list("abcdé中")
    texts = [" ".join("".join(rng.choice(letters, rng.integers(1, 13))) for _ in range(rng.integers(1, 30))) for _ in range(150)]
    labels = spark.createDataFrame([(i, 1, int(i % 3 == 0)) for i in range(100)], "doc_id long, quality int, toxic int")
    all_docs = docs(spark, texts + ODD_TEXTS)
    model = toxicity.train(all_docs, labels)
    by_words = model.score_of(all_docs)
    rows = all_docs.select(by_words.alias("a"), model.score("text").alias("b")).collect()
    assert len(rows) == len(texts) + len(ODD_TEXTS) and len({round(r["a"], 6) for r in rows}) > 100
    assert np.allclose([r["a"] for r in rows], [r["b"] for r in rows], rtol=1e-9, atol=1e-12)
    # What is broadcast: one key and one number for each word.
    vocabulary = spark.createDataFrame([(w, toxicity._ALL) for w in ("abc", "é", "zz")], "word string, model int")
    found = toxicity._Words(toxicity._word_evidence(model.windows, model.lowest, vocabulary)).shared.value
    assert {k: len(v) for k, v in found.items()} == {"word": 3, "e": 3}
    want = toxicity.evidence(["abc", "é", "zz"], model.shared.value)
    at = np.argsort(toxicity.word_keys(["abc", "é", "zz"], toxicity._ALL))
    assert np.allclose(found["e"], want[at], rtol=1e-9, atol=1e-12)


def test_ends_hold_two_positions_of_each_gram():
    """The grams that end at the last two characters of a window; those that end before are not kept."""
    some = ["\na", "ab ", "\nabcdéf ", "bcdéfghi ", "中文"]
    ends, whole = toxicity._Ends.of(some), toxicity._Grams.of([w.strip() for w in some])
    assert ends.grams.keys.shape == (toxicity.ORDER, 2 * len(some))
    # "\nabcdéf " is a whole word between its marks.
    last = whole.starts[2] + len(some[2]) - 1
    for size in range(1, len(some[2])):
        assert ends.grams.key(size, ends.last[2:3]) == whole.key(size, np.array([last]))
        assert ends.grams.key(size, ends.last[2:3] - 1) == whole.key(size, np.array([last - 1]))
    assert toxicity._Ends.of([]).keys().size == 0


def test_words_are_found_for_few_characters_at_once():
    texts = pa.array(["some words " * 2_000] * 100)
    parts = [(b - a, len(t.joined)) for a, b, t in toxicity._tokens_of(texts, toxicity.TOKEN_CHARS)]
    assert sum(n for n, _ in parts) == 100 and max(size for _, size in parts) < 300_000


def test_texts_are_scored_in_small_batches(spark, monkeypatch):
    """Both queries write their scores while the batches of texts are small; later reads run no Python."""
    write, seen = toxicity.staged, []

    def staged(df, label):
        plan = df._jdf.queryExecution().executedPlan().toString()
        seen.append((label, "ArrowEvalPython" in plan, spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch"), spark.conf.get("spark.sql.execution.arrow.maxBytesPerBatch")))
        return write(df, label)

    monkeypatch.setattr(toxicity, "staged", staged)
    texts = ["good text of words", "vile words here", "more good text", None] * 10
    labels = spark.createDataFrame([(i, 1, int(i % 4 == 1)) for i in range(40)], "doc_id long, quality int, toxic int")
    for query in (toxicity.score_documents, toxicity.without_toxic):
        seen.clear()
        found = query(docs(spark, texts), labels)
        assert [x for x in seen if x[1]] == [("toxicity-scored", True, "2000", "4m")]
        assert "ArrowEvalPython" not in found._jdf.queryExecution().executedPlan().toString()
        assert found.count() == (40 if query is toxicity.score_documents else 30)


def test_curve_from_sums_of_tasks(spark):
    rng = np.random.default_rng(3)
    x = rng.normal(size=(700, toxicity.FEATURES)) * [1, 2, 3, 4, 5, 6] + 1
    y = (x[:, 0] + rng.normal(size=700) > 1.5).astype(int)
    rows = spark.createDataFrame([(int(t), r.tolist()) for t, r in zip(y, x)], "toxic int, x array<double>").repartition(5)
    assert np.allclose(toxicity._newton(toxicity._sums(rows), 1.0), toxicity.calibrate(x, y.astype(float)), atol=1e-8)


def test_scores_do_not_depend_on_other_columns(spark):
    labels = table(spark, SF_MID, "labels")
    model = toxicity.train(table(spark, SF_MID, "documents"), labels)
    df = docs(spark, [*ODD_TEXTS, "same text", "same text"]).withColumnRenamed("lang", "score")
    rows = {r["doc_id"]: r["s"] for r in df.select("doc_id", model.score("text").alias("s")).collect()}
    assert len(rows) == len(ODD_TEXTS) + 2 and all(0 <= s <= 1 for s in rows.values())
    assert rows[len(ODD_TEXTS)] == rows[len(ODD_TEXTS) + 1]
    assert rows[0] == rows[1] == rows[2] < 0.3


def test_empty_tables_and_odd_labels(spark):
    labels = table(spark, SF_MID, "labels")
    assert toxicity.score_documents(no_docs(spark), labels).count() == 0
    odd = spark.createDataFrame([(None, 1, 1), (0, None, None), (1, 1, 7)], "doc_id long, quality int, toxic int")
    assert toxicity.score_documents(docs(spark, ODD_TEXTS, [None] * len(ODD_TEXTS)), odd).count() == len(ODD_TEXTS)
    assert toxicity.without_toxic(docs(spark, ["a", None]), labels.where("false")).columns == docs(spark, []).columns
