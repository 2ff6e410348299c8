"""Collocations against a plain count of all phrases; compact paths; exact arithmetic."""

import random
import re
import tracemalloc
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from skewsafe.llm import phrases as P
from skewsafe.llm.common import staged
from tests.llm.helpers import ODD_TEXTS, SCHEMA, docs, no_docs

LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


def brute_force(rows, top=P.TOP, least=10):
    counts, words = defaultdict(Counter), Counter()
    for lang, text in rows:
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(LOWER)):
            w = re.findall(r"[^\x20\x09]+", piece)
            words[lang or "und" if lang is None else lang] += len(w)
            for k in (1, 2, 3):
                counts["und" if lang is None else lang].update(tuple(w[i:i + k]) for i in range(len(w) - k + 1))
    out = []
    for lang, f in counts.items():
        found = []
        frequent = {g: a for g, a in f.items() if len(g) > 1 and a >= least}
        for g, a in frequent.items():
            if any(len(h) > len(g) and 100 * b >= 50 * a and any(h[i:i + len(g)] == g for i in range(len(h))) for h, b in frequent.items()):
                continue
            score, _, left, right = min((10**6 * a * a // (f[g[:k]] * f[g[k:]]), k, f[g[:k]], f[g[k:]]) for k in range(1, len(g)))
            found.append((-score, -a, " ".join(g).encode(), left, right))
        found.sort()
        for rank, (score, a, phrase, left, right) in enumerate(found[:top], 1):
            out.append((lang, rank, phrase.decode(), -a, left, right, words[lang], -score))
    return sorted(out)


def texts(n, seed):
    rng = random.Random(seed)
    passage = " ".join(f"p{i}" for i in range(60))
    out = []
    for _ in range(n):
        words = rng.choices(["a", "b", "B", "c", "Dé", "é", "x", "😀", "\x0b", "　", "tab\tbed"], [9, 7, 2, 5, 1, 3, 2, 1, 1, 1, 1], k=rng.randint(0, 25))
        out.append(rng.choice(["", passage + " ", "a a a a a a a a "]) + " ".join(words) + rng.choice(["", ".", ", " + passage, "!?\n\r x"]))
    return out


def result(spark, frame, **kw):
    return sorted(tuple(r) for r in P.collocations(frame, **kw).collect())


def test_against_plain_counts(spark):
    rng = random.Random(1)
    rows = [(i, t, rng.choice(["en", "de", None, ""]), "s", 0) for i, t in enumerate([*ODD_TEXTS, *texts(250, 2), *["ring of words round the "] * 30])]
    frame = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "'k' AS kind", "'n' AS node", "1 AS n", "'e' AS next").repartition(7)
    expected = brute_force([(r[2], r[1]) for r in rows])
    assert len(expected) > 100
    assert result(spark, frame) == expected
    assert result(spark, frame, top=5) == brute_force([(r[2], r[1]) for r in rows], top=5)


def test_empty_and_rare(spark):
    assert result(spark, no_docs(spark)) == []
    assert result(spark, docs(spark, [None, "", "only once here"])) == []


def test_repeated_passage_and_rings(spark):
    """A ring without an end ("a b c a b c ...") and a long passage in many documents."""
    passage = " ".join(f"word{i}" for i in range(500))
    rows = ["a b c " * 50, "z " * 80, *[passage] * 12]
    assert result(spark, docs(spark, rows)) == brute_force([("en", t) for t in rows])
    graph = staged(P.flows(P.edges(docs(spark, rows))), "test-graph")
    paths = P.compact_paths(graph).collect()
    edge = {(r["node"], r["next"]): r["n"] for r in graph.where("kind = 'edge'").collect()}
    seen = Counter()
    for p in paths:
        words = p["words"].split(" ")
        assert [n["node"] for n in p["nodes"]] == [" ".join(words[i:i + 2]) for i in range(len(words) - 1)]
        for i, weight in enumerate(p["weights"]):
            seen[" ".join(words[i:i + 2]), words[i + 2]] += 1
            assert edge[" ".join(words[i:i + 2]), words[i + 2]] == weight
    assert set(seen) == set(edge) and set(seen.values()) == {1}
    assert len(paths) < 0.7 * len(edge) and max(len(p["weights"]) for p in paths) < 40


def test_flows_give_all_shorter_counts(spark):
    rows = texts(200, 5)
    found = defaultdict(int)
    for r in P.flows(P.edges(docs(spark, rows)), 1).collect():
        found[r["kind"], f"{r['node']} {r['next']}".rstrip(' ')] += r["n"]
    plain = Counter()
    for t in rows:
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", t.translate(LOWER)):
            w = re.findall(r"[^\x20\x09]+", piece)
            for k, kind in ((1, "word"), (2, "pair"), (3, "edge")):
                plain.update((kind, " ".join(w[i:i + k])) for i in range(len(w) - k + 1))
    assert dict(found) == dict(plain)


def test_wide_keys_are_counted_alike():
    rng = np.random.default_rng(1)
    columns = [rng.integers(0, 3, 500) for _ in range(4)]
    plain = Counter(zip(*(c.tolist() for c in columns)))
    for size in (3, 2**20, 2**30):
        got, counts = P._counted(columns, [3, size, size, size])
        assert Counter(dict(zip(zip(*(c.tolist() for c in got)), counts.tolist()))) == plain


def test_memory_of_a_slice():
    """Less than 18 bytes for each character of ordinary words; it once took 25."""
    rng = random.Random(1)
    some = [" ".join(rng.choices([f"w{i}" for i in range(20_000)], k=600)) + ". " for _ in range(600)]
    texts, langs = pa.array(some), pa.array(["en"] * len(some))
    P.text_edges(texts.slice(0, 2), langs.slice(0, 2))
    tracemalloc.start()
    try:
        P.text_edges(texts, langs)
        most = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert most < 18 * sum(map(len, some))


def test_no_rows_in_a_slice():
    assert P.text_edges(pa.array(["", None, " . "]), pa.array(["en", None, "x"])).num_rows == 0


def test_score_is_exact_beyond_64_bits(spark):
    values = [(10**15 - 1, 10**15, 10**15), (123456789012, 987654321098765, 123456789013), (10, 10, 10), (10**12 + 7, 10**12 + 9, 10**12 + 8)]
    frame = spark.createDataFrame(values, "a long, l long, r long").select("*", P._score(F.col("a"), F.col("l"), F.col("r")).alias("s"))
    for r in frame.collect():
        assert r["s"] == 10**6 * r["a"] ** 2 // (r["l"] * r["r"])


def test_one_shuffle_of_the_edges(spark):
    plan = P.flows(P.edges(docs(spark, texts(20, 1))))
    plan.collect()
    text = plan._jdf.queryExecution().executedPlan().toString()
    final = text.split("== Initial Plan ==")[0]
    assert final.count("ReusedExchange") == 2 and final.count("MapInArrow") == 1
