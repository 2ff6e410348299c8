"""Operator 4 against brute force."""

import random
from itertools import combinations

import pytest
import xxhash
from pyspark.sql import functions as F

from skewsafe.llm import simhash
from skewsafe.llm.components import connected_components

from .helpers import ODD_TEXTS, docs, no_docs


def brute_fingerprint(text):
    lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words, word = [], ""
    for c in lowered:
        if c in " \t\n\x0b\x0c\r":
            words += [word] if word else []
            word = ""
        else:
            word += c
    words += [word] if word else []
    if not words:
        return 0
    shingles = [" ".join(words[i:i + 3]) for i in range(len(words) - 2)] or [" ".join(words)]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(ids, prints):
    parent = {f: f for f in set(prints)}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in combinations(sorted(parent), 2):
        if (a ^ b).bit_count() <= 3:
            parent[find(b)] = find(a)
    least = {}
    for i, f in zip(ids, prints):
        if i is not None:
            least[find(f)] = min(i, least.get(find(f), i))
    return [least.get(find(f)) for f in prints]


def near_texts(n, seed):
    rnd = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(300)]
    base = [[rnd.choice(vocabulary) for _ in range(rnd.randint(3, 200))] for _ in range(n // 6)]
    out = []
    for _ in range(n):
        words = list(rnd.choice(base))
        for _ in range(rnd.randint(0, 2)):
            words[rnd.randrange(len(words))] = rnd.choice(vocabulary)
        out.append(" ".join(words))
    return out


def test_fingerprints_and_components(spark):
    texts = [*ODD_TEXTS, *near_texts(200, 5), "The CAT sat", "the cat sat"]
    rows = sorted(simhash.near_duplicates(docs(spark, texts)).collect())
    prints = [brute_fingerprint(t) for t in texts]
    assert [r["fingerprint"] for r in rows] == [f"{p:016x}" for p in prints]
    assert [r["component_id"] for r in rows] == brute_components(range(len(texts)), prints)


def test_repeated_and_null_ids(spark):
    df = docs(spark, ["a b c d", "a b c d", "a b c d", "other text here", None], [None, 5, 5, None, 9])
    rows = simhash.near_duplicates(df).collect()
    assert sorted(str(r["component_id"]) for r in rows) == ["5", "5", "5", "9", "None"]
    kept = simhash.deduplicated(df).collect()
    assert sorted((str(r["doc_id"]), r["text"]) for r in kept) == [
        ("5", "a b c d"), ("9", None), ("None", "other text here"),
    ]


def test_one_row_of_each_component_for_shared_and_null_ids(spark):
    texts = near_texts(60, 8)
    prints = [brute_fingerprint(t) for t in texts]
    groups = brute_components(range(60), prints)
    assert len(set(groups)) < len(set(prints))  # near copies with different fingerprints
    # One id in all components, null ids only, and both.
    for ids in ([1] * 60, [None] * 60, [None if i % 3 else i % 2 for i in range(60)]):
        df = docs(spark, texts, ids)
        kept = [r["text"] for r in simhash.deduplicated(df).collect()]
        assert sorted(groups[texts.index(t)] for t in kept) == sorted(set(groups))


def test_empty_table(spark):
    assert simhash.near_duplicates(no_docs(spark)).count() == 0
    assert simhash.deduplicated(no_docs(spark)).count() == 0


@pytest.mark.parametrize("hot", [1, 4, 256])
def test_all_near_pairs_are_found_at_every_level(spark, hot):
    """Dense groups: fingerprints that share halves, quarters and bytes, with few bits flipped."""
    rnd = random.Random(hot)
    prints = set()
    for _ in range(5):
        center = rnd.getrandbits(64)
        for _ in range(60):
            f = center
            for b in rnd.sample(range(64), rnd.randint(0, 5)):
                f ^= 1 << b
            prints.add(f)
        for _ in range(40):  # differences in the last byte only
            prints.add(center ^ rnd.getrandbits(8))
    signed = [f - (1 << 64) if f >> 63 else f for f in prints]
    table = simhash.staged(spark.createDataFrame([(f,) for f in signed], "fp long"), "t")
    found = {(r["a"], r["b"]) for r in simhash.near_pairs(table, hot_entry=hot).distinct().collect()}
    mask = (1 << 64) - 1
    want = {(min(a, b), max(a, b)) for a, b in combinations(signed, 2) if ((a ^ b) & mask).bit_count() <= 3}
    assert found == want


def test_components_of_chains_stars_and_repeats(spark):
    rnd = random.Random(7)
    links = [(i, i + 1) for i in range(100)] + [(1000, 1000 + i) for i in range(200)] + [(5000, 5000), (None, 3)]
    links += [(b, a) for a, b in links[:50]]
    links += [(rnd.randrange(2000, 2400), rnd.randrange(2000, 2400)) for _ in range(250)]
    df = spark.createDataFrame(links, "x long, y long").repartition(7, F.rand(1))
    got = {r["node"]: r["root"] for r in connected_components(df).collect()}
    parent = {}

    def find(x):
        parent.setdefault(x, x)
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in links:
        if a is not None and a != b:
            a, b = find(a), find(b)
            parent[max(a, b)] = min(a, b)
    assert got == {x: find(x) for x in parent}


def test_deduplicated_keeps_columns_and_smallest_id(spark):
    df = docs(spark, ["same words here now", "other text", "same words here now"], [3, 2, 1]).withColumn("_fp", F.lit("x"))
    out = simhash.deduplicated(df)
    assert out.columns == df.columns
    assert sorted((r["doc_id"], r["_fp"]) for r in out.collect()) == [(1, "x"), (2, "x")]
