"""NNLS packing: ids against the library, gapless windows, plan invariants at every size."""

import itertools
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from skewsafe.llm import nnls_packing as P
from skewsafe.llm.common import table
from skewsafe.llm.word_tokens import text_ids
from tests.conftest import SF_SMALL
from tests.llm.helpers import ODD_TEXTS, docs, no_docs

PATH = public_tokenizers.path("word_bpe_49k.json")


def library_ids(texts):
    found = Tokenizer.from_file(PATH).encode_batch([t or "" for t in texts], add_special_tokens=False)
    return [np.array([*e.ids, 1], "<u4") for e in found]


WORDS = ["Éa.", "éa,", "J̌x", "ǰx", "É×a.", "ÀÉ÷", "don't", "DON'T.", "A.", ".", ",,", "a.b.", "x9,", "ß.", "ÿŸ.", "<|endoftext|>",
         "é" * 40 + ".", "́a", "Ã̧.", "\xad.", "ö\xad.", "\xa0a", "a b", "İI", "ſ.", "ﬁ.", "中.", "K."]


def test_ids_equal_the_library():
    texts = [*ODD_TEXTS, " ".join(WORDS), "\n".join(WORDS), *WORDS, " ".join(a + b for a, b in itertools.product(WORDS, WORDS))]
    got = []
    for _, ids, at in text_ids(pa.array(texts), PATH):
        got += [np.append(ids[at[i]:at[i + 1]], np.uint32(1)) for i in range(len(at) - 1)]
    for text, a, b in zip(texts, got, library_ids(texts), strict=True):
        assert a.tolist() == b.tolist(), text


def check(rows, expected):
    """``rows``: of the operator; ``expected``: doc_id -> list of id arrays of its rows."""
    of_doc, of_sequence = defaultdict(list), defaultdict(list)
    for r in rows:
        of_doc[r["doc_id"]].append(r)
        of_sequence[r["sequence_id"]].append((r["offset"], r["length"]))
    assert set(of_doc) == set(expected)
    for doc, parts in of_doc.items():
        [ids] = {a.tobytes(): a for a in expected[doc]}.values()
        copies = len(expected[doc])
        starts = defaultdict(int)
        for r in parts:
            assert r["doc_tokens"] == len(ids)
            assert r["ids_crc32"] == zlib.crc32(ids[r["start"]:r["start"] + r["length"]].tobytes())
            starts[r["start"]] += 1
            starts[r["start"] + r["length"]] -= 1
        # Every id of every copy is in exactly one part.
        assert np.cumsum([starts[i] for i in range(len(ids) + 1)]).tolist() == [copies] * len(ids) + [0]
    sizes = []
    for parts in of_sequence.values():
        end = 0
        for offset, length in sorted(parts):
            assert offset == end and length > 0
            end += length
        sizes.append(end)
    partial = [s for s in sizes if s != P.WINDOW]
    assert len(set(partial)) == len(partial) and all(s & (s - 1) == 0 and s < P.WINDOW for s in partial)


def test_whole_small_table(spark):
    source = table(spark, SF_SMALL, "documents")
    rows = P.pack_documents(source, PATH).collect()
    texts = source.select("doc_id", "text").collect()
    expected = defaultdict(list)
    for r, ids in zip(texts, library_ids([r["text"] for r in texts])):
        expected[r["doc_id"]].append(ids)
    check(rows, expected)


def test_odd_texts_repeats_and_clashing_columns(spark):
    texts = [*ODD_TEXTS, *["the same text again " * 9] * 40, "cut me up " * 5_000]
    rows = docs(spark, texts).selectExpr("*", "doc_id AS sequence_id", "'x' AS ids", "1 AS uid", "2 AS length", "3 AS rank")
    expected = {i: [ids] for i, ids in enumerate(library_ids(texts))}
    check(P.pack_documents(rows, PATH).collect(), expected)
    repeated = docs(spark, ["a b c d e"] * 3000, [7] * 3000)
    check(P.pack_documents(repeated, PATH).collect(), {7: library_ids(["a b c d e"] * 3000)})
    check(P.pack_documents(docs(spark, ["null id", None], [None, None]).limit(1), PATH).collect(), {None: library_ids(["null id"])})
    assert P.pack_documents(no_docs(spark), PATH).count() == 0


def test_sequences_hold_the_ids(spark):
    source = docs(spark, ["one two three " * n for n in range(1, 400, 7)])
    packed = P.pack_documents(source, PATH, window=256)
    ids = {r["doc_id"]: a for r, a in zip(source.collect(), library_ids([r["text"] for r in source.collect()]))}
    found = {r["sequence_id"]: r["ids"] for r in P.sequences(source, packed, PATH).collect()}
    for r in packed.collect():
        assert found[r["sequence_id"]][r["offset"]:r["offset"] + r["length"]] == ids[r["doc_id"]][r["start"]:r["start"] + r["length"]].tolist()


def test_combinations_by_brute_force():
    lengths = np.array([1, 2, 3, 5, 8, 11])
    index, times = P.combinations(lengths, 16, depth=6)
    got = {tuple(sorted(x for i, n in zip(a, b) for x in [int(lengths[i])] * n)) for a, b in zip(index, times)}
    assert len(got) == len(index)
    every = {c for n in range(1, 7) for c in itertools.combinations_with_replacement([int(x) for x in lengths], n) if sum(c) == 16}
    assert got == {c for c in every if len(set(c)) <= 2 or (len(c) == 3 and len(set(c)) == 3)}


def test_program_reaches_a_least_squares_optimum():
    rng = np.random.default_rng(3)
    lengths = np.arange(1, 64)
    demand = rng.integers(1000, 9000, 63).astype(float)
    index, times = P.combinations(lengths, 64, depth=4)
    x = P.solve(index, times, demand, gap=1e-4)
    a = np.zeros((63, len(index)))
    for k in range(3):
        np.add.at(a, (index[:, k], np.arange(len(index))), times[:, k])
    gradient = a.T @ (demand - a @ x) / (times**2).sum(axis=1)
    assert (x >= 0).all() and gradient.max() < 1 and np.abs(gradient[x > 1]).max() < 1


@pytest.mark.parametrize("scale", [1, 50, 10**7])
def test_plan_at_every_size(scale):
    """Everything is placed once, without padding, and the plan does not grow with the pieces."""
    rng = np.random.default_rng(5)
    sizes = np.minimum(rng.lognormal(4, 0.8, 3000).astype(int) + 1, 256)
    histogram = {int(k): int(n) * scale for k, n in zip(*np.unique(sizes, return_counts=True))}
    placed = P.plan(histogram, window=256)
    total = sum(k * n for k, n in histogram.items())
    assert sum(r[2] * r[4] for r in placed) == total and len(placed) < 6000
    uncut = sum(r[2] for r in placed if r[3] == 0 and r[4] == r[0])
    assert uncut > 0.85 * sum(histogram.values())
    assert max(r[7] + -(-(r[5] + r[2]) // r[6]) for r in placed) == total // 256 + (total % 256).bit_count()


def test_one_length_is_cut_without_padding():
    placed = P.plan({1500: 10**9})
    assert sum(r[2] * r[4] for r in placed) == 1500 * 10**9 and len(placed) < 100
    tables = P.lookup_tables(placed)
    count, start, size, sequence, offset = P.parts_of(tables, np.full(1000, 1500), np.arange(10**9 - 1000, 10**9))
    assert (np.add.reduceat(size, np.cumsum(count) - count) == 1500).all()
