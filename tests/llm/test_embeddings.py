"""Operator 6 against brute force."""

import numpy as np
import pytest

from skewsafe.llm import embeddings
from skewsafe.llm.common import ship_code

SCHEMA = "vec_id long, embedding array<float>, label int"


def table(spark, rows):
    ship_code(spark)
    return spark.createDataFrame([(i, None if v is None else [None if x is None else float(x) for x in v], 0) for i, v in rows], SCHEMA)


def brute(rows):
    ids, vectors = [i for i, _ in rows], np.array([np.float32(v) for _, v in rows], dtype=np.float64)
    unit = vectors / np.linalg.norm(vectors, axis=1, keepdims=True)
    linked = unit @ unit.T >= 0.9
    np.fill_diagonal(linked, False)
    label = np.arange(len(ids))
    for _ in range(len(ids)):
        new = np.array([min([label[i], *label[linked[i]]]) for i in range(len(ids))])
        if (new == label).all():
            break
        label = new
    return {i: (int(linked[k].sum()), ids[label[k]]) for k, i in enumerate(ids)}


def around(rng, center, cosine, n):
    noise = rng.normal(size=(n, len(center)))
    noise -= np.outer(noise @ center, center)
    noise /= np.linalg.norm(noise, axis=1, keepdims=True)
    return cosine * center + np.sqrt(1 - cosine**2) * noise


def planted(seed, n=1500, dim=64):
    """Background, pairs from 0.88 to 1, a tight hot group, exact copies."""
    rng = np.random.default_rng(seed)
    vectors = rng.normal(size=(n, dim))
    vectors /= np.linalg.norm(vectors, axis=1, keepdims=True)
    pairs = [around(rng, vectors[i], c, 1)[0] for i, c in enumerate(rng.uniform(0.88, 1, 400))]
    tight = around(rng, vectors[500], 0.995, 500)
    wide = around(rng, vectors[501], 0.95, 60)
    copies = np.repeat(vectors[502:503], 200, axis=0)
    return np.concatenate([vectors, pairs, tight, wide, copies]) * rng.uniform(0.1, 9, (n + 400 + 500 + 60 + 200, 1))


def test_links_components_and_recall(spark):
    vectors = planted(1)
    rows = list(enumerate(vectors))
    want = brute(rows)
    got = {r["vec_id"]: r for r in embeddings.near_duplicates(table(spark, rows)).collect()}
    assert len(got) == len(rows)
    assert all(got[i]["n_links"] <= n for i, (n, _) in want.items())  # none below the threshold
    assert sum(r["n_links"] for r in got.values()) >= 0.99 * sum(n for n, _ in want.values())
    assert np.mean([got[i]["n_links"] == n for i, (n, _) in want.items()]) >= 0.95
    assert np.mean([got[i]["component_id"] == c for i, (_, c) in want.items()]) >= 0.95
    assert all(r["kept"] == (r["vec_id"] == r["component_id"]) for r in got.values())


def test_recall_at_the_threshold_with_many_cells():
    """Pairs at cosine 0.9 exactly: the probes find at least nine of ten."""
    rng = np.random.default_rng(2)
    points = rng.normal(size=(20_000, 64))
    points /= np.linalg.norm(points, axis=1, keepdims=True)
    centres, hubs = embeddings.fit_index(points[:4096], 60_000)
    partner = np.concatenate([around(rng, p, 0.9, 1) for p in points[:3000]])
    home_a, _, probes_a = embeddings.assign(points[:3000], centres, hubs)
    home_b, _, probes_b = embeddings.assign(partner, centres, hubs)
    met = (probes_a == home_b[:, None]).any(axis=1) | (probes_b == home_a[:, None]).any(axis=1)
    assert len(centres) - hubs > 200 and met.mean() >= 0.9


def test_a_wide_group_over_many_cells_is_searched_whole(spark, monkeypatch):
    """A third of all vectors at cosine 0.95 to a centre, in far more cells than probes: no hub, most pairs linked."""
    monkeypatch.setattr(embeddings, "PER_CELL", 10)
    rng = np.random.default_rng(6)
    points = rng.normal(size=(2400, 64))
    points /= np.linalg.norm(points, axis=1, keepdims=True)
    vectors = np.concatenate([points[:1600], around(rng, points[0], 0.95, 800)]).astype(np.float32).astype(float)
    unit = vectors / np.linalg.norm(vectors, axis=1, keepdims=True)
    centres, hubs = embeddings.fit_index(unit, len(unit))
    home = embeddings.assign(unit, centres, hubs)[0]
    assert not hubs and len(set(home[1600:])) > 3 * embeddings.PROBES
    want = (unit @ unit.T >= 0.9).sum(axis=1) - 1
    got = {r["vec_id"]: r["n_links"] for r in embeddings.near_duplicates(table(spark, list(enumerate(vectors)))).collect()}
    assert want.sum() > 200_000
    assert all(got[i] <= n for i, n in enumerate(want))
    assert sum(got.values()) >= 0.99 * want.sum()


def test_estimates_are_unbiased_and_bounded():
    rng = np.random.default_rng(3)
    x, q = rng.normal(size=(2, 4000, 64))
    x, q = x / np.linalg.norm(x, axis=1, keepdims=True), q / np.linalg.norm(q, axis=1, keepdims=True)
    rotated = embeddings.rotation(64)
    packed, factors = embeddings.codes(x @ rotated.T)
    about, width = embeddings.estimates((q[:200] @ rotated.T).astype(np.float32), packed, factors)
    error = about - q[:200] @ x.T
    assert abs(error.mean()) < 0.002
    assert (np.abs(error) <= width).mean() > 0.997


def test_blocks_do_not_change_the_result(spark, monkeypatch):
    vectors = planted(4, 600)
    rows = list(enumerate(vectors))
    whole = sorted(embeddings.near_duplicates(table(spark, rows)).collect())
    monkeypatch.setattr(embeddings, "BLOCK", 100)
    assert sorted(embeddings.near_duplicates(table(spark, rows)).collect()) == whole


def test_odd_vectors(spark):
    rows = [(0, None), (1, []), (2, [0, 0]), (3, [1, None]), (4, [1, float("nan")]), (5, [float("inf"), 1]),
            (6, [1, 0]), (7, [2, 0]), (7, [2, 0]), (8, [1, 0, 0]), (None, [1, 0]), (9, [-1, 0]), (10, [0, 0])]
    got = sorted((str(r["vec_id"]), r["n_links"], str(r["component_id"]), r["kept"]) for r in
                 embeddings.near_duplicates(table(spark, rows).withColumnRenamed("label", "n_links")).collect())
    alone = [(str(i), 0, str(i), True) for i in (0, 1, 2, 3, 4, 5, 8, 9, 10)]
    assert got == sorted([*alone, ("6", 3, "6", True), ("7", 3, "6", False), ("7", 3, "6", False), ("None", 3, "6", False)])


@pytest.mark.parametrize("rows", [[], [(1, None), (None, [0.0])]])
def test_nothing_to_compare(spark, rows):
    got = embeddings.near_duplicates(table(spark, rows)).collect()
    assert [(r["n_links"], r["component_id"], r["kept"]) for r in got] == [(0, i, i is not None) for i, _ in rows]
