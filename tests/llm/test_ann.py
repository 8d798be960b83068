import random

import numpy as np
import pytest

from intake.llm.ann import Lists, bundled, fit, nearest, nearest_centroids, probes_of, usable
from tests.conftest import SF_DIR

SHAPE = "vec_id long, embedding array<float>, label int"


def slow(rows, every=20, best=20):
    """{(query_id, rank): (vec_id, score)} over all pairs."""
    rows = sorted({(i, tuple(v)) for i, v in rows})
    ids = np.array([i for i, _ in rows])
    x = np.array([v for _, v in rows], np.float32).astype(float)
    out = {}
    for k in np.flatnonzero(ids % every == 0):
        scores = x @ x[k]
        order = [j for j in np.lexsort((ids, -scores)) if ids[j] != ids[k]][:best]
        for rank, j in enumerate(order, 1):
            out[int(ids[k]), rank] = (int(ids[j]), float(scores[j]))
    return out


def answers(df):
    return {(r.query_id, r.rank): (r.vec_id, r.score) for r in df.collect()}


def recall(got, want):
    hits = {}
    for (q, _), (v, _) in want.items():
        hits.setdefault(q, set()).add(v)
    found = sum(v in hits[q] for (q, _), (v, _) in got.items())
    return found / len(want)


def test_whole_table(spark):
    df = spark.read.parquet(f"{SF_DIR}/embeddings.parquet")
    rows = [(r.vec_id, r.embedding) for r in df.collect()]
    got, want = answers(nearest(df)), slow(rows)
    assert got.keys() == want.keys()
    assert recall(got, want) >= 0.95
    exact = dict(rows)
    for (q, _), (v, score) in got.items():
        assert abs(score - float(np.dot(np.float64(exact[q]), np.float64(exact[v])))) < 1e-12


def test_many_lists_of_clustered_vectors_of_any_length(spark):
    rng = np.random.default_rng(1)
    centres = rng.normal(size=(60, 16))
    x = (centres[rng.integers(0, 60, 6000)] + rng.normal(scale=0.4, size=(6000, 16))) * rng.uniform(0.2, 3, (6000, 1))
    rows = [(i, v.astype(np.float32).tolist()) for i, v in enumerate(x)]
    df = spark.createDataFrame([(*r, 0) for r in rows], SHAPE)
    how = Lists(sample=2000, length=20, part=50, bundle=700)
    got, want = answers(nearest(df, how=how)), slow(rows)
    assert got.keys() == want.keys()
    assert recall(got, want) >= 0.9


def test_a_third_of_the_vectors_alike(spark):
    rng = np.random.default_rng(2)
    x = rng.normal(size=(900, 8)).astype(np.float32)
    x[::3] = x[0]
    rows = [(i, v.tolist()) for i, v in enumerate(x)]
    df = spark.createDataFrame([(*r, 0) for r in rows], SHAPE)
    got, want = answers(nearest(df)), slow(rows)
    assert {k: v[0] for k, v in got.items()} == {k: v[0] for k, v in want.items()}


def test_odd_rows(spark):
    good = [(0, [1.0, 0.0]), (1, [0.5, 0.5]), (2, [-1.0, 0.0]), (20, [0.0, 2.0]), (3, [-0.0, 1.0]), (4, [0.0, 1.0]), (4, [0.0, 1.0])]
    bad = [
        (5, None), (6, []), (7, [0.0, 0.0]), (8, [1.0, None]), (9, [float("nan"), 1.0]), (10, [float("inf"), 1.0]),
        (11, [1.0, 2.0, 3.0]), (None, [1.0, 1.0]), (40, [0.0, -0.0]),
    ]
    df = spark.createDataFrame([(*r, 1) for r in good + bad], SHAPE).selectExpr("*", "1 AS list", "2 AS cls", "3 AS score", "4 AS vector")
    assert sorted(r.vec_id for r in usable(df).collect()) == sorted(i for i, _ in good)
    got, want = answers(nearest(df)), slow(good)
    assert got == want
    assert got[0, 1] == (1, 0.5) and got[20, 1] == (3, 2.0) and got[20, 2] == (4, 2.0)


@pytest.mark.parametrize("rows", [[], [(20, [1.0])], [(1, [1.0]), (2, [2.0])], [(20, None)]])
def test_hardly_any_rows(spark, rows):
    df = spark.createDataFrame([(*r, 1) for r in rows], SHAPE)
    assert answers(nearest(df)) == {}


def test_graph_finds_the_nearest_centroids():
    rng = np.random.default_rng(3)
    x = rng.normal(size=(4000, 12)).astype(np.float32)
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    graph = fit(x, 400, Lists())
    found, product = nearest_centroids(x[:200], graph, 64)
    exact = np.argsort(-(x[:200] @ graph.centroids.T), axis=1)[:, :10]
    hits = np.mean([len(set(a[:10]) & set(b)) / 10 for a, b in zip(found, exact, strict=True)])
    assert hits > 0.97
    assert (np.diff(product, axis=1) <= 0).all()


def test_the_ratio_alone_chooses_the_lists():
    rng = np.random.default_rng(4)
    x = rng.normal(size=(4000, 32)).astype(np.float32)
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    graph, x = fit(x[50:], 1000, Lists()), x[:50]
    sizes = np.full(1000, 4)
    far = np.sqrt(np.maximum(2 - 2 * (x @ graph.centroids.T), 0))
    inside = far <= Lists().read_ratio * far.min(axis=1, keepdims=True)
    got = probes_of(x, graph, sizes, 0, Lists())
    assert (inside.sum(axis=1) > 288).any()
    for own, want in zip(got, inside, strict=True):
        if want.sum() > 288:
            assert set(np.flatnonzero(want)) <= set(own) and len(own) <= want.sum() + 1


def test_bundles_of_cut_lists():
    got = bundled([np.array([2, 0]), np.array([], int), np.array([1])], np.array([0, 1, 4, 4, 6]), 2)
    assert [(q, b, list(x)) for q, b, x in got] == [(0, 0, [0]), (2, 0, [1]), (2, 1, [1])]
