"""Whitening and clustering against dense linear algebra and plain comparison of all centroids."""

from __future__ import annotations

import hashlib
import math

import numpy as np
import pytest

from windrow.llm import clustering, whitening

SCHEMA = "vec_id bigint, embedding array<float>, label int, component string, q int, own int"


def table(spark, vectors, parts=3, ids=None):
    rows = [(i if ids is None else ids[i], v, 1, "c", 2, 3) for i, v in enumerate(vectors)]
    return spark.createDataFrame(rows, SCHEMA).repartition(parts)


def odd_vectors(rng, n=300, d=64):
    base = rng.normal(0, 0.2, (n, d)) * np.linspace(2, 0.05, d) @ np.linalg.qr(
        rng.normal(size=(d, d)))[0]
    vectors = [[float(np.float32(x)) for x in row] for row in base]
    holed = list(vectors[0])
    holed[3] = None
    return vectors + [vectors[5], vectors[5], None, [], holed, [math.nan] + vectors[1][1:],
                      [math.inf] + vectors[1][1:], [1.0, 2.0], [0.0] * d, [1e30] + vectors[1][1:]]


def usable(vectors, d=64):
    return [i for i, v in enumerate(vectors) if v is not None and len(v) == d and all(
        x is not None and math.isfinite(x) and abs(x) < 1e29 for x in v)]


def test_whitening(spark):
    vectors = odd_vectors(np.random.default_rng(1))
    at = usable(vectors)
    x = np.array([[math.floor(64 * c) + 1_000_000 for c in vectors[i]] for i in at], object)
    n, sums = len(at), x.sum(0)
    exact = {i: int(((n * row - sums) ** 2).sum()) for i, row in zip(at, x)}
    centred = (n * x - sums).astype(float) / n
    values, axes = np.linalg.eigh(centred.T @ centred / n)
    values, axes = values[::-1], axes[:, ::-1]

    df = whitening.whiten(table(spark, vectors))
    got = df.collect()
    assert df.columns == ["id", "component", "n", "deviation", "whitened", "explained",
                          "identity_error"]
    assert len(got) == 32 * n and {r["id"] for r in got} == set(at)
    assert all(r["n"] == n and r["deviation"] == exact[r["id"]] for r in got)
    error = {r["identity_error"] for r in got}
    assert len(error) == 1 and error.pop() < 1e-9
    made = np.zeros((len(vectors), 32))
    for r in got:
        made[r["id"], r["component"] - 1] = r["whitened"]
        share = values[r["component"] - 1] / values.sum()
        assert abs(r["explained"] - share) < 1e-9 * share
    want = centred @ axes[:, :32] / np.sqrt(values[:32])
    for k in range(32):
        sign = np.sign((made[at, k] * want[:, k]).sum())
        assert np.abs(made[at, k] - sign * want[:, k]).max() < 1e-7
    # the fit does not depend on how rows are dealt to tasks
    again = whitening.fit(table(spark, vectors[::-1], parts=7))
    once = whitening.fit(table(spark, vectors, parts=1))
    assert again.sums == once.sums and (again.components == once.components).all()


def test_whitening_without_spread_or_rows(spark):
    none = spark.createDataFrame([], SCHEMA)
    assert whitening.whiten(none).count() == 0
    assert whitening.whiten(table(spark, [[1.0, 2.0]] * 5)).count() == 0
    assert whitening.whiten(table(spark, [None, [], [math.nan]])).count() == 0
    # rank one: as many components as that; the commonest length is fitted, of ties the longest
    line = [[float(i), float(2 * i)] for i in range(8)] + [[1.0]] * 8
    got = whitening.whiten(table(spark, line, ids=[None] * 16)).collect()
    assert len(got) == 8 and {r["component"] for r in got} == {1}
    assert all(r["id"] is None and abs(r["explained"] - 1) < 1e-12 for r in got)


def test_whitening_of_wide_integers(spark):
    """Entries of very different size go through the limbs, and deviations beyond 64 bits are null."""
    rng = np.random.default_rng(4)
    vectors = (rng.normal(size=(50, 6)) * [1e-1, 1, 1e3, 1e5, 1e7, 1e9]).astype(np.float32).tolist()
    made = whitening.fit(table(spark, vectors))
    x = np.array([[math.floor(64 * c) + 1_000_000 for c in v] for v in vectors], object)
    centred = 50 * x - x.sum(0)
    want = np.array([[int(v) / 2500 / 50 for v in row] for row in centred.T @ centred])
    assert made.sums == x.sum(0).tolist()
    assert abs(made.trace - np.trace(want)) < 1e-12 * np.trace(want)
    assert np.abs(want @ made.components - made.components * made.values).max() < 1e-9 * made.trace
    deviation = {r["id"]: r["deviation"] for r in whitening.whiten(table(spark, vectors)).collect()}
    for i, row in enumerate(centred):
        exact = int((row ** 2).sum())
        assert deviation[i] == (exact if exact < 1 << 63 else None)


@pytest.mark.parametrize("n, rank", [(1, 1), (2, 2), (7, 4), (30, 30)])
def test_cholesky_and_jacobi(n, rank):
    rng = np.random.default_rng(n)
    root = rng.normal(size=(n, rank)) * 10.0 ** rng.integers(-3, 3, rank)
    a = root @ root.T
    factor, order = whitening.pivoted_cholesky(a)
    assert factor.shape == (n, rank) and np.abs(np.triu(factor, 1)).max(initial=0) == 0
    assert np.allclose(factor @ factor.T, a[np.ix_(order, order)], rtol=1e-9, atol=1e-12 * a.max())
    values, axes = whitening.one_sided_jacobi(factor)
    assert np.allclose(values, np.linalg.eigvalsh(a)[::-1][:rank], rtol=1e-6, atol=1e-13 * a.max())
    assert np.abs(axes.T @ axes - np.eye(rank)).max() < 1e-12
    assert (np.diff(values) <= 0).all()


def test_every_two_columns_meet_once():
    for n in (2, 3, 8, 9):
        met = [(int(a), int(b)) for p, q in whitening._meetings(n) for a, b in zip(p, q)]
        assert sorted(met) == [(a, b) for a in range(n) for b in range(a + 1, n)]


def plain_clusters(vectors, ids, clusters, rounds):
    """Compare every vector with every centroid, in Python integers."""
    at = usable(vectors)
    q = [[math.floor(256 * c) for c in vectors[i]] for i in at]
    first = sorted(range(len(at)), key=lambda i: (
        hashlib.sha256(f"2:{ids[at[i]]}".encode()).hexdigest(), q[i]))
    centroids = [q[i] for i in first[:clusters]]

    def assign():
        return [min((sum((a - b) ** 2 for a, b in zip(v, c)), k) for k, c in enumerate(centroids))
                for v in q]
    for _ in range(rounds):
        where = assign()
        for k in range(len(centroids)):
            rows = [v for v, (_, own) in zip(q, where) if own == k]
            if rows:
                centroids[k] = [sum(col) // len(rows) for col in zip(*rows)]
    where = assign()
    names = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids]
    whole = sum(d for d, _ in where)
    return sorted((ids[i], k, d, sum(x for x, own in where if own == k), whole, names[k])
                  for i, (d, k) in zip(at, where))


@pytest.mark.parametrize("kind", ["clouds", "grid", "few"])
def test_clustering(spark, kind):
    rng = np.random.default_rng(5)
    if kind == "clouds":
        vectors = odd_vectors(rng, 250)
    elif kind == "grid":      # few different values: many ties and equal starting centroids
        vectors = (rng.integers(0, 2, (300, 64)) * (np.arange(64) < 3)).astype(float).tolist()
    else:
        vectors = odd_vectors(rng, 6) * 2
    ids = [7 * i % 1000 for i in range(len(vectors))]
    df = clustering.cluster(table(spark, vectors, ids=ids))
    assert df.columns == ["id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"]
    assert sorted(map(tuple, df.collect())) == plain_clusters(vectors, ids, 40, 5)


def test_clustering_of_nothing_and_null_ids(spark):
    assert clustering.cluster(spark.createDataFrame([], SCHEMA)).count() == 0
    got = clustering.cluster(table(spark, [[0.5] * 64] * 3, ids=[None, None, 4])).collect()
    assert [(r["cluster"], r["distance"], r["inertia"]) for r in got] == [(0, 0, 0)] * 3


def test_search_needs_few_distances():
    """Bounds and the shrinking ball spare most comparisons, and never change the nearest."""
    rng = np.random.default_rng(6)
    middles = rng.integers(-4000, 4000, (40, 8))
    x = (middles[rng.integers(0, 40, 4000)] + rng.integers(-300, 300, (4000, 8))).astype(np.int64)
    rows = x[:40].tolist()
    own, second = np.zeros(4000, np.int64), np.ones(4000, np.int64)
    upper, lower, before, spent = np.full(4000, np.inf), np.zeros(4000), None, []
    for _ in range(6):
        spent.append(clustering.search(x, own, second, upper, lower,
                                       clustering.Centroids(rows, before)))
        every = ((x[:, None, :] - np.array(rows)[None]) ** 2).sum(2)
        assert (own == every.argmin(1)).all()
        chosen = np.sqrt(every[np.arange(4000), own])
        every[np.arange(4000), own] = 1 << 60
        assert (upper >= chosen * (1 - 1e-9)).all()
        assert (lower <= np.sqrt(every.min(1)) * (1 + 1e-9)).all()
        before, rows = rows, [(x[own == k].sum(0) // max(1, (own == k).sum())).tolist()
                              if (own == k).any() else rows[k] for k in range(40)]
    # the first round has no bounds yet: only the ball spares it some
    assert spent[0] < 40 * 4000 and spent[-1] < 0.1 * 40 * 4000
