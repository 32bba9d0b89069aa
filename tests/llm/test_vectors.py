"""Clustering and whitening of vectors against plain numpy over the same rows."""

import hashlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from fadecast.llm import vafile, whitening

VECS = "vec_id long, embedding array<float>, label int, _row long, code string, cluster int, n long"


def table(spark, rows):
    return spark.createDataFrame([(i, v, 0, 1, "c", 2, 3) for i, v in rows], VECS)


def noise(n, dims, seed=3):
    rng = np.random.default_rng(seed)
    return [(k, [float(v) for v in rng.normal(0, 0.2, dims)]) for k in range(n)]


ODD = [
    (100, None), (101, []), (102, [1.0, None, 0.5, 0.25]), (103, [1.0, float("nan"), 0.0, 0.0]),
    (104, [float("inf"), 0.0, 0.0, 0.0]), (105, [0.5, 0.5, 0.5]),
    (None, [0.1, 0.2, 0.3, 0.4]), (7, [0.5, 0.5, 0.5, 0.5]), (7, [0.5, 0.5, 0.5, 0.5]), (8, [3e38, -3e38, 0.0, 1.0]),
]


def plain_clusters(rows, dims, k, rounds):
    kept = []
    for key, v in rows:
        if v is None or len(v) != dims or any(e is None or not np.isfinite(e) for e in v):
            continue
        kept.append((key, [max(-(1 << 27), min(1 << 27, int(np.floor(256 * float(np.float32(e)))))) for e in v]))
    name = lambda key: hashlib.sha256(f"2:{key}".encode()).hexdigest()
    order = sorted(kept, key=lambda r: (r[0] is None, name(r[0]), r[1]))
    centroids = [list(v) for _, v in order[:k]]

    def nearest(v):
        d = [sum((a - b) ** 2 for a, b in zip(v, c)) for c in centroids]
        return d.index(min(d)), min(d)

    for _ in range(rounds):
        mine = [nearest(v)[0] for _, v in kept]
        for c in range(len(centroids)):
            own = [v for (_, v), m in zip(kept, mine) if m == c]
            if own:
                centroids[c] = [sum(col) // len(own) for col in zip(*own)]
    found = [(key, *nearest(v)) for key, v in kept]
    total = sum(d for *_, d in found)
    sha = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids]
    per = {c: sum(d for _, m, d in found if m == c) for _, c, _ in found}
    return sorted(((key, c, d, per[c], total, sha[c]) for key, c, d in found), key=str)


@pytest.mark.parametrize("k, rounds", [(3, 4), (40, 2), (5, 1)])
def test_clusters_equal_plain_rounds(spark, k, rounds):
    rows = noise(60, 4) + ODD
    got = vafile.centroid_clusters(table(spark, rows), dims=4, k=k, rounds=rounds)[0]
    assert got.columns == ["vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"]
    assert sorted((tuple(r) for r in got.collect()), key=str) == plain_clusters(rows, 4, k, rounds)


def test_clusters_of_nothing(spark):
    assert vafile.centroid_clusters(table(spark, []), dims=4)[0].collect() == []
    assert vafile.centroid_clusters(table(spark, ODD[:6]), dims=4)[0].collect() == []


def test_fetching_by_join_and_in_place_agree(spark, monkeypatch):
    """Well separated groups leave few vectors open."""
    rng = np.random.default_rng(1)
    rows = [(k, [float(v) for v in rng.normal(k % 3, 0.3, 4)]) for k in range(300)]
    rows += [(300 + k, [0.5 + k / 1000, 0.5, 0.5, 0.5]) for k in range(20)]
    both = []
    for worth in (1, 10**9):
        monkeypatch.setattr(vafile, "WORTH_A_JOIN", worth)
        got, done = vafile.centroid_clusters(table(spark, rows), dims=4, k=6, rounds=6)
        both.append(sorted(map(tuple, got.collect())))
        assert min(done.fetched) < 320
    assert both[0] == both[1] == plain_clusters(rows, 4, 6, 6) or both[0] == both[1] == sorted(plain_clusters(rows, 4, 6, 6))


def test_intervals_hold_the_distance_differences():
    rng = np.random.default_rng(0)
    x = rng.integers(-90, 90, (500, 5))
    lows = np.sort(rng.integers(-90, 90, (5, 8)), axis=1)
    lows[:, 0] = -90
    highs = np.hstack([np.maximum(lows[:, 1:] - 1, lows[:, :-1]), np.full((5, 1), 90)])
    cells = vafile.Cells(lows, np.maximum(highs, lows), 3)
    cell = cells.cells(cells.codes(x))
    for d in range(5):
        assert ((lows[d][cell[:, d]] <= x[:, d]) & (x[:, d] <= cells.highs[d][cell[:, d]])).all()
    centroids = rng.integers(-50, 50, (7, 5))
    may = vafile.Intervals(cells, centroids).open(cell)
    best = vafile.distances(x, centroids)
    assert may[best == best.min(axis=1, keepdims=True)].all()


def plain_whitening(rows, dims, k=4):
    """Exact integers first, then numpy's eigenvectors."""
    kept = []
    for key, v in rows:
        if v is None or len(v) != dims or any(e is None or not np.isfinite(e) for e in v):
            continue
        kept.append((key, tuple(max(-(1 << 27), min(1 << 27, int(np.floor(256 * float(np.float32(e)))))) for e in v)))
    fit = sorted({v for _, v in kept})
    n, sums = len(fit), [sum(c) for c in zip(*fit)]
    x = np.array(fit, float) - np.array(sums) / n
    cov = x.T @ x / n
    values, vectors = np.linalg.eigh(cov)
    values, vectors = values[::-1], vectors[:, ::-1]
    out = []
    for key, v in kept:
        deviation = sum((n * a - s) ** 2 for a, s in zip(v, sums))
        p = (np.array(v) - np.array(sums) / n) @ vectors
        for c in range(min(k, dims)):
            known = values[c] > 1e-12 * np.trace(cov)
            out.append((key, c + 1, n, deviation if deviation < 1 << 63 else None,
                        abs(p[c]) / np.sqrt(values[c]) if known else None, values[c] / np.trace(cov) if known else 0.0))
    return sorted(out, key=str)


def rounded(rows):
    return sorted(
        ((r[0], r[1], r[2], r[3], None if r[4] is None else round(abs(r[4]), 6), round(r[5], 9)) for r in rows), key=str
    )


@pytest.mark.parametrize(
    "rows, dims",
    [
        (noise(300, 6) + [(500 + k, v) for k, v in noise(300, 6)], 6),  # every vector twice
        ([(k, [float(k % 5), float(k % 7), 1.0, 2.0]) for k in range(100)], 4),  # flat dimensions
        ([(k, [k * 0.25, 0.5]) for k in range(9)], 2),
    ],
)
def test_whitening_equals_numpy(spark, rows, dims):
    got = whitening.whiten(table(spark, rows).repartition(7)).collect()
    assert rounded(got) == rounded(plain_whitening(rows, dims))
    assert {r.identity_error <= 1e-9 for r in got} == {True}


def test_whitening_signs_are_the_same_for_all_rows(spark):
    rows = noise(200, 5, seed=9)
    got = whitening.whiten(table(spark, rows))
    each = {(r.vec_id, r.component): r.whitened for r in got.collect()}
    w = np.array([[each[k, c] for c in range(1, 5)] for k, _ in rows])
    assert np.abs(w.T @ w / len(w) - np.eye(4)).max() < 1e-9


def test_whitening_of_odd_rows(spark):
    assert whitening.whiten(table(spark, [])).collect() == []
    assert whitening.whiten(table(spark, [(1, None), (2, []), (3, [float("nan")])])).collect() == []
    got = whitening.whiten(table(spark, [(1, [0.5, 0.25]), (1, [0.5, 0.25]), (2, [1.0])])).collect()
    assert sorted(map(tuple, got)) == sorted([(1, c, 1, 0, None, 0.0, 0.0) for c in (1, 1, 2, 2)])
    huge = whitening.whiten(table(spark, [(1, [3e38, 0.0]), (2, [-3e38, 0.0]), (None, [0.0, 1.0])])).collect()
    assert len(huge) == 6 and {r.vec_id for r in huge} == {1, 2, None}


def test_rank_one_updates_and_joins_rebuild_the_scatter():
    rng = np.random.default_rng(0)
    for x in (rng.normal(0, 30, (80, 12)), rng.integers(0, 2, (60, 7)).astype(float), np.repeat(rng.normal(0, 1, (5, 9)), 4, axis=0)):
        dims = x.shape[1]
        scatter = (x - x.mean(0)).T @ (x - x.mean(0))
        whole, left, right = (whitening.Spectrum.empty(dims) for _ in range(3))
        for i, v in enumerate(x):
            whole.add(v)
            (left if i % 3 else right).add(v)
        left.join(right)
        for s in (whole, left):
            assert np.abs(s.q.T @ s.q - np.eye(dims)).max() < 1e-12
            assert np.abs(s.q @ np.diag(s.lam) @ s.q.T - scatter).max() < 1e-12 * max(1.0, np.abs(scatter).max())
