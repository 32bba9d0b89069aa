"""Selected changepoints against the raw rows: conditions of the minimum, planted knots, refits."""

import itertools

import numpy as np
import pytest
from pyspark.sql import functions as F

from fadecast.plans import battery_models, changepoints, gram

from tests.test_models import battery, measured, split_rows  # noqa: F401

KNOTS = slice(1, 6)


def sample(seed=0, n=400, noise=0.05):
    """A trend that bends at the second and fourth of five knots, a wave and two targets."""
    r = np.random.default_rng(seed)
    t = np.sort(r.uniform(0, 10, n))
    hinges = np.maximum(0, t[:, None] - np.array([1.5, 3.0, 4.5, 6.0, 7.5]))
    x = np.column_stack([t, hinges, np.sin(t * 3), np.full(n, 7.0)])
    y = 2 + 0.5 * t - 1.5 * hinges[:, 1] + 2.0 * hinges[:, 3] + 0.3 * x[:, 6]
    return x, np.column_stack([y + r.normal(0, noise, n), r.normal(0, 1, n)])


def sums(x, y):
    return gram.outer_sums(np.hstack([np.ones((len(x), 1)), x, y]), y)


def objective(x, y, w, lam, ridge, knots=KNOTS):
    """From the rows, in standardised units; constant columns have no part in it."""
    sd, sy = x.std(0), y.std()
    held = np.zeros(x.shape[1], bool)
    held[knots] = True
    s = w[1:] * sd / sy
    error = ((y - w[0] - x @ w[1:]) ** 2).mean() / sy**2
    return error / 2 + ridge / 2 * (s[~held] ** 2).sum() + lam * np.abs(s[held]).sum()


def test_every_model_of_the_path_is_a_minimum():
    x, y = sample()
    r = np.random.default_rng(1)
    for target, fits in enumerate(changepoints.l1_path(sums(x, y), KNOTS, 1e-3)):
        assert [f.penalty_id for f in fits] == list(range(len(changepoints.SHARES)))
        assert fits[0].n_active == 0 and all(f.gap < 1e-9 for f in fits)
        for f in fits:
            assert f.w[-1] == 0  # the constant column
            best = objective(x, y[:, target], f.w, f.penalty, 1e-3)
            for _ in range(60):
                other = f.w + r.normal(0, 10.0 ** r.uniform(-5, 0), len(f.w)) * (r.random(len(f.w)) < 0.5)
                assert objective(x, y[:, target], other, f.penalty, 1e-3) >= best - 1e-9


def finished(Q, c, lam, sign):
    """The minimum if it has these signs, else None."""
    on, out = sign != 0, np.zeros(len(c))
    out[on] = np.linalg.solve(Q[np.ix_(on, on)], c[on] - lam * sign[on])
    same = (np.sign(out) == sign).all() and (np.abs(c - Q @ out)[~on] <= lam + 1e-12).all()
    return out if same else None


def test_descent_equals_a_search_over_all_signs():
    r = np.random.default_rng(4)
    for _ in range(30):
        a = r.normal(0, 1, (12, 4)) @ np.diag([1, 1, 0.3, 2])
        a[:, 3] = a[:, 0] + 0.01 * a[:, 3]  # two that are nearly alike
        Q, c, lam = a.T @ a / 12, r.normal(0, 1, 4), float(r.uniform(0.05, 0.9))
        got = changepoints.descend(Q, c, lam, np.zeros(4))
        best = None
        for signs in itertools.product((-1, 0, 1), repeat=4):
            w = finished(Q, c, lam, np.array(signs, float))
            best = w if w is not None else best
        assert got == pytest.approx(best, abs=1e-9) and changepoints.violation(Q, c, lam, got) < 1e-9


def test_planted_changepoints_are_chosen_and_noise_keeps_none():
    x, y = sample()
    bent, noise = changepoints.l1_path(sums(x, y), KNOTS, 1e-3)
    best = min(bent, key=lambda f: (f.bic, f.penalty_id))
    assert {1, 3} <= set(np.flatnonzero(best.w[1:][KNOTS])) and best.n_active <= 4
    assert min(noise, key=lambda f: (f.bic, f.penalty_id)).n_active == 0


def test_degenerate_histories():
    x, y = sample(n=60)
    y[:, 1] = 3.0  # a constant target
    for f in changepoints.l1_path(sums(x, y), KNOTS, 1e-3)[1]:
        assert f.w[0] == 3.0 and not f.w[1:].any() and f.gap == 0
    for n in (1, 2, 3):  # fewer rows than inputs
        for fits in changepoints.l1_path(sums(x[:n], y[:n]), KNOTS, 1e-3):
            assert all(np.isfinite(f.w).all() and f.gap < 1e-9 for f in fits)
    # Knots behind the history's end, and two that are the same.
    x[:, 3] = x[:, 2]
    x[:, 5] = 0
    for fits in changepoints.l1_path(sums(x, y), KNOTS, 1e-3):
        assert all(f.w[6] == 0 and np.isfinite(f.w).all() and f.gap < 1e-9 for f in fits)


@pytest.mark.parametrize("last", [None, 2])
def test_models_per_cycle_equal_a_fit_from_the_rows(spark, measured, last):  # noqa: F811
    """The toy batteries' knots are nearly alike, so models are compared by what they minimise."""
    targets, knots = battery_models.TARGETS, changepoints.TREND_KNOTS
    rows = changepoints.additive_rows(measured, targets, battery_models.EXOG)
    feats = {r["event_id"]: r["x"] for r in rows.collect()}
    found = {}
    for r in changepoints.models(rows, "x", "y", knots, max_history=last).filter("battery_id = 'B0'").collect():
        found.setdefault((r["cycle"], targets[r["step"] - 1]), []).append(r)
    out = changepoints.additive_changepoints(measured, max_history=last).collect()
    got = {(r["target"], r["event_id"]): r["yhat"] for r in out}
    assert len(out) == len(got) == 2 * len(battery())
    mine, cyc, _, ys = split_rows(battery(), "B0")
    X = np.array([feats[r[0]] for r in mine])
    cycles = sorted(set(cyc))
    for c in cycles:
        at, before = np.flatnonzero(cyc == c), [k for k in cycles if k < c]
        h = np.isin(cyc, before[-last:] if last else before)
        if not before:
            assert all(got[(t, mine[i][0])] is None for t in ys for i in at)
            continue
        paths = changepoints.l1_path(sums(X[h], np.column_stack([ys[t][h] for t in targets])), knots, 1e-3)
        for t, fits in zip(targets, paths):
            emitted = sorted(found[(c, t)], key=lambda r: r["penalty_id"])
            assert [r["n_rows"] for r in emitted] == [h.sum()] * len(fits)
            for r, f in zip(emitted, fits):
                mine_, want = (objective(X[h], ys[t][h], np.array(w), f.penalty, 1e-3, knots) for w in (r["w"], f.w))
                assert mine_ == pytest.approx(want, rel=1e-5, abs=1e-7)
            (w,) = [np.array(r["w"]) for r in emitted if r["chosen"]]
            assert [got[(t, mine[i][0])] for i in at] == pytest.approx(list(w[0] + X[at] @ w[1:]), rel=1e-6)


def test_rows_with_gaps_and_empty_tables(spark, measured):  # noqa: F811
    hole = measured.withColumn("Capacity", F.when(F.col("event_id") % 5 != 0, F.col("Capacity")))
    out = changepoints.additive_changepoints(hole)
    assert out.count() == 2 * len(battery())
    assert out.filter("yhat IS NOT NULL").count() > 0
    assert changepoints.additive_changepoints(measured.filter("false")).count() == 0
