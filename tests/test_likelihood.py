"""Likelihood models per cycle against the covariance matrix of the raw rows."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from fadecast.plans import battery_models, likelihood

from tests.test_models import battery, measured, split_rows  # noqa: F401


def covariance(n, phi, theta):
    """Of n errors of order (1, 1) with unit innovations."""
    gamma = np.empty(n)
    gamma[0] = (1 + 2 * phi * theta + theta**2) / (1 - phi**2)
    if n > 1:
        gamma[1] = phi * gamma[0] + theta
        for h in range(2, n):
            gamma[h] = phi * gamma[h - 1]
    return gamma[np.abs(np.subtract.outer(np.arange(n), np.arange(n)))]


def direct(dy, dx, phi, theta):
    """Twice the negative log likelihood, beta and the error one step ahead, by matrices."""
    n = len(dy)
    V = covariance(n + 1, phi, theta)
    inv = np.linalg.inv(V[:n, :n])
    beta = np.linalg.lstsq(dx.T @ inv @ dx, dx.T @ inv @ dy, rcond=None)[0] if dx.shape[1] else np.zeros(0)
    e = dy - dx @ beta
    q = e @ inv @ e
    value = n * np.log(2 * np.pi * q / n) + n + np.linalg.slogdet(V[:n, :n])[1]
    return value, beta, V[n, :n] @ inv @ e


def series(seed, n=200, phi=0.6, theta=0.5):
    r = np.random.default_rng(seed)
    e = r.normal(0, 1, n)
    error = np.zeros(n)
    for t in range(n):
        error[t] = e[t] + (phi * error[t - 1] + theta * e[t - 1] if t else 0)
    x = np.cumsum(r.normal(0, 1, (n, 2)), axis=0)
    y = 5 + np.cumsum(error) + x @ [2.0, -1.0]
    return y, x


def profile(y, x, thetas):
    levels = np.column_stack([y, x])
    z = likelihood.filtered(np.vstack([np.zeros((1, levels.shape[1])), np.diff(levels, axis=0)]), thetas)
    at = np.arange(1, len(y))
    b = np.power(-thetas[:, None], at - 1.0)
    d = np.concatenate([z[:, 1:], z[:, :-1], b[:, :, None]], axis=2)
    s = d.transpose(0, 2, 1) @ d
    return likelihood.Profile(s.transpose(1, 0, 2).reshape(s.shape[1], -1), thetas, 0, 1)


def test_filter_equals_the_recursion():
    x = np.random.default_rng(0).normal(0, 1, (3000, 2))
    thetas = likelihood.chebyshev(7)
    got = likelihood.filtered(x, thetas)
    z = np.zeros((7, 2))
    for t in range(len(x)):
        z = x[t] - thetas[:, None] * z
        assert np.allclose(got[:, t], z, atol=1e-10)


@pytest.mark.parametrize("phi, theta", [(0.6, 0.5), (-0.7, 0.2), (0.95, -0.9), (0.0, 0.97), (0.3, -0.97), (0.4, -0.4)])
@pytest.mark.parametrize("n", [14, 200])
def test_sums_give_the_exact_likelihood(phi, theta, n):
    y, x = series(1, n)
    value, beta, _ = direct(np.diff(y), np.diff(x, axis=0), phi, theta)
    got = profile(y, x, likelihood.chebyshev()).at(np.array([phi]), np.array([theta]), n - 1)
    assert got[0][0] == pytest.approx(value, rel=1e-6, abs=1e-5) and got[1][0] == pytest.approx(beta, rel=1e-4, abs=1e-5)


def test_search_finds_the_largest_likelihood():
    for seed in range(6):
        y, x = series(seed, 250, *[(0.6, 0.5), (-0.5, 0.9), (0.0, -0.6)][seed % 3])
        p, n = profile(y, x, likelihood.chebyshev()), len(y) - 1
        phi, theta = p.best(n)
        best = direct(np.diff(y), np.diff(x, axis=0), phi, theta)[0]
        assert best <= p.at(*[np.array([v]) for v in p.start(n)], n)[0][0] + 1e-6
        r = np.random.default_rng(seed)
        for _ in range(300):
            near = np.clip(np.array([phi, theta]) + r.normal(0, 10.0 ** r.uniform(-3, 0), 2), -0.98, 0.98)
            assert direct(np.diff(y), np.diff(x, axis=0), *near)[0] >= best - 1e-5


def test_planted_coefficients_are_found():
    y, x = series(3, 4000)
    p = profile(y, x, likelihood.chebyshev())
    phi, theta = p.best(3999)
    beta = p.at(np.array([phi]), np.array([theta]), 3999)[1][0]
    assert abs(phi - 0.6) < 0.05 and abs(theta - 0.5) < 0.05 and beta == pytest.approx([2, -1], abs=0.05)


@pytest.mark.parametrize("size", [7, 4096])
def test_models_per_cycle_equal_a_fit_from_the_rows(spark, measured, size):  # noqa: F811
    rows, compared = battery(), 0
    got = {(r["battery_id"], r["target"], r["cycle"]): r for r in likelihood.models(measured, size=size).collect()}
    for b in ("B0", "B1"):
        mine, cyc, x, ys = split_rows(rows, b)
        for c in np.unique(cyc):
            past = cyc < c
            n = int(past.sum()) - 1
            for t, y in ys.items():
                if n < likelihood.LEAST:
                    assert (b, t, c) not in got
                    continue
                r = got[(b, t, int(c))]
                assert r["n"] == n and r["loglik"] >= r["start_loglik"] - 1e-9
                assert r["y_last"] == y[past][-1] and r["x_last"] == list(x[past][-1])
                assert r["sigma2"] > 0 and np.isfinite(r["loglik"])
                if r["sigma2"] < 1e-10 * np.var(np.diff(y[past])) or np.ptp(y[past]) == 0:
                    continue  # explained without an error: the variance has a floor
                compared += 1
                value, beta, ahead = direct(np.diff(y[past]), np.diff(x[past], axis=0), r["phi"], r["theta"])
                assert -2 * r["loglik"] == pytest.approx(value, rel=1e-4, abs=1e-2)
                assert r["n_next"] == pytest.approx(ahead, rel=1e-3, abs=1e-4)
    assert compared > 5


def test_forecasts_follow_the_model_and_name_what_is_missing(spark, measured):  # noqa: F811
    hole = measured.withColumn("Voltage_measured", F.when(F.col("event_id") % 11 != 3, F.col("Voltage_measured")))
    out = likelihood.arimax_likelihood(hole).collect()
    assert len(out) == 2 * measured.count()
    at = {(r["battery_id"], r["target"], r["cycle"]): r for r in likelihood.models(hole).collect()}
    x = {r["event_id"]: [r[c] for c in battery_models.EXOG] for r in hole.collect()}
    for r in out:
        m = at.get((r["battery_id"], r["target"], r["cycle"]))
        if r["event_id"] % 11 == 3:
            assert (r["yhat"], r["step"], r["reason"]) == (None, None, "missing")
        elif m is None:
            assert r["yhat"] is None and r["reason"] == "history"
        else:
            level, d = m["y_last"], m["n_next"]
            for _ in range(r["step"]):
                level, d = level + d, d * m["phi"]
            level += np.dot(m["beta"], np.subtract(x[r["event_id"]], m["x_last"]))
            assert r["reason"] is None and r["yhat"] == pytest.approx(level, rel=1e-9)


def test_empty_table(spark, measured):  # noqa: F811
    assert likelihood.arimax_likelihood(measured.filter("false")).count() == 0
