"""Overlapping folds, models fitted where a series lies, and scalers per fold."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from fadecast.plans import backtest, forecast, gram
from fadecast.plans.forecast import WindowModel
from tests.test_models import model_grid

INPUTS = ((6, 2), (5, 3))


def model(**kw):
    kw = {"horizon": 4, "folds": 3, "inputs": INPUTS, "penalties": (0.1, 1.0)} | kw
    return WindowModel(past=("x",), future=("x",), static=("flag",), **kw)


def data(lengths, seed=3, ahead=4):
    rng = np.random.default_rng(seed)
    ys = {k: rng.normal(size=n) * 3 + 10 for k, n in lengths.items()}
    return ys, {k: rng.normal(size=len(v) + ahead) * 2 for k, v in ys.items()}


def direct(ys, xs, m, lags, cov, fold, penalty, keys, per_fold=False):
    """One fold from a plain loop; with ``per_fold`` scaled by the rows before its origin."""
    h = m.horizon
    origin = {k: int(m.origin(len(ys[k]), fold)) for k in keys}
    scale = {}
    for k in keys:
        seen_y, seen_x = ys[k][: origin[k]], xs[k][: origin[k]]
        wide = lambda v: np.ptp(v) if len(v) and np.ptp(v) > 0 else 1.0
        scale[k] = (seen_y.min(), wide(seen_y), seen_x.min(), wide(seen_x)) if per_fold and len(seen_y) else (0.0, 1.0, 0.0, 1.0)
    y = {k: (ys[k] - scale[k][0]) / scale[k][1] for k in keys}
    x = {k: (xs[k] - scale[k][2]) / scale[k][3] for k in keys}

    def inputs(k, e):
        return np.concatenate([[1], y[k][e - lags + 1 : e + 1], x[k][e - cov + 1 : e + 1], x[k][e + 1 : e + 1 + h], [float(k == "a")]])

    X, Y = [], []
    for k in keys:
        for e in range(max(lags, cov) - 1, origin[k] - h):
            X.append(inputs(k, e))
            Y.append(y[k][e + 1 : e + 1 + h])
    if not X:
        return {}
    X, Y = np.array(X), np.array(Y)
    w = gram.ridge(X.T @ np.hstack([X, Y]), penalty)
    return {
        k: inputs(k, origin[k] - 1) @ w * scale[k][1] + scale[k][0]
        for k in keys if origin[k] >= max(lags, cov) and origin[k] - 1 + h < len(xs[k])
    }


def same(rows, ys, xs, m, folds, keysets, per_fold=False):
    got = {}
    for r in rows:
        assert r["pos"] == int(m.origin(len(ys[r["k"]]), r["fold"])) + r["step"] - 1
        got.setdefault((r["k"], r["lags"], r["fold"], r["penalty_id"]), {})[r["step"]] = r["yhat"]
    want = {}
    for lags, cov in m.inputs:
        for fold in folds:
            for pid, pen in enumerate(m.penalties):
                for keys in keysets:
                    for k, v in direct(ys, xs, m, lags, cov, fold, pen, keys, per_fold).items():
                        want[k, lags, fold, pid] = v
    assert got.keys() == want.keys()
    for at, v in want.items():
        assert [got[at][s] for s in range(1, m.horizon + 1)] == pytest.approx(list(v), abs=1e-7)


@pytest.mark.parametrize("stride", [1, 3, 4, 6, 20])
def test_overlapping_folds_equal_a_retrain_per_fold(spark, stride):
    ys, xs = data({"a": 60, "b": 47})
    m = model(local=True, stride=stride, penalties=(0.1,))
    grid = model_grid(spark, ys, xs)
    folds = range(m.n_folds + 1)
    assert m.n_folds == len({r.fold for r in backtest.folds_of_series(spark.createDataFrame([(60,)], "n long"), horizon=4, folds=3, stride=stride).collect()})
    p = forecast.predict(grid, ["k"], m, forecast.fit(grid, ["k"], m), folds)
    same(p.collect(), ys, xs, m, folds, [["a"], ["b"]])


@pytest.mark.parametrize("rows_a_task, size", [(4096, 4096), (4096, 16), (15, 4096), (15, 16)])
@pytest.mark.parametrize("stride", [None, 3])
def test_series_fitted_in_place_equal_those_from_shared_sums(spark, monkeypatch, rows_a_task, size, stride):
    """Few rows a task: ranges cut series, which then take the other way."""
    monkeypatch.setattr(forecast, "ROWS_A_TASK", rows_a_task)
    ys, xs = data({"a": 60, "b": 47, "c": 9, "d": 25, "e": 18})
    m = model(local=True, stride=stride)
    grid = model_grid(spark, ys, xs).repartition(3)
    folds = range(m.n_folds + 1)
    got = forecast.fit_predict(grid, ["k"], m, folds, size=size)
    same(got.collect(), ys, xs, m, folds, [[k] for k in ys])
    assert got.columns == forecast.predict(grid, ["k"], m, forecast.fit(grid, ["k"], m), folds).columns


def test_a_future_that_ends_early_and_missing_values(spark, monkeypatch):
    ys, xs = data({"a": 40, "b": 40}, ahead=0)
    m = model(local=True)
    got = forecast.fit_predict(model_grid(spark, ys, xs), ["k"], m, range(m.n_folds + 1))
    same(got.collect(), ys, xs, m, range(m.n_folds + 1), [["a"], ["b"]])
    holes = model_grid(spark, ys, xs).withColumn("y", F.when(F.col("pos") != 30, F.col("y")))
    one = forecast.fit_predict(holes, ["k"], m, range(3)).collect()
    two = forecast.predict(holes, ["k"], m, forecast.fit(holes, ["k"], m), range(3)).collect()
    key = lambda r: (r["k"], r["lags"], r["fold"], r["penalty_id"], r["step"])
    one, two = ({key(r): r["yhat"] for r in rows} for rows in (one, two))
    assert one.keys() == two.keys()
    for k in one:
        assert one[k] == two[k] if two[k] is None or one[k] is None else one[k] == pytest.approx(two[k], abs=1e-8)


def test_no_series(spark):
    grid = model_grid(spark, *data({"a": 9})).filter("pos < 0")
    assert forecast.fit_predict(grid, ["k"], model(local=True), range(3)).collect() == []
    m = model()
    assert forecast.fit_fold_scope(grid, ["k"], m).collect() == []


@pytest.mark.parametrize("rows_a_task", [4096, 15])
@pytest.mark.parametrize("stride", [None, 6])
def test_scaler_per_fold_equals_scaling_and_retraining(spark, monkeypatch, rows_a_task, stride):
    monkeypatch.setattr(forecast, "ROWS_A_TASK", rows_a_task)
    ys, xs = data({"a": 60, "b": 47, "c": 33})
    ys["b"] = ys["b"] * 40 + np.arange(47)  # the range keeps growing
    xs["c"][:] = 2.0  # constant
    m = model(stride=stride)
    grid = model_grid(spark, ys, xs).repartition(4)
    folds = range(m.n_folds + 1)
    scales = forecast.fold_scales(grid, ["k"], m)
    w = forecast.fit_fold_scope(grid, ["k"], m)
    got = forecast.predict(grid, ["k"], m, w, folds, scales=scales).collect()
    same(got, ys, xs, m, folds, [["a", "b", "c"]], per_fold=True)


def test_fold_scales_see_nothing_after_the_origin(spark):
    ys, xs = data({"a": 30})
    ys["a"][25:] = 1e6
    m = model()
    for r in forecast.fold_scales(model_grid(spark, ys, xs), ["k"], m).collect():
        seen = ys["a"][: int(m.origin(30, r["fold"]))]
        assert r["_lo"][0] == seen.min() and r["_width"][0] == pytest.approx(np.ptp(seen))
