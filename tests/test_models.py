import datetime as dt

import numpy as np
import pytest
from pyspark.sql import functions as F

from fadecast.operators import score, sequences, series
from fadecast.plans import backtest, battery_models, forecast, gram, search
from fadecast.plans.battery_features import capacity_fade, cycle_features, numbered_features
from fadecast.plans.forecast import WindowModel
from fadecast.spec import SeriesSpec

SPEC = SeriesSpec(keys=("k",), time="ds", target=("y",), past=("x",), step=3600)
T0 = dt.datetime(2024, 1, 1)
H = dt.timedelta(hours=1)


def hourly(spark, series_values):
    rows = [(k, T0 + i * H, float(v)) for k, vs in series_values.items() for i, v in enumerate(vs)]
    return spark.createDataFrame(rows, "k string, ds timestamp_ntz, y double")


# --- back-test and naive


def test_folds_cover_the_last_rows_once(spark):
    df = hourly(spark, {"a": range(300), "b": range(260)})
    g = series.regularise(df, ["k"], "ds", 3600)
    r = backtest.fold_rows(g).collect()
    assert len(r) == 2 * 240
    assert {(x["pos"] - (x["n"] - 240)) // 24 == x["fold"] and (x["pos"] - (x["n"] - 240)) % 24 + 1 == x["step"] for x in r} == {True}


@pytest.mark.parametrize("season, depth", [(24, 1), (24, 2), (7, 3), (48, 1)])
def test_naive_reads_nothing_after_the_origin(spark, season, depth):
    rng = np.random.default_rng(1)
    y = rng.normal(size=320)
    g = series.regularise(hourly(spark, {"a": y}), ["k"], "ds", 3600)
    got = backtest.seasonal_naive(g, ["k"], "y", [{"config_id": 0, "season": season, "depth": depth}], size=50)
    rows = got.collect()
    assert len(rows) == 240
    for r in rows:
        origin = 320 - 240 + 24 * r["fold"]
        s = -(-r["step"] // season)
        at = [r["pos"] - season * (s + i) for i in range(depth)]
        assert max(at) < origin and r["yhat"] == pytest.approx(np.mean(y[at]))


# --- grids


def test_grid_and_sampling(spark):
    g = search.ParamGrid({"b": [1, 2, 3], "a": ["x", "y"]})
    assert [g.config(i) for i in (0, 1, 3)] == [
        {"config_id": 0, "a": "x", "b": 1}, {"config_id": 1, "a": "x", "b": 2}, {"config_id": 3, "a": "y", "b": 1}]
    df = search.with_every_config(spark.range(2), g)
    assert sorted((r["id"], r["a"], r["b"]) for r in df.collect()) == [
        (i, a, b) for i in range(2) for a in "xy" for b in (1, 2, 3)]
    one, two = g.sample(spark, 4), g.sample(spark, 4)
    assert one == two and len({c["config_id"] for c in one}) == 4
    assert len(g.sample(spark, 99)) == 6
    fixed = search.merge_params(df, {"b": 9, "c": "z"})
    assert {(r["b"], r["c"]) for r in fixed.collect()} == {(9, "z")}


def test_params_survive_their_files(spark):
    wide = spark.createDataFrame([(2, 0.5, 13.0)], "depth int, rate double, rmse double")
    t = search.store_and_reload(spark, search.tall(wide, wide.columns), "t")
    assert {r["key"]: r["value"] for r in t.collect()} == {"depth": 2.0, "rate": 0.5, "rmse": 13.0}
    back = search.cast_params(search.wide(t, wide.columns).drop("rmse"), ["depth"]).collect()[0]
    assert back.asDict() == {"depth": 2, "rate": 0.5}
    neg = spark.createDataFrame([(-1.9,), (1.9,)], "v double")
    assert [r["v"] for r in search.cast_params(neg, ["v"]).collect()] == [-1, 1]


# --- least squares


def test_ridge_without_penalty_is_least_squares():
    rng = np.random.default_rng(2)
    X = np.hstack([np.ones((50, 1)), rng.normal(5, 3, size=(50, 4)), np.full((50, 1), 7.0)])
    Y = rng.normal(size=(50, 2))
    w = gram.ridge(X.T @ np.hstack([X, Y]), 0.0)
    want = np.linalg.lstsq(X[:, :5], Y, rcond=None)[0]
    assert w[:5] == pytest.approx(want) and (w[5] == 0).all()
    assert gram.ridge(np.zeros((3, 4)), 1.0) is None


def make_model(**kw):
    return WindowModel(past=("x",), future=("x",), static=("flag",), horizon=4, folds=3, inputs=((6, 2), (5, 3)),
                       penalties=(0.1, 1.0), **kw)


def model_grid(spark, ys, xs):
    rows = [
        (k, i, len(ys[k]), float(ys[k][i]) if i < len(ys[k]) else None, float(xs[k][i]), float(k == "a"))
        for k in ys
        for i in range(len(xs[k]))
    ]
    return spark.createDataFrame(rows, "k string, pos long, n long, y double, x double, flag double")


def direct(ys, xs, model, lags, cov, fold, penalty, keys):
    """The same model from a plain loop over windows."""
    def inputs(k, e):
        return np.concatenate([[1], ys[k][e - lags + 1 : e + 1], xs[k][e - cov + 1 : e + 1],
                               xs[k][e + 1 : e + 1 + model.horizon], [float(k == "a")]])

    X, Y, out = [], [], {}
    h = model.horizon
    for k in keys:
        n = len(ys[k])
        origin = n - (model.folds - fold) * h
        for e in range(max(lags, cov) - 1, origin - h):
            X.append(inputs(k, e))
            Y.append(ys[k][e + 1 : e + 1 + h])
    X, Y = np.array(X), np.array(Y)
    w = gram.ridge(X.T @ np.hstack([X, Y]), penalty)
    for k in keys:
        e = len(ys[k]) - (model.folds - fold) * h - 1
        out[k] = inputs(k, e) @ w
    return out


@pytest.mark.parametrize("local", [True, False])
@pytest.mark.parametrize("size", [16, 4096])
def test_fold_models_equal_a_retrain_per_fold(spark, local, size):
    rng = np.random.default_rng(3)
    ys = {"a": rng.normal(size=60), "b": rng.normal(size=47)}
    xs = {k: rng.normal(size=len(v) + 4) for k, v in ys.items()}
    model = make_model(local=local)
    grid = model_grid(spark, ys, xs).repartition(3)
    w = forecast.fit(grid, ["k"], model, size=size)
    got = {}
    for r in forecast.predict(grid, ["k"], model, w, range(4), size=size).collect():
        assert r["pos"] == len(ys[r["k"]]) - (3 - r["fold"]) * 4 + r["step"] - 1
        got[(r["k"], r["lags"], r["fold"], r["penalty_id"], r["step"])] = r["yhat"]
    assert len(got) == 2 * 2 * 4 * 2 * 4
    for lags, cov in model.inputs:
        for fold in range(4):
            for pid, pen in enumerate(model.penalties):
                for keys in [["a"], ["b"]] if local else [["a", "b"]]:
                    want = direct(ys, xs, model, lags, cov, fold, pen, keys)
                    for k in keys:
                        mine = [got[(k, lags, fold, pid, s)] for s in range(1, 5)]
                        assert mine == pytest.approx(list(want[k]), abs=1e-8)


def test_scores_compare_what_all_configurations_predict(spark):
    """A short series is lost for long windows only; it must not make them look better."""
    rng = np.random.default_rng(8)
    ys = {"a": rng.normal(size=60), "b": rng.normal(size=20)}
    lengths = spark.createDataFrame([(k, c, len(v)) for k, v in ys.items() for c in (1, 2)], "k string, c long, n long")
    rows = [(k, c, f, s, 1.0) for k in ys for c in (1, 2) for f in range(3) for s in range(1, 5)
            if not (k == "b" and c == 2 and f == 0) and not (k == "b" and c == 1 and f == 2 and s == 4)]
    found = backtest.covered(
        spark.createDataFrame(rows, "k string, c long, fold long, step long, yhat double"), lengths, ["k", "c"], horizon=4, folds=3
    )
    assert {tuple(r) for r in backtest.coverage(found, "c").collect()} == {(1, 24, 23), (2, 24, 20)}
    shared = backtest.shared_by_all(found, ["k"], "c", 2)
    cells = {(r["k"], r["fold"]) for r in shared.collect()}
    assert cells == {("a", 0), ("a", 1), ("a", 2), ("b", 1)} and shared.count() == 4 * 2 * 4
    lost = found.filter("yhat IS NULL").collect()
    assert len(lost) == 5 and {r["reason"] for r in lost} == {"the history is too short"}


def test_forecaster_beats_naive_on_an_autoregressive_series(spark):
    rng = np.random.default_rng(4)
    y = np.zeros(500)
    for i in range(1, 500):
        y[i] = 0.9 * y[i - 1] + rng.normal()
    hist = hourly(spark, {"a": y}).withColumn("x", F.lit(0.0))
    t = forecast.model_table(hist, None, SPEC)
    model = WindowModel(inputs=((24, 1),), local=True, penalties=(0.5,))
    p = forecast.predict(t.grid, ["k"], model, forecast.fit(t.grid, ["k"], model), range(10))
    p = forecast.unscaled(p, t)
    actual = series.regularise(hist, ["k"], "ds", 3600, values=["y"])
    mine = score.nested_rmse(score.align(p, actual, ["k"], "ds", "y"), ["k"], "fold").collect()[0]["rmse"]
    naive = backtest.seasonal_naive(actual, ["k"], "y", [{"config_id": 0, "season": 24, "depth": 1}])
    assert mine < score.nested_rmse(naive, ["k"], "fold").collect()[0]["rmse"]


def test_noiseless_season_is_recovered(spark):
    y = 10 + 3 * np.sin(np.arange(400) / 24 * 2 * np.pi)
    hist = hourly(spark, {"a": y}).withColumn("x", F.lit(0.0))
    t = forecast.model_table(hist, None, SPEC)
    model = WindowModel(inputs=((48, 1),), local=True, penalties=(1e-6,))
    p = forecast.predict(t.grid, ["k"], model, forecast.fit(t.grid, ["k"], model), [10])
    rows = forecast.unscaled(p, t).orderBy("step").collect()
    assert [r["ds"] for r in rows] == [T0 + (400 + i) * H for i in range(24)]
    assert [r["yhat"] for r in rows] == pytest.approx(list(10 + 3 * np.sin(np.arange(400, 424) / 24 * 2 * np.pi)), abs=1e-3)


def test_model_table_prefers_history_and_runs_on_into_the_future(spark):
    hist = hourly(spark, {"a": [1, 2, 5]}).withColumn("x", F.lit(3.0))
    hist = hist.filter(F.col("y") != 2)
    rows = [("a", T0 + i * H, 10.0 + i) for i in (2, 3, 4)]
    fut = spark.createDataFrame(rows, "k string, ds timestamp_ntz, x double")
    t = forecast.model_table(hist, fut, SPEC)
    got = [(r["pos"], r["n"], r["y"], r["x"]) for r in t.raw.orderBy("ds").collect()]
    assert got == [(0, 3, 1.0, 3.0), (1, 3, 0.0, 0.0), (2, 3, 5.0, 3.0), (3, 3, None, 13.0), (4, 3, None, 14.0)]
    assert t.history.count() == 3


def test_train_scope_keeps_the_test_range_out_of_the_scaler(spark):
    hist = hourly(spark, {"a": [0, 1, 2, 3, 50]}).withColumn("x", F.lit(0.0))
    t = forecast.model_table(hist, None, SPEC, fit_scope="train", holdout=1)
    assert t.stats.collect()[0]["y_max"] == 3.0
    top = t.grid.agg(F.max("y")).collect()[0][0]
    assert top == pytest.approx(50 / 3)


def test_importance_is_the_mean_over_permutations(spark):
    rng = np.random.default_rng(5)
    ys = {"a": rng.normal(size=20)}
    xs = {"a": rng.normal(size=24)}
    model = WindowModel(past=("x",), horizon=2, folds=1, inputs=((2, 1),), penalties=(0.1,))
    got = {r["variable"]: r["loss_rise"] for r in forecast.importance(model_grid(spark, ys, xs), ["k"], model, "variable").collect()}
    X = np.array([[1, ys["a"][e - 1], ys["a"][e], xs["a"][e]] for e in range(1, 18)])
    Y = np.array([ys["a"][e + 1 : e + 3] for e in range(1, 18)])
    w = gram.ridge(X.T @ np.hstack([X, Y]), 0.1)
    base = ((X @ w - Y) ** 2).mean(0).sum()
    for name, cols in {"y": [1, 2], "x": [3]}.items():
        # All pairings of a row with another row's values.
        total = 0.0
        for i in range(len(X)):
            Z = X.copy()
            Z[:, cols] = X[(np.arange(len(X)) + i) % len(X)][:, cols]
            total += ((Z @ w - Y) ** 2).mean(0).sum()
        assert got[name] == pytest.approx(total / len(X) - base)


# --- batteries


def battery(seed=6, cycles=5, per=30):
    rng = np.random.default_rng(seed)
    rows, e = [], 0
    for b in ("B0", "B1"):
        x = rng.normal(size=3)
        t = 100.0
        for c in range(1, cycles + 1):
            for i in range(per + c):
                x = 0.5 * x + rng.normal(size=3)
                t = float(t + 0.3 * x[0] + rng.normal(0, 0.2))
                rows.append((e, b, 2 * c, T0 + dt.timedelta(days=c, seconds=15 * i), *map(float, x), t,
                             2.0 - 0.01 * c + 0.05 * float(x[1])))
                e += 1
    return rows


COLS = "event_id long, battery_id string, cycle int, datetime_ timestamp_ntz, Voltage_measured double, Current_measured double, Temperature_measured double, Time double, Capacity double"


@pytest.fixture(scope="module")
def measured(spark):
    return spark.createDataFrame(battery(), COLS).repartition(4).cache()


def split_rows(rows, b):
    mine = sorted((r for r in rows if r[1] == b), key=lambda r: (r[3], r[0]))
    cyc = np.array([r[2] for r in mine])
    return mine, cyc, np.array([r[4:7] for r in mine]), {"Time": np.array([r[7] for r in mine]), "Capacity": np.array([r[8] for r in mine])}


def direct_arima(y, x, hist, fut):
    """Two-step least squares on the history alone, then the recursion."""
    m = battery_models.LONG_ORDER
    dy, dx = np.diff(y), np.diff(x, axis=0)
    H1 = [t for t in range(m + 2, hist)]
    Z = lambda t: np.concatenate([[dy[t - 1 - j] for j in range(1, m + 1)], dx[t - 1], dx[t - 2]])
    A = np.array([Z(t) for t in H1])
    alpha = np.linalg.lstsq(A, np.array([dy[t - 1] for t in H1]), rcond=None)[0]
    res = lambda t: dy[t - 1] - alpha @ Z(t)
    W = np.array([np.concatenate([[dy[t - 2]], dx[t - 1], dx[t - 2], [res(t - 1)]]) for t in H1])
    w = np.linalg.lstsq(W, np.array([dy[t - 1] for t in H1]), rcond=None)[0]
    phi, beta, gamma, theta = w[0], w[1:4], w[4:7], w[7]
    d, level, out = dy[hist - 2], y[hist - 1], []
    e = res(hist - 1)
    for t in fut:
        d = phi * d + beta @ dx[t - 1] + gamma @ dx[t - 2] + theta * e
        e = 0.0
        level += d
        out.append(level)
    return out


@pytest.mark.parametrize("size", [7, 4096])
def test_arimax_equals_a_fit_per_cycle(spark, measured, size):
    rows = battery()
    got = battery_models.arimax_by_cycle(measured, size=size).collect()
    assert len(got) == 2 * len(rows)
    assert all(r["yhat"] is None for r in got if r["cycle"] == 2)
    by = {(r["target"], r["event_id"]): r for r in got}
    for b in ("B0", "B1"):
        mine, cyc, x, ys = split_rows(rows, b)
        for c in (4, 6, 10):
            fut = np.flatnonzero(cyc == c)
            for t in ys:
                want = direct_arima(ys[t], x, int(fut[0]), fut)
                res = [by[(t, mine[i][0])] for i in fut]
                assert [r["yhat"] for r in res] == pytest.approx(want, rel=1e-6)
                assert [r["step"] for r in res] == list(range(1, len(fut) + 1))


def test_additive_equals_a_fit_per_cycle(spark, measured):
    span = measured.groupBy("battery_id").agg(F.min("datetime_").alias("a"), F.max("datetime_").alias("b"))
    x = battery_models.additive_inputs(F.col("datetime_"), F.col("a"), F.col("b"), battery_models.EXOG)
    feats = {r["event_id"]: np.array([1.0, *r["x"]]) for r in measured.join(span, "battery_id").select("event_id", x.alias("x")).collect()}
    rows = battery()
    got = {(r["target"], r["event_id"]): r["yhat"] for r in battery_models.additive_by_cycle(measured).collect()}
    assert len(got) == 2 * len(rows)
    mine, cyc, _, ys = split_rows(rows, "B1")
    X = np.array([feats[r[0]] for r in mine])
    for c in (2, 4, 10):
        at = np.flatnonzero(cyc == c)
        h = cyc < c
        for t, y in ys.items():
            mine_hat = [got[(t, mine[i][0])] for i in at]
            if c == 2:
                assert set(mine_hat) == {None}
                continue
            w = gram.ridge(X[h].T @ np.hstack([X[h], y[h][:, None]]), 1e-3)
            assert mine_hat == pytest.approx(list(X[at] @ w[:, 0]), rel=1e-5)


@pytest.mark.parametrize("size", [9, 4096])
def test_next_capacity_equals_a_fit_per_cycle(spark, measured, size):
    L = 8
    got = {(r["battery_id"], r["cycle"]): r["yhat"] for r in battery_models.capacity_next(measured, length=L, size=size).collect()}
    assert len(got) == 10
    rows = battery()
    for b in ("B0", "B1"):
        mine, cyc, x, ys = split_rows(rows, b)
        v = np.column_stack([ys["Capacity"], x])
        for c in (2, 4, 6, 10):
            h = v[cyc < c]
            assert got[(b, c)] == next_value(h, min(L, (len(h) - 1) // 2))


def next_value(h, L):
    """A plain loop over sequences of length L; None if none can be trained on."""
    if L < 1:
        return None
    lo, hi = h.min(0), h.max(0)
    s = (h - lo) / np.where(hi > lo, hi - lo, 1.0)
    X = np.array([np.concatenate([[1.0], s[i - L : i].ravel()]) for i in range(L, len(s))])[:-L]
    Y = s[L:, :1][:-L]
    w = gram.ridge(X.T @ np.hstack([X, Y]), 1e-2)
    width = hi[0] - lo[0] if hi[0] > lo[0] else 1.0
    return pytest.approx(np.concatenate([[1.0], s[-L:].ravel()]) @ w[:, 0] * width + lo[0], rel=1e-6)


@pytest.mark.parametrize("length", [5, 40])
def test_short_histories_get_shorter_sequences(spark, length):
    measured = spark.createDataFrame(battery(cycles=9, per=3), COLS)
    rows = battery(cycles=9, per=3)
    got = battery_models.capacity_next(measured, length=length).collect()
    assert len(got) == 2 * 9
    for b in ("B0", "B1"):
        mine, cyc, x, ys = split_rows(rows, b)
        v = np.column_stack([ys["Capacity"], x])
        for r in got:
            if r["battery_id"] == b:
                h = v[cyc < r["cycle"]]
                own = min(length, (len(h) - 1) // 2)
                assert r["length"] == (own if own > 0 else None)
                assert r["yhat"] == next_value(h, own)


@pytest.mark.parametrize("last", [1, 2, 50])
def test_bounded_histories_equal_a_fit_on_the_last_cycles(spark, measured, last):
    rows = battery()
    got = {(r["target"], r["event_id"]): r["yhat"] for r in battery_models.regression_by_cycle(measured, max_history=last).collect()}
    mean = {r["event_id"]: r["yhat_Time"] for r in battery_models.history_mean(measured, max_history=last).collect()}
    all_rows = {(r["target"], r["event_id"]): r["yhat"] for r in battery_models.regression_by_cycle(measured).collect()}
    for b in ("B0", "B1"):
        mine, cyc, x, ys = split_rows(rows, b)
        ids = np.array([r[0] for r in mine])
        for k, c in enumerate((2, 4, 6, 8, 10)):
            seen = np.isin(cyc, [2, 4, 6, 8, 10][max(0, k - last) : k])
            for t in ("Time", "Capacity"):
                here = ids[cyc == c]
                if not k:
                    assert {got[t, i] for i in here} == {None}
                    continue
                X = np.column_stack([np.ones(seen.sum()), x[seen]])
                w = gram.ridge(X.T @ np.column_stack([X, ys[t][seen]]), 1e-3)[:, 0]
                want = np.column_stack([np.ones(len(here)), x[cyc == c]]) @ w
                assert [got[t, i] for i in here] == pytest.approx(list(want), rel=1e-6)
                if last == 50:
                    assert [got[t, i] for i in here] == pytest.approx([all_rows[t, i] for i in here], rel=1e-9)
            if k:
                assert [mean[i] for i in ids[cyc == c]] == pytest.approx([ys["Time"][seen].mean()] * (cyc == c).sum())


def test_history_rows_of_the_last_blocks(spark):
    rows = [("a", c, 10 * c + i) for c in (1, 4, 5, 9) for i in range(c)] + [("b", 2, 7), ("b", None, 8), (None, 3, 9)]
    df = spark.createDataFrame(rows, "k string, c int, v int")
    got = sorted(tuple(r) for r in sequences.history_rows(df, ["k"], "c", 2).select("k", "c", "history_c", "v").collect())
    want = []
    for k, blocks in (("a", [1, 4, 5, 9]),):
        for i, c in enumerate(blocks):
            want += [(k, c, h, v) for h in blocks[max(0, i - 2) : i] for kk, hh, v in rows if kk == k and hh == h]
    assert got == sorted(want)
    with pytest.raises(ValueError):
        sequences.history_rows(df, ["k"], "c", 0)


def test_capacity_horizon_uses_only_the_past_and_known_inputs(spark, measured):
    base = {r["event_id"]: r["yhat"] for r in battery_models.capacity_horizon(measured).collect()}
    assert len(base) == len(battery())
    first = [r[0] for r in battery() if r[2] == 2]
    assert all(base[i] is None for i in first)
    later = [r[0] for r in battery() if r[2] > 4]
    assert all(base[i] is not None for i in later)
    # Changing capacities of the last cycle must not change its own forecast.
    changed = measured.withColumn("Capacity", F.when(F.col("cycle") == 10, F.col("Capacity") + 5).otherwise(F.col("Capacity")))
    other = {r["event_id"]: r["yhat"] for r in battery_models.capacity_horizon(changed).collect()}
    assert other == pytest.approx(base, nan_ok=True)


def test_first_cycle_has_null_predictions(spark, measured):
    rows = battery_models.history_mean(measured).collect()
    assert len(rows) == len(battery())
    assert {r["cycle"] for r in rows if r["yhat_Time"] is None} == {2}
    mine, cyc, _, ys = split_rows(battery(), "B0")
    got = {r["yhat_Time"] for r in rows if r["battery_id"] == "B0" and r["cycle"] == 6}
    assert len(got) == 1 and got.pop() == pytest.approx(ys["Time"][cyc < 6].mean())


def test_tails_reach_over_short_cycles(spark):
    rows = [(i, "B0", c, i) for i, c in enumerate([2, 2, 2, 4, 6, 6])]
    df = spark.createDataFrame(rows, "event_id long, battery_id string, cycle int, pos long")
    t = battery_models.tails(df, battery_models.cycle_starts(df), ["event_id"], 3).collect()
    assert {r["cycle"]: r["tail_event_id"] for r in t} == {4: [0, 1, 2], 6: [1, 2, 3]}


def test_cycle_features_and_fade(spark, measured):
    f = numbered_features(measured)
    rows = capacity_fade(f).collect()
    assert len(rows) == 10 and {r["n"] for r in rows} == {5}
    for r in rows:
        assert r["discharge_cycle_id"] == r["pos"] + 1
        assert (r["capacity_fade"] == 0) == (r["pos"] == 0)
    single = cycle_features(measured.filter("cycle = 2"))
    assert {r["capacity_fade"] for r in capacity_fade(single).collect()} == {0.0}


def test_sequence_regression_and_trees(spark, measured):
    f = numbered_features(measured)
    feats, targets = ["voltage_mean", "capacity"], ["time_total", "capacity"]
    p = battery_models.sequence_regression(f, feats, targets, 2).collect()
    assert {(r["battery_id"], r["discharge_cycle_id"], r["target"]) for r in p} == {(b, 6, t) for b in ("B0", "B1") for t in targets}
    assert all(np.isfinite(r["yhat"]) for r in p)
    g, models = battery_models.boosted_trees(f, targets, trees=2, depth=2)
    got = g.collect()
    assert {(r["battery_id"], r["discharge_cycle_id"], r["target"]) for r in got} == {(b, 6, t) for b in ("B0", "B1") for t in targets}
    assert models["capacity"].getNumTrees == 2
