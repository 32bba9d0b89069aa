import datetime as dt
import math

import numpy as np
import pytest

from fadecast.functions import calendar
from fadecast.operators import diagnose, scale, score, sequences, series, windows

T0 = dt.datetime(2024, 1, 1)
H = dt.timedelta(hours=1)


def hourly(spark, values, key="a", start=T0):
    rows = [(key, start + i * H, float(v)) for i, v in enumerate(values) if v is not None]
    return spark.createDataFrame(rows, "k string, ds timestamp_ntz, y double")


def filled(spark, values, fill, size=3):
    g = series.regularise(hourly(spark, values), ["k"], "ds", 3600, fill=fill, size=size)
    rows = g.orderBy("ds").collect()
    assert [r["pos"] for r in rows] == list(range(len(values)))
    assert {r["n"] for r in rows} == {len(values)}
    return [r["y"] for r in rows]


GAPPY = [1, None, None, 4, 5, None, None, None, 1]


@pytest.mark.parametrize(
    "fill, want",
    [
        ("none", GAPPY),
        ("zero", [1, 0, 0, 4, 5, 0, 0, 0, 1]),
        ("ffill", [1, 1, 1, 4, 5, 5, 5, 5, 1]),
        ("linear", [1, 2, 3, 4, 5, 4, 3, 2, 1]),
    ],
)
@pytest.mark.parametrize("size", [2, 100])
def test_fill(spark, fill, want, size):
    assert filled(spark, GAPPY, fill, size) == pytest.approx(want, nan_ok=True) if fill != "none" else filled(spark, GAPPY, fill, size) == want


def test_gap_fails_by_choice(spark):
    with pytest.raises(Exception, match="gaps"):
        filled(spark, GAPPY, "error")
    assert filled(spark, [1, 2, 3], "error") == [1, 2, 3]


def test_row_off_the_grid_fails(spark):
    df = hourly(spark, [1, 2, 3]).union(hourly(spark, [9], start=T0 + dt.timedelta(minutes=90)))
    with pytest.raises(Exception, match="off the grid"):
        series.regularise(df, ["k"], "ds", 3600).collect()


def test_infer_step(spark):
    a = hourly(spark, [1, None, 2, None, None, None, 3])
    b = hourly(spark, [1, None, 2, None, None, 3], key="b")
    got = {r["k"]: (r["step_seconds"], r["n_gaps"], r["regular"]) for r in series.infer_step(a.union(b), ["k"], "ds").collect()}
    assert got == {"a": (7200, 2, True), "b": (7200, 2, False)}


def test_codes_are_shared(spark):
    df = spark.createDataFrame([("FR",), ("BE",), ("FR",), (None,)], "k string")
    codes = series.category_codes(df, "k")
    got = {(r["k"], r["code"]) for r in series.with_codes(df, codes, "k").collect()}
    assert got == {("BE", 0), ("FR", 1), (None, None)}


def test_calendar_at_year_end(spark):
    t = dt.datetime(2024, 12, 30, 23)
    df = spark.createDataFrame([(t,)], "ds timestamp_ntz")
    r = calendar.encode(df, "ds", attributes_of=calendar.ATTRIBUTES, cyclic_of=["hour", "month"]).collect()[0]
    assert (r["hour"], r["day"], r["dayofweek"], r["week"], r["month"]) == (23, 30, 0, 1, 12)
    assert r["hour_sin"] == pytest.approx(math.sin(2 * math.pi * 23 / 24))
    assert r["month_cos"] == pytest.approx(math.cos(2 * math.pi * 11 / 12))
    local = calendar.encode(df, "ds", attributes_of=["hour", "day"], zone="CET").collect()[0]
    assert (local["hour"], local["day"]) == (0, 31)


def test_scaling_round_trip_and_constant(spark):
    df = hourly(spark, [3, 7, 5]).union(hourly(spark, [4, 4], key="flat"))
    st = scale.minmax_stats(df, ["k"], ["y"])
    s = scale.minmax_apply(df, st, ["k"], ["y"])
    back = scale.minmax_invert(s, st, ["k"], {"y_scaled": "y"})
    rows = back.collect()
    assert all(r["y_scaled_raw"] == pytest.approx(r["y"]) for r in rows)
    assert {r["y_scaled"] for r in rows if r["k"] == "flat"} == {0.0}
    n = scale.normalise_group(df, ["k"], "y").collect()
    assert {r["normalised"] for r in n if r["k"] == "flat"} == {0.0}
    assert sum(r["normalised"] for r in n) == pytest.approx(0)


def test_decomposition_recovers_a_season(spark):
    season = np.sin(np.arange(24) / 24 * 2 * np.pi)
    y = np.tile(season, 4) + 0.5 * np.arange(96)
    g = series.regularise(hourly(spark, y), ["k"], "ds", 3600)
    for size in (5, 1000):
        rows = diagnose.seasonal_decompose(g, ["k"], "y", 24, size=size).orderBy("pos").collect()
        inner = rows[12:-12]
        assert all(r["trend"] is None and r["resid"] is None for r in rows[:12] + rows[-12:])
        assert [r["seasonal"] for r in rows[:24]] == pytest.approx(list(season - season.mean()), abs=1e-9)
        assert max(abs(r["resid"]) for r in inner) < 1e-9
        assert all(r["trend"] + r["seasonal"] + r["resid"] == pytest.approx(r["y"]) for r in inner)


def test_decomposition_rejects_short_and_null(spark):
    short = series.regularise(hourly(spark, range(30)), ["k"], "ds", 3600)
    with pytest.raises(Exception, match="two full periods"):
        diagnose.seasonal_decompose(short, ["k"], "y", 24).collect()
    gap = series.regularise(hourly(spark, [1.0] * 30 + [None] + [1.0] * 30), ["k"], "ds", 3600)
    with pytest.raises(Exception, match="null in the series"):
        diagnose.seasonal_decompose(gap, ["k"], "y", 24).collect()


def test_odd_period(spark):
    y = [float(i % 3) + i for i in range(12)]
    g = series.regularise(hourly(spark, y), ["k"], "ds", 3600)
    rows = diagnose.seasonal_decompose(g, ["k"], "y", 3).orderBy("pos").collect()
    assert [r["trend"] for r in rows[1:-1]] == pytest.approx([np.mean(y[i - 1 : i + 2]) for i in range(1, 11)])


@pytest.mark.parametrize("size", [7, 64, 4096])
def test_acf_and_pacf(spark, size):
    rng = np.random.default_rng(0)
    y = np.zeros(150)
    for i in range(1, 150):
        y[i] = 0.7 * y[i - 1] + rng.normal()
    g = series.regularise(hourly(spark, y), ["k"], "ds", 3600)
    a = diagnose.acf(g, ["k"], "y", 20, size=size)
    rows = a.orderBy("lag").collect()
    d = y - y.mean()
    r = [float(d[: 150 - k] @ d[k:] / (d @ d)) for k in range(21)]
    assert [x["r"] for x in rows] == pytest.approx(r)
    assert rows[0]["band"] == 0 and rows[3]["band"] == pytest.approx(
        1.959964 * math.sqrt((1 + 2 * (r[1] ** 2 + r[2] ** 2)) / 150)
    )
    p = [x["pacf"] for x in diagnose.pacf(a, ["k"]).orderBy("lag").collect()]
    for k in (1, 2, 5, 20):
        R = np.array([[r[abs(i - j)] for j in range(k)] for i in range(k)])
        assert p[k] == pytest.approx(np.linalg.solve(R, r[1 : k + 1])[-1])


def test_acf_of_a_constant_is_null(spark):
    g = series.regularise(hourly(spark, [0.1] * 30), ["k"], "ds", 3600)
    a = diagnose.acf(g, ["k"], "y", 5)
    assert {r["r"] for r in a.collect()} == {None}
    assert {r["pacf"] for r in diagnose.pacf(a, ["k"]).collect()} == {None}


def test_sequences_and_walk_forward(spark):
    df = spark.createDataFrame([("a", i, float(i)) for i in range(6)] + [("b", 0, 9.0)], "k string, pos long, v double")
    s = sequences.sequences(df, ["k"], "pos", ["v"], 3, size=2).orderBy("pos").collect()
    assert [(r["k"], r["pos"], [x[0] for x in r["x"]]) for r in s] == [
        ("a", 3, [0, 1, 2]), ("a", 4, [1, 2, 3]), ("a", 5, [2, 3, 4])]
    w = sequences.walk_forward(df, ["k"], "pos", 3, ["v"], size=2).orderBy("pos").collect()
    assert [(r["pos"], r["n_train"], r["train_sum_v"]) for r in w] == [(3, 3, 3.0), (4, 4, 6.0), (5, 5, 10.0)]


def test_encoder_never_sees_its_own_row(spark):
    df = spark.createDataFrame([("a", i, float(i)) for i in range(5)], "k string, pos long, v double")
    rows = windows.encoder_windows(df, ["k"], "pos", ["v"], known=[], unknown=["v"], longest=2, size=2).orderBy("pos").collect()
    assert [[e["v"] for e in r["encoder"]] for r in rows] == [[], [0], [0, 1], [1, 2], [2, 3]]
    assert all(r["decoder"]["v"] is None for r in rows)


def test_missing_actual_fails(spark):
    f = hourly(spark, [1, 2, 3]).withColumnRenamed("y", "yhat")
    with pytest.raises(Exception, match="no actual value"):
        score.align(f, hourly(spark, [1, 2]), ["k"], "ds", "y").collect()


def test_nested_rmse_is_not_pooled(spark):
    rows = [("a", 0, 1.0, 0.0), ("b", 0, 3.0, 0.0), ("a", 1, 1.0, 1.0), ("b", 1, 5.0, 0.0)]
    df = spark.createDataFrame(rows, "k string, fold int, actual double, yhat double")
    r = score.nested_rmse(df, ["k"], "fold").collect()[0]
    assert r["rmse"] == pytest.approx(((1 + 3) / 2 + (0 + 5) / 2) / 2) and r["n_folds"] == 2
    e = {(r["k"], r["fold"]): r for r in score.errors(df, ["k", "fold"]).collect()}
    assert e[("b", 1)]["mae"] == 5 and e[("b", 1)]["mape"] == 1


def test_best(spark):
    df = spark.createDataFrame([(0, 3.0), (1, 2.0), (2, 2.0)], "config_id int, rmse double")
    assert sorted(r["config_id"] for r in score.best_with_ties(df, "rmse").collect()) == [1, 2]
    assert [r["config_id"] for r in score.best_first(df, "rmse", ["config_id"]).collect()] == [1]


def test_shared_extents(spark):
    df = hourly(spark, [1, 2]).union(hourly(spark, [1, 2], key="b")).union(hourly(spark, [1, 2, 3], key="c"))
    got = score.shared_extents(score.extents(df, ["k"], "ds"), ["k"]).collect()
    assert {(r["k"], r["group_first_k"], r["group_size"]) for r in got} == {("a", "a", 2), ("b", "a", 2), ("c", "c", 1)}
