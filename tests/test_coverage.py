"""Nothing is lost without a word: short series, missing values, duplicates, stray ids."""

import datetime as dt

import numpy as np
import pytest
from pyspark.sql import functions as F

from fadecast.operators import score, series
from fadecast.operators.ordered import positions
from fadecast.plans import backtest, battery_models, forecast, gram
from fadecast.spec import SeriesSpec
from tests.test_models import measured  # noqa: F401

T0 = dt.datetime(2024, 1, 1)


def hours(spark, lengths, step=1):
    rows = [(k, T0 + dt.timedelta(hours=step * i), float(i % 24) + len(k)) for k, n in lengths.items() for i in range(n)]
    return spark.createDataFrame(rows, "k string, ds timestamp_ntz, y double")


def test_two_rows_at_one_time_fail(spark):
    d = hours(spark, {"a": 5})
    with pytest.raises(Exception, match="two rows at one time"):
        series.regularise(d.union(d.limit(1)), ["k"], "ds", 3600).collect()


def test_step_is_inferred_per_key(spark):
    d = hours(spark, {"a": 5}).union(hours(spark, {"bb": 4}, step=6)).union(hours(spark, {"c": 1}))
    g = series.regularise(d, ["k"], "ds", None).groupBy("k").agg(F.max("n").alias("n"), F.count("y").alias("seen"))
    assert {r["k"]: (r["n"], r["seen"]) for r in g.collect()} == {"a": (5, 5), "bb": (4, 4), "c": (1, 1)}
    odd = d.union(spark.createDataFrame([("a", T0 + dt.timedelta(hours=1, minutes=25), 1.0)], d.schema))
    with pytest.raises(Exception, match="no common step"):
        series.regularise(odd, ["k"], "ds", None).collect()


def test_an_id_without_a_column_fails(spark):
    d = hours(spark, {"a": 1, "b": 1})
    assert series.known_values(d, "k") == ("a", "b")
    with pytest.raises(Exception, match="value without a column"):
        series.one_hot(d, "k", ["a"]).collect()


def test_scores_do_not_skip_missing_forecasts(spark):
    d = spark.createDataFrame([("a", 0, 1.0, 2.0), ("a", 0, 1.0, None)], "k string, fold long, actual double, yhat double")
    with pytest.raises(Exception, match="a forecast is missing"):
        score.errors(d, ["k"]).collect()
    with pytest.raises(Exception, match="a forecast is missing"):
        score.nested_rmse(d, ["k"], "fold").collect()
    r = score.errors(d, ["k"], partial=True).first()
    assert (r["n_points"], r["n_scored"], r["rmse"]) == (2, 1, 1.0)


def test_short_series_keep_their_rows(spark):
    spec = SeriesSpec(keys=("k",), time="ds", target=("y",), step=3600)
    t = forecast.model_table(hours(spark, {"long": 400, "mid": 90, "one": 1}), None, spec, calendar_names=())
    m = forecast.WindowModel(local=True, inputs=((24, 1),), folds=10, horizon=24, penalties=(1.0,))
    w = forecast.fit(t.grid, ["k"], m)
    folds = range(11)
    found = forecast.unscaled(forecast.predict(t.grid, ["k"], m, w, folds), t)
    rows = forecast.complete(found, t, m, folds).collect()
    assert len(rows) == 3 * 11 * 24
    assert all((r["yhat"] is None) == (r["reason"] is not None) for r in rows)
    by = {(r["k"], r["fold"]): r["reason"] for r in rows}
    assert by["long", 0] is None and by["one", 10] is not None and by["mid", 0] == "the origin lies before the series"
    assert by["mid", 10] is None


def test_naive_before_a_series_has_a_reason(spark):
    g = series.regularise(hours(spark, {"a": 90}), ["k"], "ds", 3600)
    got = backtest.seasonal_naive(g, ["k"], "y", [{"config_id": 0, "season": 24, "depth": 1}])
    lengths = g.groupBy("k").agg(F.max("n").alias("n"))
    rows = backtest.covered(got.select("k", "fold", "step", "yhat"), lengths, ["k"]).collect()
    assert len(rows) == 240 and sum(r["yhat"] is not None for r in rows) == 66


def test_sums_leave_out_rows_with_missing_numbers(spark):
    d = spark.createDataFrame(
        [("a", [1.0, 2.0], [1.0]), ("a", [1.0, None], [1.0]), ("a", [float("nan"), 1.0], [1.0]), ("a", [3.0, 1.0], [None]), ("a", None, [1.0])],
        "k string, x array<double>, y array<double>",
    )
    lines = gram.add_up(gram.partial_sums_of_rows(d, ["k"], "x", "y"), ["k"]).collect()
    assert [r["stripe"] for r in sorted(lines, key=lambda r: r["i"])] == [[1, 1, 2, 1], [1, 1, 2, 1], [2, 2, 4, 2]]


def test_a_missing_sensor_value_costs_its_own_rows_only(spark, measured):  # noqa: F811
    hole = measured.withColumn("Voltage_measured", F.when(F.col("event_id") % 10 != 3, F.col("Voltage_measured")))
    rows = battery_models.additive_by_cycle(hole).collect()
    first = {r["cycle"] for r in rows} and min(r["cycle"] for r in rows)
    for r in rows:
        assert (r["yhat"] is None) == (r["cycle"] == first or r["event_id"] % 10 == 3)
    assert battery_models.capacity_next(hole, length=3).count() > 0


def test_positions_over_a_sparse_ordinal(spark):
    d = spark.range(300).select((F.col("id") * (1 << 20)).alias("o"))
    assert sorted((r["o"], r["pos"]) for r in positions(d, [], "o").collect()) == [(i << 20, i) for i in range(300)]


@pytest.mark.parametrize("phi", [0.0, 0.7, -1.0, 1.0])
def test_ar1_equals_its_recursion(phi):
    drive = np.random.default_rng(0).normal(size=333)
    want, state = [], 0.0
    for v in drive:
        state = phi * state + v
        want.append(state)
    assert np.allclose(battery_models.ar1(phi, drive), want)


def test_all_models_in_one_table(spark, measured):  # noqa: F811
    found = battery_models.predictions(measured)
    assert found.columns == ["battery_id", "target", "model", "cycle", "step", "event_id", "yhat"]
    n, cycles = measured.count(), measured.select("battery_id", "cycle").distinct().count()
    by = {r["model"]: r["count"] for r in found.groupBy("model").count().collect()}
    assert by == {"history mean": 2 * n, "additive": 2 * n, "arimax": 2 * n, "horizon": n, "next value": cycles}
    s = battery_models.prediction_scores(found, measured)
    assert s.filter("n_scored = 0 and rmse is null").count() > 0


def test_a_stored_and_reloaded_choice_forecasts_the_same(spark):
    from fadecast.catalog.models import QUERIES

    sf = "/root/testdata/sf0.001"
    one, two = (
        {(r["unique_id"], r["ds"], r["config_id"]): r["forecast"] for r in QUERIES[q](spark, sf).collect()}
        for q in ("forecast_future", "tuned_forecast")
    )
    assert one.keys() == two.keys() and all(abs(v - two[k]) < 1e-6 for k, v in one.items())
