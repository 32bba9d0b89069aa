"""Queries for forecasters, back-tests, searches and importances."""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import functions as F

from fadecast.catalog.base import DISCHARGE, ELEC, FEATURES, GRID, USERS, ctes, q6, r6
from fadecast.operators import score, sequences, series
from fadecast.plans import backtest, battery_models, changepoints, forecast, search
from fadecast.plans.battery_features import numbered_features
from fadecast.plans.forecast import WindowModel
from fadecast.session import checkpointed
from fadecast.sources import tables
from fadecast.spec import ELECTRICITY

QUERIES, ORACLES = {}, {}
KEYS = ["unique_id"]
FEATS = ("voltage_mean", "current_mean", "temperature_mean", "time_total", "capacity")
TARGETS = ("time_total", "capacity")


def query(sql=None):
    def add(fn):
        QUERIES[fn.__name__] = fn
        if sql:
            ORACLES[fn.__name__] = sql
        return fn

    return add


def _table(spark, sf, static=False, **kw):
    hist, fut = tables.electricity(spark, sf), tables.electricity_future(spark, sf)
    flags = {"unique_id": series.known_values(hist, "unique_id")} if static else None
    return forecast.model_table(hist, fut, ELECTRICITY, static=flags, **kw)


def _local(table):
    return WindowModel(
        past=ELECTRICITY.past, calendar=table.calendar, local=True, inputs=((96, 24),), penalties=(1.0,)
    )


def _global(table, **kw):
    kw = {"inputs": ((96, 24),), "penalties": (0.1,)} | kw
    return WindowModel(
        past=ELECTRICITY.past, future=ELECTRICITY.future, calendar=table.calendar, static=table.static, **kw
    )


def _run(table, model, folds):
    found = forecast.unscaled(forecast.forecasts(table, model, folds), table)
    return forecast.complete(found, table, model, folds)


def _scores(table, predictions, by=()):
    a = score.align(predictions, table.history, KEYS, "ds", "y")
    return score.nested_rmse(a, KEYS, "fold", by=by)


@query()
def forecast_window(spark, sf):
    """Next 24 hours of each series from its own model."""
    t = _table(spark, sf)
    return _run(t, _local(t), [10]).select("unique_id", "ds", "step", "yhat")


@query()
def forecast_global(spark, sf):
    """Next 24 hours of each series from one model with static covariates."""
    t = _table(spark, sf, static=True)
    return _run(t, _global(t), [10]).select("unique_id", "ds", "step", "yhat")


@query()
def backtest_window(spark, sf):
    """Rolling-origin error of the per-series forecaster."""
    t = _table(spark, sf)
    return _scores(t, _run(t, _local(t), range(10)))


@query()
def backtest_window_train_scope(spark, sf):
    """As ``backtest_window``, with a scaler that has not seen the test folds."""
    t = _table(spark, sf, fit_scope="train")
    return _scores(t, _run(t, _local(t), range(10)))


@query()
def backtest_global(spark, sf):
    """Rolling-origin error of the global forecaster."""
    t = _table(spark, sf, static=True)
    return _scores(t, _run(t, _global(t), range(10)))


# One lag and no covariates: ridge on a standardised input has a closed form.
_ONE_LAG = """mm AS (SELECT unique_id, min(y0) AS lo, max(y0) AS hi FROM grid GROUP BY unique_id),
s AS (SELECT g.unique_id, g.pos, g.n, (g.y0 - lo) / (hi - lo) AS s, lo, hi FROM grid g JOIN mm ON g.unique_id = mm.unique_id),
win AS (
  SELECT a.unique_id, a.pos, a.n, b.pos - a.pos AS step, a.s AS x, b.s AS y
  FROM s a JOIN s b ON a.unique_id = b.unique_id AND b.pos BETWEEN a.pos + 1 AND a.pos + 24),
fit AS (
  SELECT win.unique_id, f.f AS fold, step, avg(x) AS mx, avg(y) AS my, covar_pop(x, y) AS c, covar_pop(x, y) / (var_pop(x) * (1 + 0.5e0)) AS w
  FROM win JOIN range(11) f(f) ON win.pos + 24 <= win.n - (10 - f.f) * 24 - 1 GROUP BY ALL)"""


@query(
    ctes(ELEC, GRID, _ONE_LAG)
    + f"""SELECT fit.unique_id, CAST(fold AS BIGINT) AS fold, CAST(step AS BIGINT) AS step,
  {q6('(my + w * (s.s - mx)) * (hi - lo) + lo')} AS yhat
FROM fit JOIN s ON s.unique_id = fit.unique_id AND s.pos = s.n - (10 - fold) * 24 - 1"""
)
def backtest_one_lag(spark, sf):
    """Every fold and the final forecast of a one-lag model per series."""
    t = forecast.model_table(tables.electricity(spark, sf), None, ELECTRICITY)
    model = WindowModel(local=True, inputs=((1, 1),), penalties=(0.5,))
    return _run(t, model, range(11)).select("unique_id", "fold", "step", r6("yhat").alias("yhat"))


@query(
    ctes(ELEC, GRID, _ONE_LAG.replace("fit AS (\n  SELECT win.unique_id,", "fit AS (\n  SELECT").replace("GROUP BY ALL", "GROUP BY f.f, step"))
    + f"""SELECT s.unique_id, CAST(fold AS BIGINT) AS fold, CAST(step AS BIGINT) AS step,
  {q6('(my + w * (s.s - mx)) * (hi - lo) + lo')} AS yhat
FROM fit JOIN s ON s.pos = s.n - (10 - fold) * 24 - 1"""
)
def backtest_one_lag_global(spark, sf):
    """The same with one model for all series."""
    t = forecast.model_table(tables.electricity(spark, sf), None, ELECTRICITY)
    model = WindowModel(inputs=((1, 1),), penalties=(0.5,))
    return _run(t, model, range(11)).select("unique_id", "fold", "step", r6("yhat").alias("yhat"))


# Folds every 6 hours overlap; the last one is the forecast after the last row.
_STRIDE = 6
_N_FOLDS = backtest.fold_count(stride=_STRIDE)
_ORIGIN = f"CASE WHEN {{f}} = {_N_FOLDS} THEN {{n}} ELSE {{n}} - 240 + {_STRIDE} * {{f}} END"


@query(
    ctes(ELEC, GRID, _ONE_LAG.replace("range(11)", f"range({_N_FOLDS + 1})").replace(
        "win.n - (10 - f.f) * 24 - 1", _ORIGIN.format(f="f.f", n="win.n") + " - 1"))
    + f"""SELECT fit.unique_id, CAST(fold AS BIGINT) AS fold, CAST(step AS BIGINT) AS step,
  {q6('(my + w * (s.s - mx)) * (hi - lo) + lo')} AS yhat
FROM fit JOIN s ON s.unique_id = fit.unique_id AND s.pos = {_ORIGIN.format(f='fold', n='s.n')} - 1"""
)
def backtest_one_lag_overlapping(spark, sf):
    """Retrained folds that start every 6 hours, each 24 hours long."""
    t = forecast.model_table(tables.electricity(spark, sf), None, ELECTRICITY)
    model = WindowModel(local=True, inputs=((1, 1),), penalties=(0.5,), stride=_STRIDE)
    return _run(t, model, range(model.n_folds + 1)).select("unique_id", "fold", "step", r6("yhat").alias("yhat"))


@query()
def backtest_window_overlapping(spark, sf):
    """Rolling-origin error of the per-series forecaster with a fold every 12 hours."""
    t = _table(spark, sf)
    model = replace(_local(t), stride=12)
    return _scores(t, _run(t, model, range(model.n_folds)))


@query(
    ctes(ELEC, GRID, """org AS (
  SELECT g.unique_id, f.f AS fold, g.n, g.n - (10 - f.f) * 24 AS origin
  FROM (SELECT DISTINCT unique_id, n FROM grid) g, range(11) f(f)),
sc AS (
  SELECT o.unique_id, o.fold, o.origin, min(g.y0) AS lo, CASE WHEN max(g.y0) > min(g.y0) THEN max(g.y0) - min(g.y0) ELSE 1 END AS wide
  FROM org o JOIN grid g ON g.unique_id = o.unique_id AND g.pos < o.origin GROUP BY ALL),
win AS (
  SELECT sc.fold, b.pos - a.pos AS step, (a.y0 - lo) / wide AS x, (b.y0 - lo) / wide AS y
  FROM sc JOIN grid a ON a.unique_id = sc.unique_id AND a.pos + 24 < sc.origin
  JOIN grid b ON b.unique_id = a.unique_id AND b.pos BETWEEN a.pos + 1 AND a.pos + 24),
fit AS (
  SELECT fold, step, avg(x) AS mx, avg(y) AS my, covar_pop(x, y) / (var_pop(x) * (1 + 0.5e0)) AS w
  FROM win GROUP BY fold, step)""")
    + f"""SELECT sc.unique_id, CAST(sc.fold AS BIGINT) AS fold, CAST(step AS BIGINT) AS step,
  {q6('(my + w * ((g.y0 - lo) / wide - mx)) * wide + lo')} AS yhat
FROM sc JOIN fit ON fit.fold = sc.fold JOIN grid g ON g.unique_id = sc.unique_id AND g.pos = sc.origin - 1"""
)
def backtest_one_lag_fold_scope(spark, sf):
    """One model for all series, scaled by what lies before each fold."""
    t = forecast.model_table(tables.electricity(spark, sf), None, ELECTRICITY, fit_scope="fold")
    model = WindowModel(inputs=((1, 1),), penalties=(0.5,))
    return _run(t, model, range(11)).select("unique_id", "fold", "step", r6("yhat").alias("yhat"))


@query()
def backtest_global_fold_scope(spark, sf):
    """As ``backtest_global``, with a scaler fitted anew on what lies before each fold."""
    t = _table(spark, sf, static=True, fit_scope="fold")
    return _scores(t, _run(t, _global(t), range(10)))


SEARCH = search.ParamGrid(
    {
        "input_chunk_length": [48, 96, 172],
        "covariate_lags": [1, 12, 24],
        "ridge": [0.01, 0.1, 1.0, 10.0],
    }
)
N_ITER = 10


def _search(spark, grid, configs, table, model):
    """Coefficients of the sampled configurations and their completed back-test forecasts."""
    # Penalties share a matrix, so all of them are solved and the sampled kept.
    chosen = F.array(
        *[
            F.struct(
                F.lit(c["config_id"]).cast("long").alias("config_id"),
                F.lit(c["input_chunk_length"]).cast("long").alias("lags"),
                F.lit(c["covariate_lags"]).cast("long").alias("cov_lags"),
                F.lit(grid.lists["ridge"].index(c["ridge"])).cast("long").alias("penalty_id"),
            )
            for c in configs
        ]
    )
    mine = F.filter(
        chosen,
        lambda c: (c["lags"] == F.col("lags"))
        & (c["cov_lags"] == F.col("cov_lags"))
        & (c["penalty_id"] == F.col("penalty_id")),
    )
    w = forecast.fit(table.grid, KEYS, model)
    w = w.withColumn("config_id", F.get(mine, F.lit(0))["config_id"]).filter("config_id IS NOT NULL")
    # Bounded by the settings, and used for scoring and for the final forecast.
    w = checkpointed(w)
    return w, _of_configs(spark, configs, table, model, w, range(model.n_folds))


def _of_configs(spark, configs, table, model, w, folds):
    """Forecasts of each configuration, series, fold and step; null with a reason where none is."""
    p = forecast.predict(table.grid, KEYS, model, w, folds, extra=["config_id"])
    ids = spark.createDataFrame([(c["config_id"],) for c in configs], "config_id long")
    return forecast.complete(forecast.unscaled(p, table), table, model, folds, ids)


def _search_scores(configs, table, found):
    """Scores over the series and folds that all configurations predict, and what each lost."""
    shared = backtest.shared_by_all(found, KEYS, "config_id", len(configs))
    rmse = _scores(table, shared, by=["config_id"])
    rows = backtest.coverage(found, "config_id").join(rmse, "config_id", "left")
    return search.attach_params(rows, configs)


def _searched(grid, configs):
    """The shapes and penalties of a search."""
    shapes = sorted({(c["input_chunk_length"], c["covariate_lags"]) for c in configs})
    return {"inputs": tuple(shapes), "penalties": tuple(grid.lists["ridge"])}


def _best_of_search(spark, sf):
    configs = SEARCH.sample(spark, N_ITER)
    table = _table(spark, sf, static=True)
    model = _global(table, **_searched(SEARCH, configs))
    w, found = _search(spark, SEARCH, configs, table, model)
    return _search_scores(configs, table, found), configs, table, model, w


@query()
def random_search(spark, sf):
    """Score of every sampled configuration."""
    return _best_of_search(spark, sf)[0]


@query()
def forecast_future(spark, sf):
    """Next 24 hours from the best configuration of the search."""
    scores, configs, table, model, w = _best_of_search(spark, sf)
    best = score.best_first(scores, "rmse", ["config_id"]).select("config_id")
    best = [c for c in configs if c["config_id"] == best.first()["config_id"]]
    w = w.filter(F.col("config_id") == best[0]["config_id"])
    p = _of_configs(spark, best, table, model, w, [model.n_folds])
    return p.select("unique_id", "ds", "step", "config_id", F.col("yhat").alias("forecast"), "reason")


@query()
def tuned_forecast(spark, sf):
    """Search, store the best parameters, read them back, merge the fixed ones, refit, forecast."""
    best = score.best_first(_best_of_search(spark, sf)[0], "rmse", ["config_id"])
    names = ["config_id", *SEARCH.names, "rmse"]
    stored = search.store_and_reload(spark, search.wide(search.tall(best, names), names), "best-params")
    stored = search.cast_params(stored, ["config_id", "input_chunk_length", "covariate_lags"])
    (params,) = [r.asDict() for r in search.merge_params(stored, {"horizon": 24}).collect()]  # one row
    table = _table(spark, sf, static=True)
    model = _global(
        table,
        inputs=((params["input_chunk_length"], params["covariate_lags"]),),
        penalties=(params["ridge"],),
        horizon=params["horizon"],
    )
    rows = _run(table, model, [model.folds])
    config = F.lit(params["config_id"]).cast("long").alias("config_id")
    return rows.select("unique_id", "ds", "step", config, F.col("yhat").alias("forecast"))


def _importance(spark, sf, by):
    t = _table(spark, sf, static=True)
    return forecast.importance(t.grid, KEYS, _global(t), by).select(by, "loss_rise")


@query()
def feature_importance(spark, sf):
    """Loss added by permuting each variable of the global forecaster."""
    return _importance(spark, sf, "variable")


@query()
def lag_importance(spark, sf):
    """Loss added by permuting everything seen at each lag."""
    return _importance(spark, sf, "lag")


_RISE = ctes(ELEC, GRID, _ONE_LAG.replace("fit AS (\n  SELECT win.unique_id,", "fit AS (\n  SELECT").replace("GROUP BY ALL", "GROUP BY f.f, step"))


def _one_lag_importance(spark, sf, by):
    t = forecast.model_table(tables.electricity(spark, sf), None, ELECTRICITY)
    rows = forecast.importance(t.grid, KEYS, WindowModel(inputs=((1, 1),), penalties=(0.5,)), by)
    return rows.select(by, r6("loss_rise").alias("loss_rise"))


@query(_RISE + f"SELECT 'y' AS variable, {q6('sum(2 * w * c)')} AS loss_rise FROM fit WHERE fold = 10")
def feature_importance_one_lag(spark, sf):
    """Permuting the only input costs twice weight times covariance, summed over steps."""
    return _one_lag_importance(spark, sf, "variable")


@query(_RISE + f"SELECT CAST(0 AS BIGINT) AS lag, {q6('sum(2 * w * c)')} AS loss_rise FROM fit WHERE fold = 10")
def lag_importance_one_lag(spark, sf):
    return _one_lag_importance(spark, sf, "lag")


def _features(spark, sf):
    return numbered_features(tables.discharge(spark, sf))


@query()
def gbt_cycle_targets(spark, sf):
    """Duration and capacity of the next cycle from boosted trees."""
    return battery_models.boosted_trees(_features(spark, sf), TARGETS)[0]


@query()
def sequence_regression(spark, sf):
    """Duration and capacity of the next cycle from the last three."""
    return battery_models.sequence_regression(_features(spark, sf), FEATS, TARGETS, 3)


_PAIRS = ", ".join(f"b.{t} AS y_{t}" for t in TARGETS)
_FITS = " UNION ALL ".join(
    f"""SELECT battery_id, '{t}' AS target, avg(x) AS mx, avg(y_{t}) AS my,
  covar_pop(x, y_{t}) / (var_pop(x) * (1 + 0.01e0)) AS w FROM pairs GROUP BY battery_id"""
    for t in TARGETS
)


@query(
    ctes(DISCHARGE, FEATURES, f"""pairs AS (
  SELECT a.battery_id, a.time_total AS x, {_PAIRS} FROM featp a JOIN featp b ON a.battery_id = b.battery_id AND b.pos = a.pos + 1)""", f"fit AS ({_FITS})")
    + f"""SELECT fit.battery_id, last.discharge_cycle_id + 1 AS discharge_cycle_id, target, {q6('my + w * (last.time_total - mx)')} AS yhat
FROM fit JOIN featp last ON last.battery_id = fit.battery_id AND last.pos = last.n - 1"""
)
def sequence_regression_one(spark, sf):
    """Next cycle from one value of the last one: the closed form of the sequence model."""
    rows = battery_models.sequence_regression(_features(spark, sf), ("time_total",), TARGETS, 1)
    return rows.withColumn("yhat", r6("yhat"))


@query()
def arimax_by_cycle(spark, sf):
    return battery_models.arimax_by_cycle(tables.discharge(spark, sf))


@query()
def additive_by_cycle(spark, sf):
    return battery_models.additive_by_cycle(tables.discharge(spark, sf))


@query()
def additive_changepoints(spark, sf):
    """The additive model with changepoints selected by an L1 penalty per cycle."""
    return changepoints.additive_changepoints(tables.discharge(spark, sf))


_TARGET_NAMES = ", ".join(f"('{t}')" for t in battery_models.TARGETS)


@query(
    ctes(DISCHARGE, """c AS (SELECT battery_id, cycle, count(*) AS n FROM discharge GROUP BY battery_id, cycle),
h AS (SELECT battery_id, cycle, CAST(sum(n) OVER (PARTITION BY battery_id ORDER BY cycle
  ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS BIGINT) AS n_rows FROM c)""")
    + f"""SELECT battery_id, cycle, target, CAST(p.k AS BIGINT) AS penalty_id, n_rows, true AS optimal
FROM h, (VALUES {_TARGET_NAMES}) t(target), range({len(changepoints.SHARES)}) p(k) WHERE n_rows > 0"""
)
def changepoint_path(spark, sf):
    """Every cycle, target and penalty has a model that meets the conditions of the minimum."""
    targets = battery_models.TARGETS
    rows = changepoints.additive_rows(tables.discharge(spark, sf), targets, battery_models.EXOG)
    found = changepoints.models(rows, "x", "y", changepoints.TREND_KNOTS)
    target = F.element_at(F.array(*[F.lit(t) for t in targets]), F.col("step").cast("int"))
    return found.select(
        "battery_id", "cycle", target.alias("target"), "penalty_id", "n_rows", (F.col("gap") < 1e-9).alias("optimal")
    )


# One knot in the middle of a battery's time span, at two fifths of the penalty that keeps it out.
_SHARE = 0.4


@query(
    ctes(DISCHARGE, """span AS (
  SELECT battery_id, min(epoch_us(datetime_)) AS t0, max(epoch_us(datetime_)) AS t1 FROM discharge GROUP BY battery_id),
x AS (
  SELECT d.battery_id, d.cycle, d.event_id, d.Voltage_measured AS y, (epoch_us(datetime_) - t0) / 86400e6 AS t,
    greatest(0e0, (epoch_us(datetime_) - t0) / 86400e6 - 0.5e0 * (t1 - t0) / 86400e6) AS k
  FROM discharge d JOIN span USING (battery_id)),
cyc AS (SELECT DISTINCT battery_id, cycle FROM x),
h AS (
  SELECT c.battery_id, c.cycle, avg(y) AS my, avg(t) AS mt, avg(k) AS mk, avg(k * k) AS kk, var_pop(t) AS tt,
    covar_pop(t, y) AS ty, covar_pop(k, y) AS ky, covar_pop(t, k) AS tk, var_pop(k) AS vk
  FROM cyc c JOIN x ON x.battery_id = c.battery_id AND x.cycle < c.cycle GROUP BY c.battery_id, c.cycle),
w AS (
  SELECT *, CASE WHEN vk > 1e-10 * kk AND 1 - tk * tk / (tt * vk) > 1e-9
    THEN (1 - 0.4e0) * (ky - tk * ty / tt) / (vk - tk * tk / tt) ELSE 0 END AS wk FROM h)""")
    + f"""SELECT x.battery_id, x.cycle, x.event_id, {q6('my + (ty - wk * tk) / tt * (t - mt) + wk * (k - mk)')} AS yhat
FROM x LEFT JOIN w ON w.battery_id = x.battery_id AND w.cycle = x.cycle"""
)
def changepoint_one_knot(spark, sf):
    """A trend with one penalised knot per cycle: the closed form of the selection."""
    d = tables.discharge(spark, sf)
    micros = lambda c: F.unix_micros(F.col(c).cast("timestamp"))
    span = d.groupBy("battery_id").agg(F.min("datetime_").alias("_t0"), F.max("datetime_").alias("_t1"))
    t = (micros("datetime_") - micros("_t0")) / 86400e6
    knot = F.greatest(F.lit(0.0), t - 0.5 * (micros("_t1") - micros("_t0")) / 86400e6)
    rows = d.join(span, "battery_id").select(
        "battery_id", "cycle", "event_id", F.array(t, knot).alias("x"), F.array("Voltage_measured").alias("y")
    )
    found = changepoints.models(rows, "x", "y", slice(1, 2), ridge=0.0, shares=(_SHARE,))
    out = battery_models.with_models(rows.drop("y"), found.select("battery_id", "cycle", "step", "w"), "x", ("Voltage",), "battery_id")
    return out.select("battery_id", "cycle", "event_id", r6("yhat").alias("yhat"))


@query()
def capacity_next(spark, sf):
    return battery_models.capacity_next(tables.discharge(spark, sf))


_STARTS = """rown AS (
  SELECT *, row_number() OVER (PARTITION BY battery_id ORDER BY datetime_, event_id) - 1 AS pos FROM discharge),
starts AS (SELECT battery_id, cycle, min(pos) AS m FROM rown GROUP BY battery_id, cycle)"""


@query(
    ctes(DISCHARGE, _STARTS, """pair AS (
  SELECT b.battery_id, b.pos, a.Voltage_measured AS x, b.Voltage_measured AS y
  FROM rown a JOIN rown b ON a.battery_id = b.battery_id AND b.pos = a.pos + 1),
fit AS (
  SELECT s.battery_id, s.cycle, s.m, avg(x) AS mx, avg(y) AS my,
    CASE WHEN var_pop(x) > 1e-9 * avg(x * x) THEN covar_pop(x, y) / (var_pop(x) * (1 + 0.01e0)) ELSE 0 END AS w
  FROM starts s JOIN pair p ON p.battery_id = s.battery_id AND p.pos <= s.m - 2 WHERE s.m >= 3 GROUP BY ALL)""")
    + f"""SELECT s.battery_id, s.cycle, CAST(CASE WHEN s.m >= 3 THEN 1 END AS BIGINT) AS length,
  {q6('my + w * (r.Voltage_measured - mx)')} AS yhat
FROM starts s LEFT JOIN fit f ON f.battery_id = s.battery_id AND f.cycle = s.cycle
LEFT JOIN rown r ON r.battery_id = s.battery_id AND r.pos = s.m - 1"""
)
def next_value_one_lag(spark, sf):
    """The next voltage of each cycle from the value before it: the closed form of the sequence model."""
    rows = battery_models.capacity_next(tables.discharge(spark, sf), target="Voltage_measured", exog=(), length=1)
    return rows.select("battery_id", "cycle", "length", r6("yhat").alias("yhat"))


@query(
    ctes(DISCHARGE, _STARTS)
    + """SELECT battery_id, cycle, CAST(CASE WHEN m >= 3 THEN least(150, (m - 1) // 2) END AS BIGINT) AS length,
  m >= 3 AS predicted FROM starts"""
)
def capacity_next_lengths(spark, sf):
    """How long the sequences are that each cycle's history allows."""
    rows = battery_models.capacity_next(tables.discharge(spark, sf), exog=(), length=150)
    return rows.select("battery_id", "cycle", "length", F.col("yhat").isNotNull().alias("predicted"))


# --- histories of the last cycles only

_LAST = 3
_RANKED = """ranked AS (
  SELECT *, dense_rank() OVER (PARTITION BY battery_id ORDER BY cycle) AS r FROM discharge)"""


@query(
    ctes(DISCHARGE, _RANKED, "cyc AS (SELECT DISTINCT battery_id, cycle, r FROM ranked)")
    + f"""SELECT c.battery_id, c.cycle, h.cycle AS history_cycle, h.event_id, h.Capacity
FROM cyc c JOIN ranked h ON h.battery_id = c.battery_id AND h.r BETWEEN c.r - {_LAST} AND c.r - 1"""
)
def history_last_k_cycles(spark, sf):
    """The rows each cycle may learn from, if it looks back three cycles."""
    rows = tables.discharge(spark, sf).select("battery_id", "cycle", "event_id", "Capacity")
    rows = sequences.history_rows(rows, ["battery_id"], "cycle", _LAST)
    return rows.select("battery_id", "cycle", "history_cycle", "event_id", "Capacity")


@query(
    ctes(DISCHARGE, _RANKED, "cyc AS (SELECT DISTINCT battery_id, cycle, r FROM ranked)", f"""fit AS (
  SELECT c.battery_id, c.cycle, avg(h.Temperature_measured) AS mx, avg(h.Voltage_measured) AS my,
    CASE WHEN var_pop(h.Temperature_measured) > 1e-9 * avg(h.Temperature_measured * h.Temperature_measured)
      THEN covar_pop(h.Temperature_measured, h.Voltage_measured) / (var_pop(h.Temperature_measured) * (1 + 0.001e0)) ELSE 0 END AS w
  FROM cyc c JOIN ranked h ON h.battery_id = c.battery_id AND h.r BETWEEN c.r - {_LAST} AND c.r - 1 GROUP BY ALL)""")
    + f"""SELECT d.battery_id, d.cycle, d.event_id, {q6('my + w * (d.Temperature_measured - mx)')} AS yhat
FROM discharge d LEFT JOIN fit ON fit.battery_id = d.battery_id AND fit.cycle = d.cycle"""
)
def regression_last_k_cycles(spark, sf):
    """A regression per cycle on the last three cycles, from differences of cumulated sums."""
    rows = battery_models.regression_by_cycle(
        tables.discharge(spark, sf), targets=("Voltage_measured",), exog=("Temperature_measured",), max_history=_LAST
    )
    return rows.select("battery_id", "cycle", "event_id", r6("yhat").alias("yhat"))


@query(
    ctes(DISCHARGE, f"""c AS (SELECT battery_id, cycle, count(*) AS n, sum(Time) AS t, sum(Capacity) AS c
  FROM discharge GROUP BY battery_id, cycle),
h AS (SELECT battery_id, cycle, sum(t) OVER w / sum(n) OVER w AS ht, sum(c) OVER w / sum(n) OVER w AS hc FROM c
  WINDOW w AS (PARTITION BY battery_id ORDER BY cycle ROWS BETWEEN {_LAST} PRECEDING AND 1 PRECEDING))""")
    + f"""SELECT d.battery_id, d.cycle, d.event_id, {q6('h.ht')} AS "yhat_Time", {q6('h.hc')} AS "yhat_Capacity"
FROM discharge d JOIN h ON d.battery_id = h.battery_id AND d.cycle = h.cycle"""
)
def history_mean_last_k_cycles(spark, sf):
    h = battery_models.history_mean(tables.discharge(spark, sf), max_history=_LAST)
    return h.withColumns({c: r6(c) for c in ("yhat_Time", "yhat_Capacity")})


@query()
def capacity_horizon(spark, sf):
    return battery_models.capacity_horizon(tables.discharge(spark, sf))


@query(
    ctes(DISCHARGE, """c AS (SELECT battery_id, cycle, count(*) AS n, sum(Time) AS t, sum(Capacity) AS c
  FROM discharge GROUP BY battery_id, cycle),
h AS (SELECT battery_id, cycle, sum(t) OVER w / sum(n) OVER w AS ht, sum(c) OVER w / sum(n) OVER w AS hc FROM c
  WINDOW w AS (PARTITION BY battery_id ORDER BY cycle ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING))""")
    + f"""SELECT d.battery_id, d.cycle, d.event_id, {q6('h.ht')} AS "yhat_Time", {q6('h.hc')} AS "yhat_Capacity"
FROM discharge d JOIN h ON d.battery_id = h.battery_id AND d.cycle = h.cycle"""
)
def first_cycle_null(spark, sf):
    h = battery_models.history_mean(tables.discharge(spark, sf))
    return h.withColumns({c: r6(c) for c in ("yhat_Time", "yhat_Capacity")})


# Daily series of many users: 3 folds of a week. A fold is predicted if its history holds a
# window and a training sample, or the season before it.
_WEEK, _LAGS, _FOLDS = 7, 14, 3
_FRAME = f"""len AS (SELECT unique_id, date_diff('day', min(ds), max(ds)) + 1 AS n FROM by_user GROUP BY unique_id),
frame AS (
  SELECT unique_id, n, CAST(f.f AS BIGINT) AS fold, CAST(s.s AS BIGINT) AS step, n - ({_FOLDS} - f.f) * {_WEEK} AS origin
  FROM len, range({_FOLDS}) f(f), range(1, {_WEEK + 1}) s(s))"""
_REASON = "CASE WHEN {ok} THEN NULL WHEN origin <= 0 THEN 'the origin lies before the series' ELSE 'the history is too short' END"


def _by_user(spark, sf):
    spec = replace(ELECTRICITY, step=86400)
    return forecast.model_table(tables.electricity_by_user(spark, sf), None, spec, calendar_names=("dayofweek",), holdout=_FOLDS * _WEEK)


@query(
    ctes(USERS, _FRAME)
    + f"""SELECT unique_id, fold, step, origin >= {_LAGS + _WEEK} AS predicted,
  {_REASON.format(ok=f'origin >= {_LAGS + _WEEK}')} AS reason FROM frame"""
)
def forecast_coverage_by_user(spark, sf):
    """Which series, folds and steps the per-series forecaster can predict."""
    t = _by_user(spark, sf)
    model = WindowModel(local=True, inputs=((_LAGS, 1),), horizon=_WEEK, folds=_FOLDS, penalties=(1.0,))
    rows = _run(t, model, range(_FOLDS))
    return rows.select("unique_id", "fold", "step", F.col("yhat").isNotNull().alias("predicted"), "reason")


@query(
    ctes(USERS, f"""g0 AS (
  SELECT unique_id, unnest(generate_series(min(ds), max(ds), INTERVAL 1 DAY)) AS ds FROM by_user GROUP BY unique_id),
grid AS (
  SELECT g.unique_id, g.ds, coalesce(u.y, 0e0) AS y0, row_number() OVER (PARTITION BY g.unique_id ORDER BY g.ds) - 1 AS pos,
         count(*) OVER (PARTITION BY g.unique_id) AS n
  FROM g0 g LEFT JOIN by_user u ON g.unique_id = u.unique_id AND g.ds = u.ds),
win AS (
  SELECT a.unique_id, a.pos, a.n, b.pos - a.pos AS step, a.y0 AS x, b.y0 AS y
  FROM grid a JOIN grid b ON a.unique_id = b.unique_id AND b.pos BETWEEN a.pos + 1 AND a.pos + {_WEEK}),
fit AS (
  SELECT win.unique_id, f.f AS fold, step, avg(x) AS mx, avg(y) AS my,
         CASE WHEN var_pop(x) > 1e-9 * avg(x * x) THEN covar_pop(x, y) / (var_pop(x) * (1 + 0.5e0)) ELSE 0 END AS w
  FROM win JOIN range({_FOLDS + 1}) f(f) ON win.pos + {_WEEK} <= win.n - ({_FOLDS} - f.f) * {_WEEK} - 1 GROUP BY ALL)""")
    + f"""SELECT fit.unique_id, CAST(fold AS BIGINT) AS fold, CAST(step AS BIGINT) AS step, round(my + w * (g.y0 - mx) + 1e-7, 3) AS yhat
FROM fit JOIN grid g ON g.unique_id = fit.unique_id AND g.pos = g.n - ({_FOLDS} - fold) * {_WEEK} - 1"""
)
def backtest_one_lag_by_user(spark, sf):
    """A one-lag model for each of many short series, fitted where the series lies."""
    t = _by_user(spark, sf)
    model = WindowModel(local=True, inputs=((1, 1),), horizon=_WEEK, folds=_FOLDS, penalties=(0.5,))
    rows = forecast.unscaled(forecast.forecasts(t, model, range(_FOLDS + 1)), t)
    return rows.select("unique_id", "fold", "step", F.round(F.col("yhat") + 1e-7, 3).alias("yhat"))


@query()
def backtest_window_by_user(spark, sf):
    """Rolling-origin error of a window model for each of many short series."""
    t = _by_user(spark, sf)
    model = WindowModel(
        past=ELECTRICITY.past, calendar=t.calendar, local=True, inputs=((_LAGS, 3),), horizon=_WEEK, folds=_FOLDS, penalties=(1.0,)
    )
    rows = _run(t, model, range(_FOLDS))
    n = rows.groupBy("fold").agg(F.count(F.lit(1)).alias("n_points"), F.count("yhat").alias("n_scored"))
    seen = score.align(rows.filter("yhat IS NOT NULL"), t.history, KEYS, "ds", "y")
    return n.join(score.errors(seen, ["fold"]).drop("n_points"), "fold", "left")


@query(
    ctes(USERS, _FRAME, """days AS (
  SELECT f.unique_id, f.fold, f.step, f.origin, u.y, f.origin + f.step - 1 - 7 AS back,
         f.origin + f.step - 1 - 7 >= 0 AS ok
  FROM frame f JOIN (SELECT unique_id, min(ds) AS t0 FROM by_user GROUP BY unique_id) s ON s.unique_id = f.unique_id
  LEFT JOIN by_user u ON u.unique_id = f.unique_id AND u.ds = s.t0 + to_days(CAST(f.origin + f.step - 8 AS INT)))""")
    + f"""SELECT unique_id, fold, step, CASE WHEN ok THEN {q6('coalesce(y, 0)')} END AS yhat,
  {_REASON.format(ok='ok')} AS reason FROM days"""
)
def backtest_coverage_by_user(spark, sf):
    """Weekly-naive forecasts of every series, fold and step, with a reason for each gap."""
    users = tables.electricity_by_user(spark, sf)
    g = series.regularise(users.select("unique_id", "ds", "y"), KEYS, "ds", 86400, fill="zero")
    got = backtest.seasonal_naive(
        g, KEYS, "y", [{"config_id": 0, "season": _WEEK, "depth": 1}], horizon=_WEEK, folds=_FOLDS
    )
    lengths = g.groupBy("unique_id").agg(F.max("n").alias("n"))
    rows = backtest.covered(got.select(*KEYS, "fold", "step", "yhat"), lengths, KEYS, horizon=_WEEK, folds=_FOLDS)
    return rows.select("unique_id", "fold", "step", r6("yhat").alias("yhat"), "reason")


USER_SEARCH = search.ParamGrid(
    {"input_chunk_length": [7, 14], "covariate_lags": [1, 10], "ridge": [0.1, 1.0]}
)


def _user_search(spark, sf):
    """All configurations of a small grid over many short series."""
    configs = USER_SEARCH.all_configs()
    t = _by_user(spark, sf)
    model = WindowModel(
        past=ELECTRICITY.past, calendar=t.calendar, horizon=_WEEK, folds=_FOLDS, **_searched(USER_SEARCH, configs)
    )
    return configs, t, _search(spark, USER_SEARCH, configs, t, model)[1]


# Names in sorted order, the last one fastest.
_CONFIGS = """cfg AS (
  SELECT CAST(range AS BIGINT) AS config_id, CASE WHEN range % 4 < 2 THEN 7 ELSE 14 END AS lags, CASE WHEN range < 4 THEN 1 ELSE 10 END AS cov
  FROM range(8))"""


@query(
    ctes(USERS, _FRAME, _CONFIGS, "longest AS (SELECT fold, max(origin) AS most FROM frame GROUP BY fold)")
    + f"""SELECT config_id, unique_id, fold,
  bool_and(origin >= greatest(lags, cov) AND most >= greatest(lags, cov) + {_WEEK}) AS predicted, count(*) AS n_points
FROM frame JOIN longest USING (fold), cfg GROUP BY config_id, unique_id, fold"""
)
def random_search_coverage(spark, sf):
    """Which series and folds each configuration of a search predicts."""
    rows = _user_search(spark, sf)[2].groupBy("config_id", "unique_id", "fold").agg(
        (F.count("yhat") == F.count(F.lit(1))).alias("predicted"), F.count(F.lit(1)).alias("n_points")
    )
    return rows


@query()
def random_search_by_user(spark, sf):
    """Scores of a search over many series, some too short for some configurations."""
    configs, t, found = _user_search(spark, sf)
    return _search_scores(configs, t, found)


@query(
    ctes(USERS)
    + """SELECT unique_id, count(*) AS n_seen, (epoch(max(ds)) - epoch(min(ds)))::BIGINT // min(gap) + 1 AS n, min(gap) AS step_seconds
FROM (SELECT *, (epoch(ds) - epoch(lag(ds) OVER (PARTITION BY unique_id ORDER BY ds)))::BIGINT AS gap FROM by_user)
GROUP BY unique_id HAVING count(*) > 1"""
)
def series_auto_step(spark, sf):
    """Grids whose step is inferred per series."""
    users = tables.electricity_by_user(spark, sf).select("unique_id", "ds", "y")
    g = series.regularise(users, KEYS, "ds", None)
    d = g.groupBy("unique_id").agg(
        F.count("y").alias("n_seen"), F.max("n").alias("n"), F.min("ds").alias("t0"),
        F.min(F.when(F.col("pos") == 1, F.col("ds"))).alias("t1"),
    )
    step = series.seconds_between("t0", "t1")
    return d.filter("n_seen > 1").select("unique_id", "n_seen", "n", step.alias("step_seconds"))


@query()
def battery_predictions(spark, sf):
    """All per-cycle models in one table."""
    return battery_models.predictions(tables.discharge(spark, sf))


_HISTORY = """c AS (SELECT battery_id, cycle, count(*) AS n, sum(Time) AS t, sum(Capacity) AS c
  FROM discharge GROUP BY battery_id, cycle),
h AS (SELECT battery_id, cycle, sum(t) OVER w / sum(n) OVER w AS ht, sum(c) OVER w / sum(n) OVER w AS hc FROM c
  WINDOW w AS (PARTITION BY battery_id ORDER BY cycle ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
e AS (
  SELECT d.battery_id, d.cycle, 'Time' AS target, d.Time - h.ht AS err FROM discharge d JOIN h USING (battery_id, cycle)
  UNION ALL
  SELECT d.battery_id, d.cycle, 'Capacity', d.Capacity - h.hc FROM discharge d JOIN h USING (battery_id, cycle))"""


@query(
    ctes(DISCHARGE, _HISTORY)
    + f"""SELECT battery_id, target, 'history mean' AS model, cycle, count(*) AS n_points, count(err) AS n_scored,
  {q6('sqrt(avg(err * err))')} AS rmse FROM e GROUP BY battery_id, target, cycle"""
)
def battery_scores(spark, sf):
    """Error of the history mean by battery, target and cycle; the first cycle stays, as null."""
    d = tables.discharge(spark, sf)
    names = F.array(
        *[F.struct(F.lit(t).alias("target"), F.col(f"yhat_{t}").alias("yhat")) for t in battery_models.TARGETS]
    )
    mean = battery_models.history_mean(d).select("battery_id", "cycle", "event_id", F.inline(names))
    found = mean.withColumn("model", F.lit("history mean"))
    return battery_models.prediction_scores(found, d).withColumn("rmse", r6("rmse"))
