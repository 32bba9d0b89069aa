"""Queries for aggregation, joins, scores and parameter choice."""

from __future__ import annotations

from pyspark.sql import functions as F

from fadecast.catalog.base import (
    DISCHARGE, ELEC, FEATURES, FUTURE, GRID, NAIVE, SCORED, USERS, ctes, q6, r6,
)
from fadecast.catalog.params import GRID_PARAMS, hourly_grid, scored
from fadecast.operators import clean, score, series
from fadecast.operators.ordered import running
from fadecast.plans import backtest, battery_features, search
from fadecast.sources import tables

QUERIES, ORACLES = {}, {}
DAILY = [{"config_id": 0, "season": 24, "depth": 1}]


def query(sql):
    def add(fn):
        QUERIES[fn.__name__] = fn
        if sql:
            ORACLES[fn.__name__] = sql
        return fn

    return add


def naive(spark, sf):
    return backtest.seasonal_naive(hourly_grid(spark, sf), ["unique_id"], "y0", DAILY).drop("config_id")


@query(ctes(ELEC, GRID, NAIVE) + f"SELECT unique_id, ds, fold, step, {q6('actual')} AS actual, {q6('yhat')} AS yhat FROM naive")
def align_forecast_actual(spark, sf):
    f = naive(spark, sf).drop("actual")
    a = score.align(f, hourly_grid(spark, sf), ["unique_id"], "ds", "y0")
    return a.select("unique_id", "ds", "fold", "step", r6("actual").alias("actual"), r6("yhat").alias("yhat"))


@query(
    ctes(DISCHARGE, """c AS (SELECT battery_id, cycle, count(*) AS n, sum(Voltage_measured) AS v,
  sum(Temperature_measured) AS t FROM discharge GROUP BY battery_id, cycle)""")
    + f"""SELECT battery_id, cycle, CAST(n AS BIGINT) AS n_future, CAST(coalesce(h, 0) AS BIGINT) AS n_history,
  {q6('hv')} AS history_voltage, {q6('ht')} AS history_temperature FROM (
  SELECT *, sum(n) OVER w AS h, sum(v) OVER w AS hv, sum(t) OVER w AS ht FROM c
  WINDOW w AS (PARTITION BY battery_id ORDER BY cycle ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING))"""
)
def history_before_cycle(spark, sf):
    per = tables.discharge(spark, sf).groupBy("battery_id", "cycle").agg(
        F.count(F.lit(1)).alias("n_future"),
        F.sum("Voltage_measured").alias("_v"),
        F.sum("Temperature_measured").alias("_t"),
    )
    h = running(
        per, ["battery_id"], "cycle",
        {"n_history": ("sum", F.col("n_future")), "_hv": ("sum", F.col("_v")), "_ht": ("sum", F.col("_t"))},
        inclusive=False,
    )
    return h.select(
        "battery_id", "cycle", "n_future", F.coalesce("n_history", F.lit(0)).cast("long").alias("n_history"),
        r6("_hv").alias("history_voltage"), r6("_ht").alias("history_temperature"),
    )


_CFG = """cfg AS (
  SELECT CAST(b.i * 4 + d.i * 2 + s.i AS BIGINT) AS config_id, b.v AS batch_size, d.v AS depth, s.v AS season
  FROM (VALUES (0, 32), (1, 64)) b(i, v), (VALUES (0, 1), (1, 2)) d(i, v),
       (VALUES (0, 24), (1, 168)) s(i, v))"""
_LEN = "len AS (SELECT unique_id, max(n) AS n FROM grid GROUP BY unique_id)"


@query(
    ctes(ELEC, GRID, _LEN, _CFG)
    + """SELECT l.unique_id, CAST(f.f AS BIGINT) AS fold, CAST(l.n - 240 + 24 * f.f AS BIGINT) AS origin,
  CAST(c.config_id AS BIGINT) AS config_id, c.batch_size, c.depth, c.season
FROM len l, range(10) f(f), cfg c"""
)
def search_space(spark, sf):
    folds = backtest.folds_of_series(_lengths(spark, sf))
    return search.with_every_config(folds, GRID_PARAMS).drop("n", "n_train")


def _lengths(spark, sf):
    e = tables.electricity(spark, sf)
    ext = series.time_extents(e, ["unique_id"], "ds")
    n = F.floor(series.seconds_between("_t0", "_t1") / 3600).cast("long") + 1
    return ext.select("unique_id", n.alias("n"))


@query(
    ctes(ELEC, GRID, _LEN, _CFG)
    + """SELECT l.unique_id, CAST(c.config_id AS BIGINT) AS config_id, c.batch_size, c.depth, c.season,
  CAST(l.n - c.season * c.depth - 24 + 1 AS BIGINT) AS n_windows FROM len l, cfg c"""
)
def grid_enumerate(spark, sf):
    g = search.with_every_config(_lengths(spark, sf), GRID_PARAMS)
    w = F.col("n") - F.col("season") * F.col("depth") - backtest.HORIZON + 1
    return g.withColumn("n_windows", w.cast("long")).drop("n")


@query(
    ctes(ELEC, GRID, SCORED)
    + f"SELECT config_id, depth, season, 128 AS batch_size, 24 AS output_chunk_length, {q6('rmse')} AS rmse FROM scored"
)
def merge_params(spark, sf):
    s = search.merge_params(scored(spark, sf), {"batch_size": 128, "output_chunk_length": 24})
    return s.withColumn("rmse", r6("rmse"))


@query("SELECT count(*) AS n_rows FROM events")
def row_count(spark, sf):
    return tables.discharge(spark, sf).agg(F.count(F.lit(1)).alias("n_rows"))


@query("SELECT min(o_orderdate) AS first_ts, max(o_orderdate) AS last_ts FROM orders")
def ts_extent(spark, sf):
    return tables.order_log(spark, sf).agg(F.min("datetime").alias("first_ts"), F.max("datetime").alias("last_ts"))


@query(ctes(ELEC) + "SELECT unique_id, count(*) AS n FROM elec WHERE unique_id IS NOT NULL GROUP BY unique_id")
def value_counts(spark, sf):
    e = tables.electricity(spark, sf).filter(F.col("unique_id").isNotNull())
    return e.groupBy("unique_id").agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "unique_id")


_FEATS = ("voltage_mean", "voltage_min", "voltage_max", "current_mean", "current_max",
          "temperature_mean", "temperature_max", "time_total", "capacity")


@query(
    ctes(DISCHARGE, FEATURES)
    + "SELECT battery_id, discharge_cycle_id, " + ", ".join(f"{q6(c)} AS {c}" for c in _FEATS) + " FROM feat"
)
def cycle_features(spark, sf):
    f = battery_features.cycle_features(tables.discharge(spark, sf))
    return f.select("battery_id", "discharge_cycle_id", *[r6(c).alias(c) for c in _FEATS])


@query(
    ctes(ELEC, GRID, NAIVE)
    + f"""SELECT unique_id, {q6('avg(s)')} AS rmse, count(*) AS n_folds FROM (
  SELECT unique_id, fold, sqrt(avg((actual-yhat)*(actual-yhat))) AS s FROM naive GROUP BY unique_id, fold)
GROUP BY unique_id"""
)
def cv_score(spark, sf):
    e = score.errors(naive(spark, sf), ["unique_id", "fold"])
    return e.groupBy("unique_id").agg(r6(F.avg("rmse")).alias("rmse"), F.count(F.lit(1)).alias("n_folds"))


@query(
    ctes(ELEC, GRID, NAIVE)
    + f"""SELECT unique_id, fold, count(*) AS n_points, {q6('sqrt(avg((actual-yhat)*(actual-yhat)))')} AS rmse,
  {q6('avg(abs(actual-yhat))')} AS mae, {q6('avg(abs(actual-yhat)/nullif(abs(actual), 0e0))')} AS mape
FROM naive GROUP BY unique_id, fold"""
)
def rmse_by_fold(spark, sf):
    e = score.errors(naive(spark, sf), ["unique_id", "fold"])
    return e.withColumns({c: r6(c) for c in ("rmse", "mae", "mape")})


_NESTED = """SELECT {rmse} AS rmse, count(*) AS n_folds FROM (
  SELECT fold, avg(s) AS f FROM (
    SELECT unique_id, fold, sqrt(avg((actual-yhat)*(actual-yhat))) AS s FROM naive GROUP BY unique_id, fold)
  GROUP BY fold)""".format(rmse=q6("avg(f)"))


@query(ctes(ELEC, GRID, NAIVE) + _NESTED)
def rmse_nested(spark, sf):
    return score.nested_rmse(naive(spark, sf), ["unique_id"], "fold").withColumn("rmse", r6("rmse"))


@query(
    ctes(ELEC, GRID, SCORED)
    + f"SELECT config_id, batch_size, depth, season, {q6('rmse')} AS rmse FROM scored"
    " WHERE round(rmse, 9) = (SELECT min(round(rmse, 9)) FROM scored)"
)
def best_ties(spark, sf):
    s = scored(spark, sf).withColumn("rmse", F.round("rmse", 9))
    return score.best_with_ties(s, "rmse").withColumn("rmse", r6("rmse"))


@query(
    ctes(ELEC, GRID, SCORED)
    + f"SELECT config_id, batch_size, depth, season, {q6('rmse')} AS rmse FROM scored"
    " ORDER BY round(scored.rmse, 9), config_id LIMIT 1"
)
def best_first(spark, sf):
    s = scored(spark, sf).withColumn("rmse", F.round("rmse", 9))
    return score.best_first(s, "rmse", ["config_id"]).withColumn("rmse", r6("rmse"))


@query(
    ctes(ELEC, "e AS (SELECT unique_id, count(*) AS n, min(ds) AS first, max(ds) AS last FROM elec GROUP BY unique_id)",
         "g AS (SELECT first, last, min(unique_id) AS group_first_unique_id, count(*) AS group_size FROM e GROUP BY first, last)")
    + "SELECT e.*, g.group_first_unique_id, g.group_size FROM e JOIN g ON e.first = g.first AND e.last = g.last"
)
def series_extents(spark, sf):
    ext = score.extents(tables.electricity(spark, sf), ["unique_id"], "ds")
    return score.shared_extents(ext, ["unique_id"])


@query(
    ctes(USERS, "e AS (SELECT unique_id, count(*) AS n, min(ds) AS first, max(ds) AS last FROM by_user GROUP BY unique_id)",
         "g AS (SELECT first, last, min(unique_id) AS group_first_unique_id, count(*) AS group_size FROM e GROUP BY first, last)")
    + "SELECT e.*, g.group_first_unique_id, g.group_size FROM e JOIN g ON e.first = g.first AND e.last = g.last"
)
def series_extents_by_user(spark, sf):
    ext = score.extents(tables.electricity_by_user(spark, sf), ["unique_id"], "ds")
    return score.shared_extents(ext, ["unique_id"])


@query(
    ctes(ELEC, GRID, NAIVE)
    + """SELECT count(DISTINCT unique_id) AS n_series, count(DISTINCT fold) AS n_folds,
  CAST(count(*) / (count(DISTINCT unique_id) * count(DISTINCT fold)) AS BIGINT) AS points_per_fold FROM naive"""
)
def backtest_shape(spark, sf):
    per = naive(spark, sf).groupBy("unique_id", "fold").agg(F.count(F.lit(1)).alias("_n"))
    return per.agg(
        F.countDistinct("unique_id").alias("n_series"),
        F.countDistinct("fold").alias("n_folds"),
        F.max("_n").alias("points_per_fold"),
    )


@query(
    ctes(ELEC, FUTURE)
    + """SELECT unique_id, ds, Exogenous1, Exogenous2 FROM elec UNION ALL
SELECT unique_id, ds, Exogenous1, Exogenous2 FROM elec_future"""
)
def covariates_full(spark, sf):
    return series.covariates_full(tables.electricity(spark, sf), tables.electricity_future(spark, sf), ["y"])


@query(
    ctes(ELEC, GRID)
    + f"""SELECT unique_id, ds + INTERVAL 24 HOUR AS ds, CAST(pos - n + 25 AS BIGINT) AS step, {q6('y0')} AS yhat
FROM grid WHERE pos >= n - 24"""
)
def forecast_seasonal_naive(spark, sf):
    f = backtest.next_season(hourly_grid(spark, sf), ["unique_id"], "ds", "y0", 24, 3600)
    return f.withColumn("yhat", r6("yhat"))


@query(
    ctes(ELEC, GRID, _LEN)
    + """SELECT unique_id, CAST(n AS BIGINT) AS n, CAST(f AS BIGINT) AS fold, CAST(n - 240 + 24 * f AS BIGINT) AS origin,
  CAST(n - 240 + 24 * f AS BIGINT) AS n_train FROM len, range(10) r(f)"""
)
def backtest_folds(spark, sf):
    return backtest.folds_of_series(_lengths(spark, sf))


@query(
    ctes(ELEC, GRID)
    + """SELECT unique_id, ds, CAST(f AS BIGINT) AS fold, CAST(pos - (n - 240 + 12 * f) + 1 AS BIGINT) AS step
FROM grid, range(19) r(f) WHERE pos >= n - 240 + 12 * f AND pos < n - 240 + 12 * f + 24"""
)
def backtest_fold_rows_overlapping(spark, sf):
    f = backtest.fold_rows(hourly_grid(spark, sf), stride=12)
    return f.select("unique_id", "ds", F.col("fold").cast("long"), "step")


@query(ctes(ELEC, GRID, NAIVE) + _NESTED)
def backtest_naive(spark, sf):
    f = naive(spark, sf).drop("actual")
    a = score.align(f, hourly_grid(spark, sf), ["unique_id"], "ds", "y0")
    return score.nested_rmse(a, ["unique_id"], "fold").withColumn("rmse", r6("rmse"))


@query(
    ctes(ELEC, GRID, NAIVE)
    + f"""SELECT unique_id, ds, 'actual' AS kind, CAST(NULL AS BIGINT) AS fold, {q6('y0')} AS value
FROM grid WHERE ds >= TIMESTAMP '2024-01-15' UNION ALL
SELECT unique_id, ds, 'forecast', fold, {q6('yhat')} FROM naive"""
)
def plot_table(spark, sf):
    g = hourly_grid(spark, sf).filter(clean.time_from("ds", "2024-01-15"))
    a = g.select("unique_id", "ds", F.lit("actual").alias("kind"), F.lit(None).cast("long").alias("fold"),
                 r6("y0").alias("value"))
    f = naive(spark, sf).select("unique_id", "ds", F.lit("forecast").alias("kind"), "fold", r6("yhat").alias("value"))
    return a.unionByName(f)
