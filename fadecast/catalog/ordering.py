"""Queries for positions, splits, sequences and walk-forward folds."""

from __future__ import annotations

from pyspark.sql import functions as F

from fadecast.catalog.base import DISCHARGE, ELEC, FEATURES, GRID, ORDERS, ctes, q6, r6
from fadecast.catalog.params import hourly_grid
from fadecast.operators import clean, sequences, splits
from fadecast.operators.ordered import sorted_positions
from fadecast.plans.battery_features import capacity_fade as fade
from fadecast.plans.battery_features import cycle_features, numbered_features
from fadecast.sources import tables

QUERIES, ORACLES = {}, {}
# Sequence length, its features and targets.
LENGTH = 3
FEATS = ("voltage_mean", "current_mean", "temperature_mean", "time_total", "capacity")
TARGETS = ("time_total", "capacity")


def query(sql):
    def add(fn):
        QUERIES[fn.__name__] = fn
        if sql:
            ORACLES[fn.__name__] = sql
        return fn

    return add


def _features(spark, sf):
    return numbered_features(tables.discharge(spark, sf))


def _measured(spark, sf):
    """Battery rows numbered in time order: ``pos`` and ``n``."""
    d = tables.discharge(spark, sf)
    return sorted_positions(d, ["battery_id"], ["datetime_", "event_id"], total="n")


MEASURED = """meas AS (
  SELECT *, row_number() OVER (PARTITION BY battery_id ORDER BY datetime_, event_id) - 1 AS pos,
         count(*) OVER (PARTITION BY battery_id) AS n FROM discharge)"""


@query(
    ctes(DISCHARGE)
    + """SELECT battery_id, cycle, event_id,
  row_number() OVER (PARTITION BY battery_id, cycle ORDER BY datetime_, event_id) AS time_idx FROM discharge"""
)
def time_idx(spark, sf):
    d = tables.discharge(spark, sf).select("battery_id", "cycle", "datetime_", "event_id")
    p = sorted_positions(d, ["battery_id", "cycle"], ["datetime_", "event_id"])
    return p.select("battery_id", "cycle", "event_id", (F.col("pos") + 1).alias("time_idx"))


@query(
    ctes(DISCHARGE, FEATURES)
    + f"""SELECT battery_id, discharge_cycle_id, {q6('first_value(capacity) OVER (PARTITION BY battery_id ORDER BY discharge_cycle_id) - capacity')}
  AS capacity_fade FROM feat"""
)
def capacity_fade(spark, sf):
    f = fade(cycle_features(tables.discharge(spark, sf)))
    return f.select("battery_id", "discharge_cycle_id", r6("capacity_fade").alias("capacity_fade"))


def _lag_sql(feats, length, order, part="battery_id"):
    cols = []
    for i in range(length):
        for f in feats:
            lagged = f"lag({f}, {length - i}) OVER (PARTITION BY {part} ORDER BY {order})"
            cols.append(f"{q6(lagged)} AS x{i}_{f}")
    return ", ".join(cols)


def _spread(s, feats, length):
    return {k: r6(c) for k, c in sequences.spread("x", feats, length).items()}


@query(
    ctes(DISCHARGE, FEATURES)
    + "SELECT * EXCLUDE (pos) FROM (SELECT battery_id, discharge_cycle_id, pos, "
    + _lag_sql(FEATS, LENGTH, "pos")
    + f", {q6('time_total')} AS y_time_total, {q6('capacity')} AS y_capacity FROM featp) WHERE pos >= {LENGTH}"
)
def sequences_l3(spark, sf):
    s = sequences.sequences(_features(spark, sf), ["battery_id"], "pos", FEATS, LENGTH)
    s = s.withColumns({f"y_{t}": r6(t) for t in TARGETS} | _spread(s, FEATS, LENGTH))
    keep = [f"x{i}_{f}" for i in range(LENGTH) for f in FEATS]
    return s.select("battery_id", "discharge_cycle_id", *keep, *[f"y_{t}" for t in TARGETS])


_ONE = ("Capacity", "Voltage_measured", "Current_measured", "Temperature_measured")


@query(
    ctes(DISCHARGE, MEASURED)
    + "SELECT * EXCLUDE (pos) FROM (SELECT battery_id, event_id, pos, "
    + _lag_sql(_ONE, 5, "pos")
    + f", {q6('Capacity')} AS y FROM meas) WHERE pos >= 5"
)
def sequences_one(spark, sf):
    s = sequences.sequences(_measured(spark, sf), ["battery_id"], "pos", _ONE, 5)
    s = s.withColumns({"y": r6("Capacity")} | _spread(s, _ONE, 5))
    return s.select("battery_id", "event_id", *[f"x{i}_{f}" for i in range(5) for f in _ONE], "y")


@query(
    ctes(DISCHARGE, MEASURED)
    + """SELECT battery_id, event_id, least(20, n - 1) AS seq_len,
  CASE WHEN pos >= n - least(20, n - 1) THEN 'holdout' ELSE 'train' END AS role
FROM meas WHERE pos >= least(20, n - 1)"""
)
def sequence_holdout(spark, sf):
    m = _measured(spark, sf).withColumn("seq_len", sequences.adaptive_length("n"))
    m = m.filter(F.col("pos") >= F.col("seq_len"))
    return m.select(
        "battery_id", "event_id", "seq_len", sequences.hold_out("pos", "n", "seq_len").alias("role")
    )


@query(
    ctes(DISCHARGE, FEATURES)
    + "SELECT battery_id, "
    + ", ".join(
        f"max(CASE WHEN pos = n - {LENGTH - i} THEN {q6(f)} END) AS x{i}_{f}"
        for i in range(LENGTH)
        for f in FEATS
    )
    + " FROM featp GROUP BY battery_id"
)
def latest_window(spark, sf):
    w = sequences.latest_window(_features(spark, sf), ["battery_id"], "pos", "n", FEATS, LENGTH)
    return w.select("battery_id", *[c.alias(k) for k, c in _spread(w, FEATS, LENGTH).items()])


@query(
    ctes(DISCHARGE, FEATURES)
    + f"""SELECT battery_id, pos AS fold, discharge_cycle_id AS test_cycle, pos AS n_train,
  {q6('sc')} AS train_sum_capacity, {q6('st')} AS train_sum_time_total, {q6('capacity')} AS test_capacity FROM (
  SELECT *, sum(capacity) OVER w AS sc, sum(time_total) OVER w AS st FROM featp
  WINDOW w AS (PARTITION BY battery_id ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING))
WHERE pos >= {LENGTH}"""
)
def walk_forward_expanding(spark, sf):
    w = sequences.walk_forward(
        _features(spark, sf), ["battery_id"], "pos", LENGTH, ["capacity", "time_total"]
    )
    return w.select(
        "battery_id",
        F.col("pos").alias("fold"),
        F.col("discharge_cycle_id").alias("test_cycle"),
        "n_train",
        r6("train_sum_capacity").alias("train_sum_capacity"),
        r6("train_sum_time_total").alias("train_sum_time_total"),
        r6("capacity").alias("test_capacity"),
    )


_DEDUP = """d AS (SELECT row_id, datetime, value FROM (
  SELECT *, row_number() OVER (PARTITION BY datetime ORDER BY row_id) AS k FROM order_log) WHERE k = 1)"""
_SIZES = "floor(0.8e0*n)"


def _split_sql(src, gap=0):
    return f"""p AS (SELECT *, row_number() OVER (ORDER BY row_id) - 1 AS pos, count(*) OVER () AS n FROM {src}),
s AS (SELECT * FROM (SELECT *, CASE WHEN pos < floor(0.8e0*n) THEN 'train'
  WHEN pos >= floor(0.8e0*n) + {gap} AND pos < floor(0.8e0*n) + floor(0.1e0*n) THEN 'val'
  WHEN pos >= floor(0.8e0*n) + floor(0.1e0*n) THEN 'test' END AS split FROM p) WHERE split IS NOT NULL)"""


def _dedup(spark, sf):
    return clean.keep_first(tables.order_log(spark, sf), ["datetime"], "row_id")


@query(ctes(ORDERS, _DEDUP, _split_sql("d")) + "SELECT row_id, datetime, value, split FROM s")
def split_80_10_10(spark, sf):
    s = splits.split_by_position(_dedup(spark, sf), [], "row_id")
    return s.select("row_id", "datetime", "value", "split")


@query(ctes(ORDERS, _split_sql("order_log", 1)) + "SELECT row_id, datetime, value, split FROM s")
def split_with_gap(spark, sf):
    s = splits.split_by_position(tables.order_log(spark, sf), [], "row_id", gap=1)
    return s.select("row_id", "datetime", "value", "split")


_BOUNDS = ", ".join(
    f"count(*) FILTER (split = '{s}') AS n_{s}, min(datetime) FILTER (split = '{s}') AS min_{s}, "
    f"max(datetime) FILTER (split = '{s}') AS max_{s}"
    for s in ("train", "val", "test")
)
_EDGE = """max(CASE WHEN pos = floor(0.8e0*n) - 2 THEN datetime END) AS second_last_train,
  arg_min(CASE WHEN split = 'val' THEN datetime END, CASE WHEN split = 'val' THEN pos END) AS first_val"""


@query(ctes(ORDERS, _split_sql("order_log", 1)) + f"SELECT {_BOUNDS}, {_EDGE} FROM s")
def split_boundaries(spark, sf):
    s = splits.split_by_position(tables.order_log(spark, sf), [], "row_id", gap=1)
    return splits.split_boundaries(s, [], "datetime")


@query(
    ctes(
        DISCHARGE,
        """p AS (SELECT battery_id, event_id, datetime_, row_number() OVER (PARTITION BY battery_id ORDER BY datetime_, event_id) - 1 AS pos,
  count(*) OVER (PARTITION BY battery_id) AS n FROM discharge)""",
    )
    + """SELECT battery_id, event_id, CASE WHEN pos < floor(0.8e0*n) THEN 'train'
  WHEN pos < floor(0.8e0*n) + floor(0.1e0*n) THEN 'val' ELSE 'test' END AS split FROM p"""
)
def split_by_time(spark, sf):
    d = tables.discharge(spark, sf).select("battery_id", "event_id", "datetime_")
    s = splits.split_by_position(d, ["battery_id"], "event_id", by_time="datetime_")
    return s.select("battery_id", "event_id", "split")


_LAGS = (1, 2, 24, 168)


@query(
    ctes(ELEC, GRID)
    + f"SELECT unique_id, ds, {q6('y0')} AS y0, "
    + ", ".join(
        f"{q6(f'lag(y0, {k}) OVER (PARTITION BY unique_id ORDER BY ds)')} AS y0_lag{k}" for k in _LAGS
    )
    + " FROM grid"
)
def lag_features(spark, sf):
    g = sequences.lag_features(hourly_grid(spark, sf), ["unique_id"], "pos", ["y0"], _LAGS)
    return g.select("unique_id", "ds", *[r6(c).alias(c) for c in ("y0", *[f"y0_lag{k}" for k in _LAGS])])
