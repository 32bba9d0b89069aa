"""Shared parts of the checked queries: input views for both engines."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F



def r6(c: Column | str) -> Column:
    """Six digits, the same in both engines on exact halves."""
    c = F.col(c) if isinstance(c, str) else c
    return F.round(c + F.lit(1e-10), 6)


def q6(sql: str) -> str:
    return f"round({sql} + 1e-10, 6)"


ELEC = """elec AS (
  SELECT event_type AS unique_id, CAST(date_trunc('hour', ts) AS timestamp) AS ds,
         CAST(sum(CAST(round(value*100e0) AS BIGINT)) AS DOUBLE)/(100e0*count(*)) AS y,
         CAST(count(*) AS DOUBLE) AS Exogenous1,
         CAST(max(CAST(regexp_extract(props,'[0-9]+',0) AS INT)) AS DOUBLE) AS Exogenous2
  FROM events GROUP BY event_type, CAST(date_trunc('hour', ts) AS timestamp))"""

USERS = """by_user AS (
  SELECT CAST(user_id AS VARCHAR) AS unique_id, CAST(date_trunc('day', ts) AS timestamp) AS ds,
         CAST(sum(CAST(round(value*100e0) AS BIGINT)) AS DOUBLE)/(100e0*count(*)) AS y,
         CAST(count(*) AS DOUBLE) AS Exogenous1,
         CAST(max(CAST(regexp_extract(props,'[0-9]+',0) AS INT)) AS DOUBLE) AS Exogenous2
  FROM events GROUP BY CAST(user_id AS VARCHAR), CAST(date_trunc('day', ts) AS timestamp))"""

FUTURE = """elec_future AS (
  SELECT unique_id, ds + INTERVAL '1' DAY AS ds, Exogenous1, Exogenous2
  FROM (SELECT *, max(ds) OVER (PARTITION BY unique_id) AS last FROM elec)
  WHERE ds >= date_trunc('day', last))"""

GRID = """g0 AS (
  SELECT unique_id, unnest(generate_series(min(ds), max(ds), INTERVAL 1 HOUR)) AS ds
  FROM elec GROUP BY unique_id),
grid AS (
  SELECT g.unique_id, g.ds, coalesce(e.y, 0e0) AS y0,
         row_number() OVER (PARTITION BY g.unique_id ORDER BY g.ds) - 1 AS pos,
         count(*) OVER (PARTITION BY g.unique_id) AS n
  FROM g0 g LEFT JOIN elec e ON g.unique_id = e.unique_id AND g.ds = e.ds)"""

DISCHARGE = """discharge AS (
  SELECT event_id, concat('B', CAST(user_id % 4 AS VARCHAR)) AS battery_id,
         CAST(2*day(ts) AS INT) AS cycle, 24e0 AS ambient_temperature,
         CAST(date_trunc('day', ts) AS timestamp) AS datetime, CAST(ts AS timestamp) AS datetime_,
         2e0 + value/250e0 AS Voltage_measured,
         -CAST(regexp_extract(props,'[0-9]+',0) AS INT)/50e0 AS Current_measured,
         24e0 + CAST(regexp_extract(props,'[0-9]+',0) AS INT)/5e0 AS Temperature_measured,
         CAST(hour(ts)*3600 + minute(ts)*60 + floor(second(ts)) AS DOUBLE) AS Time,
         2e0 - 0.01e0*day(ts) - 0.001e0*(user_id % 4) AS Capacity
  FROM events)"""

FEATURES = """feat AS (
  SELECT battery_id, CAST(floor(cycle/2) AS BIGINT) AS discharge_cycle_id,
         avg(Voltage_measured) AS voltage_mean, min(Voltage_measured) AS voltage_min,
         max(Voltage_measured) AS voltage_max, avg(Current_measured) AS current_mean,
         max(Current_measured) AS current_max, avg(Temperature_measured) AS temperature_mean,
         max(Temperature_measured) AS temperature_max, max(Time) AS time_total,
         max(Capacity) AS capacity
  FROM discharge GROUP BY battery_id, CAST(floor(cycle/2) AS BIGINT)),
featp AS (
  SELECT *, row_number() OVER (PARTITION BY battery_id ORDER BY discharge_cycle_id) - 1 AS pos,
         count(*) OVER (PARTITION BY battery_id) AS n FROM feat)"""

ORDERS = """order_log AS (
  SELECT o_orderkey AS row_id, o_orderdate AS datetime, o_totalprice AS value FROM orders)"""

# Daily-naive back-test: 10 folds of 24 rows, rows of the test range only.
NAIVE = """lagged AS (
  SELECT *, lag(y0, 24) OVER (PARTITION BY unique_id ORDER BY ds) AS l24 FROM grid),
naive AS (
  SELECT unique_id, ds, pos, n, y0 AS actual, l24 AS yhat,
         CAST(floor((pos - (n - 240)) / 24e0) AS BIGINT) AS fold,
         CAST((pos - (n - 240)) % 24 + 1 AS BIGINT) AS step
  FROM lagged WHERE pos >= n - 240)"""

# Scores of the seasonal-naive grid: season 24 / 168, depth 1 / 2, and a batch
# size that has no influence, so that best configurations tie.
SCORED = """lags AS (
  SELECT *, lag(y0, 24) OVER w AS l24, lag(y0, 48) OVER w AS l48,
         lag(y0, 168) OVER w AS l168, lag(y0, 336) OVER w AS l336,
         CAST(floor((pos - (n - 240)) / 24e0) AS BIGINT) AS fold
  FROM grid WINDOW w AS (PARTITION BY unique_id ORDER BY ds)),
cfg AS (
  SELECT CAST(b.i * 4 + d.i * 2 + s.i AS BIGINT) AS config_id, b.v AS batch_size, d.v AS depth, s.v AS season
  FROM (VALUES (0, 32), (1, 64)) b(i, v), (VALUES (0, 1), (1, 2)) d(i, v),
       (VALUES (0, 24), (1, 168)) s(i, v)),
pts AS (
  SELECT c.config_id, l.unique_id, l.fold, l.y0 AS actual,
         CASE WHEN c.season = 24 AND c.depth = 1 THEN l24
              WHEN c.season = 24 THEN (l24 + l48) / 2
              WHEN c.depth = 1 THEN l168 ELSE (l168 + l336) / 2 END AS yhat
  FROM lags l, cfg c WHERE l.pos >= l.n - 240),
scored AS (
  SELECT c.config_id, c.batch_size, c.depth, c.season, t.rmse FROM cfg c JOIN (
    SELECT config_id, avg(f) AS rmse FROM (
      SELECT config_id, fold, avg(s) AS f FROM (
        SELECT config_id, fold, unique_id, sqrt(avg((actual - yhat) * (actual - yhat))) AS s
        FROM pts GROUP BY config_id, fold, unique_id) GROUP BY config_id, fold)
    GROUP BY config_id) t ON c.config_id = t.config_id)"""


def ctes(*parts: str) -> str:
    return "WITH " + ",\n".join(parts) + "\n"
