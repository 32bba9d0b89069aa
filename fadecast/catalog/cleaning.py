"""Queries for sources, sinks, projection, filters and cleaning."""

from __future__ import annotations

from pyspark.sql import functions as F

from fadecast.catalog.base import DISCHARGE, ELEC, FUTURE, ORDERS, SCORED, GRID, ctes, q6, r6
from fadecast.catalog.params import GRID_PARAMS, scored
from fadecast.operators import clean
from fadecast.operators.ordered import positions
from fadecast.operators.score import best_first
from fadecast.operators.splits import split_by_position
from fadecast.plans import search
from fadecast.session import shared_path
from fadecast.sources import files, tables

QUERIES, ORACLES = {}, {}


def query(sql):
    def add(fn):
        QUERIES[fn.__name__] = fn
        if sql:
            ORACLES[fn.__name__] = sql
        return fn

    return add


@query(ctes(ELEC) + f"SELECT unique_id, ds, {q6('y')} AS y, Exogenous1, Exogenous2 FROM elec")
def src_csv_roundtrip(spark, sf):
    path = shared_path(spark, "elec-csv")
    e = tables.electricity(spark, sf)
    files.write_csv(e.select("unique_id", "ds", "y", "Exogenous1", "Exogenous2"), path)
    back = files.read_csv(spark, path, files.ELECTRICITY_SCHEMA)
    return back.withColumn("y", r6("y"))


@query(ctes(ELEC, FUTURE) + "SELECT unique_id, ds, Exogenous1, Exogenous2 FROM elec_future")
def src_future_text_dates(spark, sf):
    path = shared_path(spark, "future-csv")
    f = tables.electricity_future(spark, sf)
    files.write_csv(f.withColumn("ds", F.date_format("ds", files.US_DATES)), path)
    text = files.read_csv(spark, path, files.FUTURE_SCHEMA)
    return text.withColumn("ds", files.parse_time("ds", [files.US_DATES]))


@query("SELECT o_orderkey AS row_id, o_orderdate AS parsed FROM orders")
def parse_ts(spark, sf):
    o = tables.order_log(spark, sf)
    text = F.when(F.col("row_id") % 2 == 0, F.date_format("datetime", "yyyy-MM-dd HH:mm:ss")).otherwise(
        F.date_format("datetime", "yyyy/M/d")
    )
    parsed = files.parse_time(text, ["yyyy-MM-dd HH:mm:ss", "yyyy/M/d"])
    return o.select("row_id", parsed.alias("parsed"))


_SPLIT = """s AS (
  SELECT row_id, datetime, value, pos, n,
         CASE WHEN pos < floor(0.8e0*n) THEN 'train'
              WHEN pos < floor(0.8e0*n) + floor(0.1e0*n) THEN 'val' ELSE 'test' END AS split
  FROM (SELECT *, row_number() OVER (ORDER BY row_id) - 1 AS pos, count(*) OVER () AS n
        FROM (SELECT *, row_number() OVER (PARTITION BY datetime ORDER BY row_id) AS k
              FROM order_log) WHERE k = 1))"""


@query(ctes(ORDERS, _SPLIT) + "SELECT row_id, datetime, value, split FROM s")
def split_parquet_roundtrip(spark, sf):
    path = shared_path(spark, "splits")
    first = clean.keep_first(tables.order_log(spark, sf), ["datetime"], "row_id")
    files.write_splits(
        split_by_position(first, [], "row_id").select("row_id", "datetime", "value", "split"), path
    )
    return files.read_split(spark, path)


_BEST = "best AS (SELECT * FROM scored ORDER BY round(rmse + 1e-10, 9), config_id LIMIT 1)"


def _best(spark, sf):
    return best_first(scored(spark, sf), "rmse", ["config_id"])


@query(
    ctes(ELEC, GRID, SCORED, _BEST)
    + """SELECT 'batch_size' AS key, CAST(batch_size AS DOUBLE) AS value FROM best UNION ALL
SELECT 'depth', CAST(depth AS DOUBLE) FROM best UNION ALL
SELECT 'season', CAST(season AS DOUBLE) FROM best"""
)
def params_tall(spark, sf):
    t = search.tall(_best(spark, sf), [*GRID_PARAMS.names, "rmse"])
    return search.store_and_reload(spark, t, "best-tall").filter(F.col("key") != "rmse")


@query(
    ctes(ELEC, GRID, SCORED, _BEST)
    + "SELECT CAST(batch_size AS DOUBLE) AS batch_size, CAST(depth AS DOUBLE) AS depth,"
    " CAST(season AS DOUBLE) AS season FROM best"
)
def params_wide(spark, sf):
    t = search.tall(_best(spark, sf), [*GRID_PARAMS.names, "rmse"])
    w = search.wide(t, [*GRID_PARAMS.names, "rmse"])
    return search.store_and_reload(spark, w, "best-wide").drop("rmse")


_BATTERY = ", ".join(clean.BATTERY_COLUMNS)


@query(ctes(DISCHARGE) + f"SELECT {_BATTERY} FROM discharge")
def project_battery(spark, sf):
    return tables.discharge(spark, sf).select(*clean.BATTERY_COLUMNS)


@query(ctes(ELEC) + "SELECT ds, Exogenous1, Exogenous2 FROM elec")
def project_tail(spark, sf):
    e = tables.electricity(spark, sf).select("unique_id", "ds", "y", "Exogenous1", "Exogenous2")
    return clean.project_tail(e, 3, keep=["ds"])


@query(ctes(ELEC) + "SELECT unique_id, ds, Exogenous1, Exogenous2 FROM elec")
def drop_target(spark, sf):
    return tables.electricity(spark, sf).drop("y")


@query(ctes(ELEC) + f"SELECT unique_id, ds, {q6('y')} AS y FROM elec WHERE unique_id = 'click'")
def filter_series(spark, sf):
    e = tables.electricity(spark, sf).filter(F.col("unique_id") == "click")
    return e.select("unique_id", "ds", r6("y").alias("y"))


@query(
    ctes(ELEC)
    + f"SELECT unique_id, ds, {q6('y')} AS y FROM elec WHERE unique_id IN ('click', 'view')"
)
def filter_isin(spark, sf):
    e = tables.electricity(spark, sf).filter(F.col("unique_id").isin("click", "view"))
    return e.select("unique_id", "ds", r6("y").alias("y"))


@query(
    ctes(ELEC)
    + f"SELECT unique_id, ds, {q6('y')} AS y FROM elec WHERE ds >= TIMESTAMP '2024-01-10 00:00:00'"
    " AND ds <= TIMESTAMP '2024-01-20 23:00:00'"
)
def filter_time_closed(spark, sf):
    e = tables.electricity(spark, sf)
    e = e.filter(clean.time_between("ds", "2024-01-10 00:00:00", "2024-01-20 23:00:00"))
    return e.select("unique_id", "ds", r6("y").alias("y"))


@query(
    ctes(ORDERS) + "SELECT row_id, datetime, value FROM order_log WHERE datetime >= TIMESTAMP '1997-12-01'"
)
def filter_partial_date(spark, sf):
    return tables.order_log(spark, sf).filter(clean.time_from("datetime", "1997-12"))


@query(
    ctes(DISCHARGE)
    + "SELECT event_id, cycle, CAST(floor(cycle/2) AS BIGINT) AS discharge_cycle_id FROM discharge"
)
def discharge_cycle_id(spark, sf):
    d = tables.discharge(spark, sf)
    return d.select("event_id", "cycle", clean.discharge_cycle_id().alias("discharge_cycle_id"))


@query(
    ctes(ELEC, GRID, SCORED)
    + """SELECT config_id, CAST(batch_size AS BIGINT) AS batch_size, CAST(depth AS BIGINT) AS depth,
       CAST(season AS BIGINT) AS season, -CAST(floor(rmse) AS BIGINT) AS rmse_whole,
       CAST(config_id AS VARCHAR) AS config_name FROM scored"""
)
def cast_params(spark, sf):
    s = scored(spark, sf).withColumns({n: F.col(n).cast("double") for n in GRID_PARAMS.names})
    s = search.cast_params(s.withColumn("rmse_whole", -F.col("rmse")), [*GRID_PARAMS.names, "rmse_whole"])
    return s.withColumn("config_name", F.col("config_id").cast("string")).drop("rmse")


@query("SELECT DISTINCT event_type AS unique_id FROM events")
def distinct_ids(spark, sf):
    ids = tables.load(spark, sf, "events").select(F.col("event_type").alias("unique_id"))
    return ids.distinct().orderBy("unique_id")


@query(
    ctes(ORDERS)
    + """SELECT row_id, datetime, value FROM (
  SELECT *, row_number() OVER (PARTITION BY datetime ORDER BY row_id) AS k FROM order_log) WHERE k = 1"""
)
def dedup_keep_first(spark, sf):
    return clean.keep_first(tables.order_log(spark, sf), ["datetime"], "row_id")


_PICKS = {"first": 0, "last": -1, "second_last": -2, "row_196": 196}


@query(
    ctes(ORDERS, "p AS (SELECT *, row_number() OVER (ORDER BY row_id) - 1 AS p, count(*) OVER () AS n FROM order_log)")
    + """SELECT 'first' AS label, row_id, datetime, value FROM p WHERE p = 0 UNION ALL
SELECT 'last', row_id, datetime, value FROM p WHERE p = n - 1 UNION ALL
SELECT 'second_last', row_id, datetime, value FROM p WHERE p = n - 2 UNION ALL
SELECT 'row_196', row_id, datetime, value FROM p WHERE p = 196"""
)
def row_at(spark, sf):
    return clean.rows_at(tables.order_log(spark, sf), [], "row_id", _PICKS)


@query(ctes(ORDERS) + "SELECT row_id, datetime, value FROM order_log ORDER BY row_id LIMIT 5")
def head_n(spark, sf):
    return clean.head(tables.order_log(spark, sf), "row_id", 5)


_TYPES = {
    "unique_id": "string",
    "ds": "timestamp_ntz",
    "y": "double",
    "Exogenous1": "double",
    "Exogenous2": "double",
}


@query(
    ctes(ELEC)
    + " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, count({c}) AS non_null, '{t}' AS dtype FROM elec"
        for c, t in _TYPES.items()
    )
)
def profile_columns(spark, sf):
    return clean.profile(tables.electricity(spark, sf))


def _repair(keys, ordinal, src):
    part = f"PARTITION BY {', '.join(keys)} " if keys else ""
    return f"""f AS (
  SELECT *, CASE WHEN lag(datetime) OVER ({part}ORDER BY {ordinal}) IS DISTINCT FROM datetime
                 THEN 1 ELSE 0 END AS flag FROM {src}),
r AS (SELECT *, sum(flag) OVER ({part}ORDER BY {ordinal}) AS run FROM f),
x AS (SELECT *, row_number() OVER (PARTITION BY {', '.join([*keys, 'run'])} ORDER BY {ordinal}) - 1 AS k FROM r)"""


@query(
    ctes(ORDERS, _repair([], "row_id", "order_log"))
    + "SELECT row_id, datetime, datetime + to_seconds(15 * k) AS repaired FROM x"
)
def repair_timestamps(spark, sf):
    o = tables.order_log(spark, sf).select("row_id", "datetime")
    return clean.repair_timestamps(o, [], "row_id")


@query(
    ctes(DISCHARGE, _repair(["battery_id"], "event_id", "discharge"))
    + "SELECT battery_id, event_id, datetime, datetime + to_seconds(15 * k) AS repaired FROM x"
)
def repair_timestamps_battery(spark, sf):
    d = tables.discharge(spark, sf).select("battery_id", "event_id", "datetime")
    return clean.repair_timestamps(d, ["battery_id"], "event_id")


@query(
    ctes(DISCHARGE)
    + "SELECT battery_id, event_id, row_number() OVER (PARTITION BY battery_id ORDER BY event_id) - 1 AS pos FROM discharge"
)
def file_position(spark, sf):
    d = tables.discharge(spark, sf).select("battery_id", "event_id")
    return positions(d, ["battery_id"], "event_id")
