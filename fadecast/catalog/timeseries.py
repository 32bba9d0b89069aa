"""Queries for grids, encoders, scalers and diagnostics."""

from __future__ import annotations

import math

from pyspark.sql import functions as F

from fadecast.catalog.base import DISCHARGE, ELEC, FUTURE, GRID, USERS, ctes, q6, r6
from fadecast.catalog.params import hourly_grid
from fadecast.functions import calendar
from fadecast.operators import diagnose, scale, series, windows
from fadecast.operators.ordered import sorted_positions
from fadecast.sources import tables

QUERIES, ORACLES = {}, {}


def query(sql):
    def add(fn):
        QUERIES[fn.__name__] = fn
        if sql:
            ORACLES[fn.__name__] = sql
        return fn

    return add


_FILLED = """f0 AS (SELECT unique_id, unnest(generate_series(min(ds), max(ds), INTERVAL 1 {unit})) AS ds
  FROM {src} GROUP BY unique_id),
filled AS (SELECT f.unique_id, f.ds, e.y, e.Exogenous1, e.Exogenous2,
  row_number() OVER (PARTITION BY f.unique_id ORDER BY f.ds) - 1 AS pos,
  count(*) OVER (PARTITION BY f.unique_id) AS n
  FROM f0 f LEFT JOIN {src} e ON f.unique_id = e.unique_id AND f.ds = e.ds)"""
HOURLY = _FILLED.format(unit="HOUR", src="elec")
DAILY = _FILLED.format(unit="DAY", src="by_user")


def _elec(spark, sf, fill="none", values=("y",)):
    e = tables.electricity(spark, sf).select("unique_id", "ds", *values)
    return series.regularise(e, ["unique_id"], "ds", 3600, fill=fill, values=list(values))


@query(ctes(ELEC, HOURLY) + f"SELECT unique_id, ds, {q6('y')} AS y, Exogenous1, Exogenous2 FROM filled")
def asfreq_hourly(spark, sf):
    g = _elec(spark, sf, values=("y", "Exogenous1", "Exogenous2"))
    return g.select("unique_id", "ds", r6("y").alias("y"), "Exogenous1", "Exogenous2")


_GAPS = """gaps AS (SELECT unique_id, date_diff('second', lag(ds) OVER (PARTITION BY unique_id ORDER BY ds), ds) AS gap
  FROM {src}),
least_gap AS (SELECT unique_id, min(gap) AS step_seconds FROM gaps WHERE gap IS NOT NULL GROUP BY unique_id)"""
_INFER = """SELECT l.unique_id, l.step_seconds, CAST(count(*) AS BIGINT) AS n_gaps,
  bool_and(g.gap % l.step_seconds = 0) AS regular
FROM least_gap l JOIN gaps g ON l.unique_id = g.unique_id WHERE g.gap IS NOT NULL
GROUP BY l.unique_id, l.step_seconds"""


@query(ctes(ELEC, _GAPS.format(src="elec")) + _INFER)
def infer_freq(spark, sf):
    return series.infer_step(tables.electricity(spark, sf), ["unique_id"], "ds")


@query(ctes(USERS, _GAPS.format(src="by_user")) + _INFER)
def infer_freq_by_user(spark, sf):
    return series.infer_step(tables.electricity_by_user(spark, sf), ["unique_id"], "ds")


@query(
    ctes(ELEC, HOURLY)
    + f"""SELECT unique_id, ds, {q6('''CASE WHEN y IS NOT NULL THEN y ELSE yb + (ya - yb) * (pos - pb) / (pa - pb) END''')} AS y FROM (
  SELECT unique_id, ds, y, pos,
    last_value(y IGNORE NULLS) OVER b AS yb, last_value(CASE WHEN y IS NOT NULL THEN pos END IGNORE NULLS) OVER b AS pb,
    first_value(y IGNORE NULLS) OVER a AS ya, first_value(CASE WHEN y IS NOT NULL THEN pos END IGNORE NULLS) OVER a AS pa
  FROM filled WINDOW b AS (PARTITION BY unique_id ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW),
    a AS (PARTITION BY unique_id ORDER BY pos ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING))"""
)
def fill_missing_dates(spark, sf):
    return _elec(spark, sf, "linear").select("unique_id", "ds", r6("y").alias("y"))


@query(
    ctes(ELEC, HOURLY)
    + f"""SELECT unique_id, ds, {q6('last_value(y IGNORE NULLS) OVER (PARTITION BY unique_id ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)')} AS y
FROM filled"""
)
def fill_forward(spark, sf):
    return _elec(spark, sf, "ffill").select("unique_id", "ds", r6("y").alias("y"))


@query(
    ctes(USERS, DAILY)
    + f"SELECT unique_id, ds, {q6('y')} AS y, Exogenous1, CAST(pos AS BIGINT) AS pos, CAST(n AS BIGINT) AS n FROM filled"
)
def series_by_group(spark, sf):
    u = tables.electricity_by_user(spark, sf)
    g = series.regularise(u, ["unique_id"], "ds", 86400, values=["y", "Exogenous1"])
    return g.withColumn("y", r6("y"))


@query(
    ctes(ELEC)
    + """SELECT e.unique_id, e.ds, CAST(c.code AS BIGINT) AS code FROM elec e JOIN (
  SELECT unique_id, dense_rank() OVER (ORDER BY unique_id) - 1 AS code FROM (SELECT DISTINCT unique_id FROM elec)) c
ON e.unique_id = c.unique_id"""
)
def category_codes(spark, sf):
    e = tables.electricity(spark, sf).select("unique_id", "ds")
    return series.with_codes(e, series.category_codes(e, "unique_id"), "unique_id")


def _decompose_sql(period):
    h = period // 2
    return ctes(
        ELEC,
        GRID,
        f"""t AS (SELECT *, CASE WHEN pos >= {h} AND pos < n - {h} THEN
  (sum(y0) OVER (PARTITION BY unique_id ORDER BY ds ROWS BETWEEN {h} PRECEDING AND {h} FOLLOWING)
   - (lag(y0, {h}) OVER (PARTITION BY unique_id ORDER BY ds) + lead(y0, {h}) OVER (PARTITION BY unique_id ORDER BY ds)) / 2) / {period} END AS trend
  FROM grid),
ph AS (SELECT unique_id, pos % {period} AS phase, avg(y0 - trend) AS m FROM t GROUP BY unique_id, pos % {period}),
se AS (SELECT unique_id, phase, m - avg(m) OVER (PARTITION BY unique_id) AS seasonal FROM ph)""",
    ) + f"""SELECT t.unique_id, t.ds, {q6('t.trend')} AS trend, {q6('se.seasonal')} AS seasonal,
  {q6('t.y0 - t.trend - se.seasonal')} AS resid
FROM t JOIN se ON t.unique_id = se.unique_id AND t.pos % {period} = se.phase"""


def _decompose(spark, sf, period):
    d = diagnose.seasonal_decompose(hourly_grid(spark, sf), ["unique_id"], "y0", period)
    return d.select("unique_id", "ds", *[r6(c).alias(c) for c in ("trend", "seasonal", "resid")])


@query(_decompose_sql(24))
def seasonal_decompose_24(spark, sf):
    return _decompose(spark, sf, 24)


@query(_decompose_sql(168))
def seasonal_decompose_168(spark, sf):
    return _decompose(spark, sf, 168)


_ACF = """mu AS (SELECT unique_id, avg(y0) AS m, count(*) AS n FROM grid GROUP BY unique_id),
dev AS (SELECT g.unique_id, g.pos, g.y0 - mu.m AS d, mu.n FROM grid g JOIN mu ON g.unique_id = mu.unique_id),
prod AS (SELECT a.unique_id, CAST(k.k AS BIGINT) AS lag, sum(a.d * b.d) AS s, max(a.n) AS n
  FROM dev a, range(101) k(k), dev b WHERE a.unique_id = b.unique_id AND b.pos = a.pos + k.k GROUP BY a.unique_id, k.k),
ac AS (SELECT p.unique_id, p.lag, p.s / z.s AS r, p.n FROM prod p JOIN prod z ON p.unique_id = z.unique_id AND z.lag = 0)"""


@query(
    ctes(ELEC, GRID, _ACF)
    + f"""SELECT unique_id, lag, {q6('r')} AS r, {q6('''CASE WHEN lag = 0 THEN 0 ELSE 1.959964e0 * sqrt((1 + 2 * coalesce(
  sum(CASE WHEN lag > 0 THEN r * r END) OVER (PARTITION BY unique_id ORDER BY lag ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)) / n) END''')} AS band
FROM ac"""
)
def acf(spark, sf):
    a = diagnose.acf(hourly_grid(spark, sf), ["unique_id"], "y0")
    return a.select("unique_id", "lag", r6("r").alias("r"), r6("band").alias("band"))


# Durbin-Levinson: phi holds the k coefficients of order k, r[1] is lag 0.
_PACF = """rs AS (SELECT unique_id, list(r ORDER BY lag) AS r, max(n) AS n FROM ac GROUP BY unique_id),
rec AS (
  SELECT unique_id, n, r, 1 AS k, r[2] AS v, [r[2]] AS phi FROM rs
  UNION ALL
  SELECT unique_id, n, r, k + 1, v, list_append([phi[i] - v * phi[k + 1 - i] FOR i IN range(1, k + 1)], v)
  FROM (SELECT unique_id, n, r, k, phi,
               (r[k + 2] - list_dot_product(phi, list_reverse(r[2:k + 1]))) / (1 - list_dot_product(phi, r[2:k + 1])) AS v
        FROM rec WHERE k + 2 <= len(r)))"""


@query(
    ctes(ELEC, GRID, _ACF, _PACF).replace("WITH ", "WITH RECURSIVE ", 1)
    + f"""SELECT unique_id, CAST(k AS BIGINT) AS lag, {q6('v')} AS pacf, {q6(f'{diagnose.Z95!r} / sqrt(n)')} AS band FROM rec
UNION ALL SELECT unique_id, 0, 1, 0 FROM rs"""
)
def pacf(spark, sf):
    a = diagnose.acf(hourly_grid(spark, sf), ["unique_id"], "y0")
    p = diagnose.pacf(a, ["unique_id"])
    return p.select("unique_id", "lag", r6("pacf").alias("pacf"), r6("band").alias("band"))


@query(
    ctes(ELEC, GRID, _ACF)
    + f"""SELECT unique_id, max(n) AS n, {q6('max(CASE WHEN lag = 1 THEN r END)')} AS pacf_1,
  {q6('(max(CASE WHEN lag = 2 THEN r END) - power(max(CASE WHEN lag = 1 THEN r END), 2)) / (1 - power(max(CASE WHEN lag = 1 THEN r END), 2))')} AS pacf_2
FROM ac GROUP BY unique_id"""
)
def pacf_low_lags(spark, sf):
    a = diagnose.acf(hourly_grid(spark, sf), ["unique_id"], "y0")
    p = diagnose.pacf(a, ["unique_id"]).filter("lag <= 2").join(
        a.filter("lag = 0").select("unique_id", "n"), "unique_id"
    )
    return p.groupBy("unique_id").agg(
        F.max("n").alias("n"),
        r6(F.max(F.when(F.col("lag") == 1, F.col("pacf")))).alias("pacf_1"),
        r6(F.max(F.when(F.col("lag") == 2, F.col("pacf")))).alias("pacf_2"),
    )


_ATTR = {
    "hour": "hour({t})",
    "day": "day({t})",
    "dayofweek": "isodow({t}) - 1",
    "week": "weekofyear({t})",
    "month": "month({t})",
}


def _attr_sql(t="ds"):
    return ", ".join(f"CAST({sql.format(t=t)} AS BIGINT) AS {n}" for n, sql in _ATTR.items())


def _cyclic_sql(t="ds"):
    out = []
    for n, sql in _ATTR.items():
        a = f"(CAST({sql.format(t=t)} AS BIGINT) - {calendar.FIRST[n]}) * {2 * math.pi / calendar.PERIODS[n]!r}"
        out += [f"{q6(f'sin({a})')} AS {n}_sin", f"{q6(f'cos({a})')} AS {n}_cos"]
    return ", ".join(out)


_CYC = [f"{n}_{f}" for n in _ATTR for f in ("sin", "cos")]


@query(ctes(ELEC) + f"SELECT unique_id, ds, {_cyclic_sql()} FROM elec")
def encode_cyclic(spark, sf):
    e = tables.electricity(spark, sf).select("unique_id", "ds")
    e = calendar.encode(e, "ds", cyclic_of=calendar.ATTRIBUTES)
    return e.select("unique_id", "ds", *[r6(c).alias(c) for c in _CYC])


@query(ctes(ELEC) + f"SELECT unique_id, ds, {_attr_sql()} FROM elec")
def encode_calendar(spark, sf):
    e = tables.electricity(spark, sf).select("unique_id", "ds")
    return calendar.encode(e, "ds", attributes_of=calendar.ATTRIBUTES)


@query(
    ctes(ELEC, FUTURE, """al AS (SELECT unique_id, ds FROM elec UNION SELECT unique_id, ds FROM elec_future),
h AS (SELECT unique_id, min(ds) AS a, max(ds) AS z FROM elec GROUP BY unique_id),
b AS (SELECT unique_id, max(ds) AS z FROM al GROUP BY unique_id),
g AS (SELECT h.unique_id, unnest(generate_series(h.a, b.z, INTERVAL 1 HOUR)) AS ds, h.z FROM h JOIN b ON h.unique_id = b.unique_id)""")
    + "SELECT unique_id, ds, CAST(date_diff('hour', z, ds) AS BIGINT) AS position, ds > z AS is_future FROM g"
)
def encode_position(spark, sf):
    hist = tables.electricity(spark, sf).select("unique_id", "ds")
    # Both frames may name the same hour; the grid needs it once.
    full = hist.unionByName(tables.electricity_future(spark, sf).select("unique_id", "ds")).distinct()
    g = series.regularise(full, ["unique_id"], "ds", 3600, values=[])
    h = series.time_extents(hist, ["unique_id"], "ds")
    n_hist = F.floor(series.seconds_between("_t0", "_t1") / 3600).cast("long") + 1
    g = g.join(h, "unique_id").withColumn("_nh", n_hist)
    return g.select(
        "unique_id", "ds", calendar.relative_position("pos", "_nh").alias("position"),
        (F.col("ds") > F.col("_t1")).alias("is_future"),
    )


@query(ctes(ELEC) + f"SELECT unique_id, ds, {q6('(year(ds) - 2000) / 50')} AS year_code FROM elec")
def encode_custom_year(spark, sf):
    e = tables.electricity(spark, sf).select("unique_id", "ds")
    return calendar.encode(e, "ds", custom={"year_code": lambda t: r6(calendar.encode_year(t))})


_CET = "((ds AT TIME ZONE 'UTC') AT TIME ZONE 'CET')"


@query(ctes(ELEC) + f"SELECT unique_id, ds, {_CET} AS local_ds, {_attr_sql(_CET)} FROM elec")
def encode_tz(spark, sf):
    e = tables.electricity(spark, sf).select("unique_id", "ds")
    e = e.withColumn("local_ds", calendar.in_zone("ds"))
    return calendar.encode(e, "ds", attributes_of=calendar.ATTRIBUTES, zone=calendar.ZONE)


def _mm(c):
    return f"CASE WHEN {c}_max = {c}_min THEN 0 ELSE ({c} - {c}_min) / nullif({c}_max - {c}_min, 0) END"


def _stats_sql(cols, src, key="unique_id"):
    return f"SELECT {key}, " + ", ".join(f"min({c}) AS {c}_min, max({c}) AS {c}_max" for c in cols) + f" FROM {src} GROUP BY {key}"


@query(
    ctes(ELEC, f"a AS (SELECT unique_id, ds, {_attr_sql()} FROM elec)", f"st AS ({_stats_sql(_ATTR, 'a')})")
    + "SELECT a.unique_id, a.ds, " + ", ".join(f"{q6(_mm(c))} AS {c}_scaled" for c in _ATTR)
    + " FROM a JOIN st ON a.unique_id = st.unique_id"
)
def encode_scaled(spark, sf):
    e = tables.electricity(spark, sf).select("unique_id", "ds")
    e = calendar.encode(e, "ds", attributes_of=calendar.ATTRIBUTES)
    st = scale.minmax_stats(e, ["unique_id"], calendar.ATTRIBUTES)
    s = scale.minmax_apply(e, st, ["unique_id"], calendar.ATTRIBUTES)
    return s.select("unique_id", "ds", *[r6(f"{c}_scaled").alias(f"{c}_scaled") for c in calendar.ATTRIBUTES])


_YX = ("y", "Exogenous1", "Exogenous2")


@query(
    ctes(ELEC, f"st AS ({_stats_sql(_YX, 'elec')})")
    + "SELECT e.unique_id, e.ds, " + ", ".join(f"{q6(_mm(c))} AS {c}_scaled" for c in _YX)
    + " FROM elec e JOIN st ON e.unique_id = st.unique_id"
)
def scale_minmax(spark, sf):
    e = tables.electricity(spark, sf)
    s = scale.minmax_apply(e, scale.minmax_stats(e, ["unique_id"], _YX), ["unique_id"], _YX)
    return s.select("unique_id", "ds", *[r6(f"{c}_scaled").alias(f"{c}_scaled") for c in _YX])


_X = ("Exogenous1", "Exogenous2")


@query(
    ctes(ELEC, FUTURE, f"st AS ({_stats_sql(_X, 'elec')})")
    + "SELECT e.unique_id, e.ds, " + ", ".join(f"{q6(_mm(c))} AS {c}_scaled" for c in _X)
    + " FROM elec_future e JOIN st ON e.unique_id = st.unique_id"
)
def scale_apply(spark, sf):
    st = scale.minmax_stats(tables.electricity(spark, sf), ["unique_id"], _X)
    s = scale.minmax_apply(tables.electricity_future(spark, sf), st, ["unique_id"], _X)
    return s.select("unique_id", "ds", *[r6(f"{c}_scaled").alias(f"{c}_scaled") for c in _X])


@query(
    ctes(ELEC)
    + f"""SELECT unique_id, ds, {q6('max(y) OVER w + min(y) OVER w - y')} AS y_back
FROM elec WINDOW w AS (PARTITION BY unique_id)"""
)
def scale_inverse(spark, sf):
    """A forecast on the scaled axis (the mirrored series) in the target's own unit."""
    e = tables.electricity(spark, sf).select("unique_id", "ds", "y")
    st = scale.minmax_stats(e, ["unique_id"], ["y"])
    s = scale.minmax_apply(e, st, ["unique_id"], ["y"])
    s = s.withColumn("forecast", 1 - F.col("y_scaled"))
    s = scale.minmax_invert(s, st, ["unique_id"], {"forecast": "y"})
    return s.select("unique_id", "ds", r6("forecast_raw").alias("y_back"))


_TRAIN = "pos < n - 240"


@query(
    ctes(ELEC, GRID, f"st AS (SELECT unique_id, min(y0) AS y0_min, max(y0) AS y0_max FROM grid WHERE {_TRAIN} GROUP BY unique_id)")
    + f"SELECT g.unique_id, g.ds, {q6(_mm('y0'))} AS y0_scaled FROM grid g JOIN st ON g.unique_id = st.unique_id"
)
def scale_minmax_train_only(spark, sf):
    g = hourly_grid(spark, sf)
    st = scale.minmax_stats(g, ["unique_id"], ["y0"], where=F.expr(_TRAIN))
    s = scale.minmax_apply(g, st, ["unique_id"], ["y0"])
    return s.select("unique_id", "ds", r6("y0_scaled").alias("y0_scaled"))


@query(
    ctes(DISCHARGE, """st AS (SELECT battery_id, cycle, avg(Time) AS m,
  CASE WHEN min(Time) = max(Time) OR coalesce(stddev_samp(Time), 0) = 0 THEN 1 ELSE stddev_samp(Time) END AS s
  FROM discharge GROUP BY battery_id, cycle)""")
    + f"""SELECT d.battery_id, d.cycle, d.event_id, {q6('(d.Time - st.m) / st.s')} AS time_norm
FROM discharge d JOIN st ON d.battery_id = st.battery_id AND d.cycle = st.cycle"""
)
def normalize_group(spark, sf):
    d = tables.discharge(spark, sf).select("battery_id", "cycle", "event_id", "Time")
    g = scale.normalise_group(d, ["battery_id", "cycle"], "Time", out="time_norm")
    return g.select("battery_id", "cycle", "event_id", r6("time_norm").alias("time_norm"))


@query(
    ctes(ELEC)
    + """SELECT e.unique_id, e.ds, v.unique_id AS value, CAST(e.unique_id = v.unique_id AS DOUBLE) AS flag
FROM elec e, (SELECT DISTINCT unique_id FROM elec) v"""
)
def static_onehot(spark, sf):
    """The one-hot columns of every id in the data, as rows."""
    e = tables.electricity(spark, sf).select("unique_id", "ds")
    names = series.known_values(e, "unique_id")
    flags = F.array(*[F.struct(F.lit(v).alias("value"), F.col(f"is_{v}").alias("flag")) for v in names])
    wide = series.one_hot(e, "unique_id", names)
    return wide.select("unique_id", "ds", F.inline(flags))


_ENC = """p AS (SELECT *, row_number() OVER (PARTITION BY battery_id, cycle ORDER BY datetime_, event_id) AS time_idx FROM discharge)"""


@query(
    ctes(DISCHARGE, _ENC)
    + f"""SELECT battery_id, cycle, event_id, time_idx, least(time_idx - 1, 30) AS encoder_length,
  {q6('sum(Capacity) OVER w')} AS encoder_capacity_sum, {q6('sum(Voltage_measured) OVER w')} AS encoder_voltage_sum,
  {q6('first_value(Voltage_measured) OVER w')} AS encoder_first_voltage,
  {q6('Voltage_measured')} AS known_voltage, CAST(NULL AS DOUBLE) AS unknown_capacity
FROM p WINDOW w AS (PARTITION BY battery_id, cycle ORDER BY time_idx ROWS BETWEEN 30 PRECEDING AND 1 PRECEDING)"""
)
def encoder_windows(spark, sf):
    d = tables.discharge(spark, sf)
    p = sorted_positions(d, ["battery_id", "cycle"], ["datetime_", "event_id"])
    p = p.withColumn("time_idx", F.col("pos") + 1)
    w = windows.encoder_windows(
        p, ["battery_id", "cycle"], "pos", ["Capacity", "Voltage_measured"], known=["Voltage_measured"],
        unknown=["Capacity"],
    )

    def total(c):
        s = F.aggregate(F.transform("encoder", lambda r: r[c]), F.lit(0.0), lambda a, x: a + x)
        return r6(F.when(F.size("encoder") > 0, s))

    return w.select(
        "battery_id", "cycle", "event_id", "time_idx", F.size("encoder").cast("long").alias("encoder_length"),
        total("Capacity").alias("encoder_capacity_sum"),
        total("Voltage_measured").alias("encoder_voltage_sum"),
        r6(F.get("encoder", F.lit(0))["Voltage_measured"]).alias("encoder_first_voltage"),
        r6(F.col("decoder")["Voltage_measured"]).alias("known_voltage"),
        F.col("decoder")["Capacity"].alias("unknown_capacity"),
    )
