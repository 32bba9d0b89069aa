"""Forecasting each discharge cycle from all the cycles before it.

A model per cycle is fitted on a history that grows with the cycle. Copying
that history to every cycle would square the table, so each learner is written
in sums of outer products that are cumulative over cycles; all cycles then
share one pass over the rows.
"""

from __future__ import annotations

from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor

import numpy as np
import pandas as pd
from pyspark import inheritable_thread_target
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import GBTRegressor
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fadecast.operators.ordered import CHUNK, running, segments, sorted_positions
from fadecast.operators.sequences import latest_window, sequences
from fadecast.operators import score
from fadecast.plans import gram
from fadecast.session import checkpointed
from fadecast.spec import BATTERY

EXOG = BATTERY.future
TARGETS = BATTERY.target
# The longest sequence and the longest encoder.
LONGEST_SEQUENCE = 20
ENCODER = 30

_D, _L, _A = T.DoubleType(), T.LongType(), T.ArrayType(T.DoubleType())


def numbered(measured: DataFrame, key: str = "battery_id") -> DataFrame:
    """Rows in time order per battery: ``pos``, ``n``."""
    return sorted_positions(measured, [key], ["datetime_", "event_id"], total="n")


def cycle_starts(rows: DataFrame, key: str = "battery_id") -> DataFrame:
    """First position and length of each cycle.

    One line per cycle, read several times by each model: written once.
    """
    return checkpointed(
        rows.groupBy(key, "cycle").agg(
            F.min("pos").alias("cycle_start"), F.count(F.lit(1)).alias("cycle_rows")
        )
    )


def tails(
    rows: DataFrame,
    starts: DataFrame,
    columns: Sequence[str],
    length: int,
    key: str = "battery_id",
    aggs: Sequence[Column] = (),
    carry: Sequence[str] = (),
) -> DataFrame:
    """The last ``length`` rows before each cycle, oldest first, as arrays.

    ``aggs`` are further aggregates of these rows, over ``columns`` and
    ``carry``. One line per cycle, written once.
    """
    first = F.greatest(F.col("cycle_start") - length, F.lit(0).cast("long"))
    at = starts.filter("cycle_start > 0").select(
        key, "cycle", "cycle_start", F.explode(F.sequence(first, F.col("cycle_start") - 1)).alias("pos")
    )
    body = F.sort_array(F.collect_list(F.struct("pos", *columns))).alias("_s")
    got = at.join(rows.select(key, "pos", *columns, *carry), [key, "pos"])
    got = got.groupBy(key, "cycle", "cycle_start").agg(body, *aggs)
    return checkpointed(got.withColumns({f"tail_{c}": F.col(f"_s.{c}") for c in columns}).drop("_s"))


# --- differences with an autoregressive error (one model per target and cycle)

LONG_ORDER = 5


def _difference_inputs(y: np.ndarray, x: np.ndarray, idx: np.ndarray) -> np.ndarray:
    """Lagged differences at ``idx``: dy[t-1..t-m-1], dx[t], dx[t-1], dx[t-2]."""
    dy, dx = np.diff(y), np.diff(x, axis=0)
    at = idx - 1
    lags = at[:, None] - np.arange(1, LONG_ORDER + 2)
    return np.hstack([dy[lags], dx[at], dx[at - 1], dx[at - 2]])


def arima_weights(m: np.ndarray) -> tuple[np.ndarray, np.ndarray] | None:
    """Two-step least squares for an ARMA(1,1) in differences with regressors.

    Step one fits a long autoregression; its residual enters step two as the
    moving-average term. The residual is linear in the lagged differences, so
    step two needs no second look at the rows.
    Returns the step-one weights and (phi, beta, gamma, theta).
    """
    k, q = len(EXOG), LONG_ORDER
    p = q + 1 + 3 * k
    G, g = m[:, :p], m[:, p]
    if np.trace(G) <= 0:
        return None
    z = [*range(q), *range(q + 1, q + 1 + 2 * k)]
    alpha = np.linalg.lstsq(G[np.ix_(z, z)], g[z], rcond=None)[0]
    R = np.zeros((2 + 2 * k, p))
    R[0, 0] = 1.0
    R[1 : 1 + 2 * k, q + 1 : q + 1 + 2 * k] = np.eye(2 * k)
    late = [*range(1, q + 1), *range(q + 1 + k, q + 1 + 3 * k)]
    R[-1, 0] = 1.0
    R[-1, late] -= alpha
    weights = np.linalg.lstsq(R @ G @ R.T, R @ g, rcond=None)[0]
    return alpha, weights


def arimax_by_cycle(
    measured: DataFrame,
    *,
    key: str = "battery_id",
    targets: Sequence[str] = TARGETS,
    exog: Sequence[str] = EXOG,
    max_history: int | None = None,
    size: int = 4096,
) -> DataFrame:
    """Each target over each cycle with order (1, 1, 1) and known regressors.

    ``key, cycle, target, event_id, step, yhat``; null where the history is
    too short. ``max_history`` limits the differences fitted on to those of the last so
    many cycles.
    """
    rows = numbered(measured, key).select(key, "cycle", "event_id", "pos", *targets, *exog)
    need = LONG_ORDER + 3
    seg = segments(rows, [key], "pos", ["cycle", *targets, *exog], back=need, size=size)
    labels = [rows.schema[key], T.StructField("target", T.StringType()), T.StructField("cycle", _L)]
    names = [f.name for f in labels]

    def design(row):
        x = np.column_stack([np.asarray(getattr(row, c), dtype=float) for c in exog])
        cyc = np.asarray(row.cycle)
        pos = np.arange(max(row.own_from, need - 1), min(row.own_to, row.start + len(x)))
        idx = pos - row.start
        for t in targets:
            y = np.asarray(getattr(row, t), dtype=float)
            for c in np.unique(cyc[idx]) if len(idx) else ():
                at = idx[cyc[idx] == c]
                X = _difference_inputs(y, x, at)
                yield (getattr(row, key), t, int(c)), X, (y[at] - y[at - 1])[:, None]

    sums = gram.add_up(gram.partial_sums(seg, labels, design), names)
    starts = cycle_starts(rows, key)
    wanted = starts.select(
        key,
        F.explode(F.array(*[F.lit(t) for t in targets])).alias("target"),
        F.col("cycle").cast("long").alias("cycle"),
    )
    history = gram.cumulate(sums, [key, "target"], "cycle", wanted, max_history)
    fit_schema = T.StructType([*labels, T.StructField("alpha", _A), T.StructField("arma", _A)])

    def fit(pdf: pd.DataFrame) -> pd.DataFrame:
        got = arima_weights(gram.matrix(pdf))
        head = {c: [pdf[c].iloc[0]] for c in names}
        if got is None:
            return pd.DataFrame(columns=fit_schema.names)
        return pd.DataFrame({**head, "alpha": [got[0]], "arma": [got[1]]})

    # Small (one line per model) and read twice below: written once.
    models = checkpointed(gram.spread(history, names).groupBy(*names).applyInPandas(fit, fit_schema))
    return _arima_paths(rows, starts, models, key, targets, exog, need, size)


def _arima_paths(rows, starts, models, key, targets, exog, need, size) -> DataFrame:
    """Run the recursion over each cycle, chunk by chunk.

    Within a chunk the path from a zero state is computed; the state at the
    chunk's start adds phi^k and a geometric sum to it. Only the chunk ends of
    cycles longer than one chunk are chained, one line per chunk.
    """
    tail = tails(rows, starts, [*targets, *exog], need, key).drop("cycle_start")
    r = rows.join(starts, [key, "cycle"]).withColumn("step", F.col("pos") - F.col("cycle_start"))
    seg = segments(
        r, [key, "cycle", "cycle_rows"], "step", ["event_id", *exog], back=2, size=size
    )
    seg = seg.join(tail, [key, "cycle"], "left")
    seg = seg.withColumn("target", F.explode(F.array(*[F.lit(t) for t in targets])))
    m = models.withColumn("cycle", F.col("cycle").cast("int"))
    seg = seg.join(m, [key, "cycle", "target"], "left")
    ident = [rows.schema[key], rows.schema["cycle"], T.StructField("target", T.StringType()),
             T.StructField("own_from", _L)]
    out_schema = T.StructType(
        [*ident, T.StructField("phi", _D), T.StructField("y_last", _D),
         T.StructField("event_id", T.ArrayType(_L)), T.StructField("c", _A), T.StructField("d_end", _D)]
    )

    def run(batches):
        for pdf in batches:
            out = [_chunk_path(row, key, exog) for row in pdf.itertuples(index=False)]
            yield pd.DataFrame(out, columns=out_schema.names)

    paths = seg.mapInPandas(run, out_schema)
    ends = (
        seg.filter(F.col("cycle_rows") > size)
        .mapInPandas(run, out_schema)
        .filter(F.col("phi").isNotNull())
        .select(
            key, "cycle", "target", "own_from", "phi", "d_end",
            F.size("c").alias("len"), F.element_at("c", -1).alias("c_end"),
        )
    )
    carry_schema = T.StructType([*ident, T.StructField("d_in", _D), T.StructField("c_in", _D)])

    def chain(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("own_from")
        d = c = 0.0
        ins = []
        for r in pdf.itertuples(index=False):
            ins.append((d, c))
            powers = np.power(r.phi, np.arange(1, r.len + 1))
            c = c + r.c_end + d * powers.sum()
            d = d * powers[-1] + r.d_end
        out = pdf[[key, "cycle", "target", "own_from"]].copy()
        out["d_in"], out["c_in"] = [i[0] for i in ins], [i[1] for i in ins]
        return out

    carried = ends.groupBy(key, "cycle", "target").applyInPandas(chain, carry_schema)
    on = [key, "cycle", "target", "own_from"]
    long = paths.join(carried, on, "left").select(
        *on, "phi", "y_last", "d_in", "c_in", F.posexplode(F.arrays_zip("event_id", "c")).alias("k", "_z")
    )
    k = F.col("k") + 1
    phi = F.col("phi")
    geometric = F.when(phi == 1, k.cast("double")).otherwise(phi * (1 - F.pow(phi, k)) / (1 - phi))
    carry = F.coalesce("c_in", F.lit(0.0)) + F.coalesce(F.col("d_in") * geometric, F.lit(0.0))
    yhat = F.col("y_last") + F.col("_z.c") + carry
    return long.select(
        key, "cycle", "target", F.col("_z.event_id").alias("event_id"),
        (F.col("own_from") + k).alias("step"), F.when(~F.isnan(yhat), yhat).alias("yhat"),
    )


BLOCK = 64


def ar1(phi: float, drive: np.ndarray) -> np.ndarray:
    """d[i] = phi d[i-1] + drive[i] from d[-1] = 0, a block of rows at a time."""
    n = len(drive)
    blocks = np.zeros((-(-n // BLOCK), BLOCK))
    blocks.ravel()[:n] = drive
    lag = np.subtract.outer(np.arange(BLOCK), np.arange(BLOCK))
    inside = blocks @ np.where(lag >= 0, phi ** np.maximum(lag, 0.0), 0.0).T
    powers, state = phi ** np.arange(1.0, BLOCK + 1), 0.0
    for b in inside:
        b += powers * state
        state = b[-1]
    return inside.ravel()[:n]


def _chunk_path(row, key, exog):
    """Path of one chunk from a zero state; nulls where there is no model."""
    ids = np.asarray(row.event_id)[int(row.own_from - row.start):]
    ident = (getattr(row, key), row.cycle, row.target, row.own_from)
    if row.arma is None:
        return (*ident, None, None, ids, np.full(len(ids), np.nan), None)
    k = len(exog)
    phi, beta = float(row.arma[0]), np.asarray(row.arma[1 : 1 + k], dtype=float)
    gamma, theta = np.asarray(row.arma[1 + k : 1 + 2 * k], dtype=float), float(row.arma[-1])
    x = np.column_stack([np.asarray(getattr(row, c), dtype=float) for c in exog])
    past_x = np.column_stack([np.asarray(getattr(row, f"tail_{c}"), dtype=float) for c in exog])
    past_y = np.asarray(getattr(row, f"tail_{row.target}"), dtype=float)
    offset = int(row.own_from - row.start)
    if row.own_from == 0:
        # The cycle's first rows follow the end of the history.
        x, offset = np.vstack([past_x[-2:], x]), min(2, len(past_x))
    dx = np.vstack([np.zeros((1, k)), np.diff(x, axis=0)])
    before = np.vstack([np.zeros((1, k)), dx[:-1]])
    drive = (dx @ beta + before @ gamma)[offset:]
    if row.own_from == 0 and len(past_y) >= LONG_ORDER + 3:
        dy, pdx = np.diff(past_y), np.diff(past_x, axis=0)
        z = np.concatenate([dy[-2 : -2 - LONG_ORDER : -1], pdx[-1], pdx[-2]])
        drive[0] += phi * dy[-1] + theta * (dy[-1] - np.asarray(row.alpha, dtype=float) @ z)
    d = ar1(phi, drive)
    return (*ident, phi, float(past_y[-1]), ids, np.cumsum(d), float(d[-1]))


# --- additive trend, seasonality and regressors

KNOTS = 10
DAILY_TERMS, WEEKLY_TERMS = 4, 3
DAY = 86400.0


def additive_inputs(time: Column, start: Column, end: Column, exog: Sequence[str]) -> Column:
    """Piecewise-linear trend, daily and weekly Fourier terms, regressors.

    Trend knots lie evenly in the first four fifths of the battery's time span.
    """
    sec = F.unix_micros(time.cast("timestamp")) / 1e6
    s0, s1 = (F.unix_micros(c.cast("timestamp")) / 1e6 for c in (start, end))
    t = (sec - s0) / DAY
    span = (s1 - s0) / DAY
    cols = [t]
    cols += [F.greatest(F.lit(0.0), t - span * (0.8 * j / KNOTS)) for j in range(1, KNOTS + 1)]
    for period, terms in ((1.0, DAILY_TERMS), (7.0, WEEKLY_TERMS)):
        for j in range(1, terms + 1):
            a = (sec / DAY) * (2 * np.pi * j / period)
            cols += [F.sin(a), F.cos(a)]
    return F.array(*cols, *[F.col(c).cast("double") for c in exog])


def cycle_models(
    rows: DataFrame, x: str, y: str, penalty: float, key: str = "battery_id", max_history: int | None = None
) -> DataFrame:
    """Ridge models of every cycle on the rows of the cycles before it, or of the last
    ``max_history`` of them."""
    parts = gram.partial_sums_of_rows(rows, [key, "cycle"], x, y)
    sums = gram.add_up(parts, [key, "cycle"])
    wanted = rows.select(key, "cycle").distinct()
    history = gram.cumulate(sums, [key], "cycle", wanted, max_history)
    return gram.solve(history, [key, "cycle"], [penalty])


def with_models(rows, models, x, targets, key):
    """Predictions of each row and target; null where the cycle has no model."""
    # The weights of all targets stand in one line per cycle, so each row meets them in
    # one join and is multiplied by targets only after its inputs are gone. Skewed cycles
    # are split by adaptive execution.
    m = models.groupBy(key, "cycle").agg(
        F.map_from_entries(F.collect_list(F.struct("step", "w"))).alias("_w")
    )

    def one(k: int, t: str) -> Column:
        w = F.try_element_at("_w", F.lit(k).cast("long"))
        yhat = F.when(w.isNotNull() & F.col(x).isNotNull(), gram.dot(x, w))
        return F.struct(F.lit(t).alias("target"), yhat.alias("yhat"))

    done = rows.join(m, [key, "cycle"], "left").withColumn(
        "_p", F.array(*[one(k, t) for k, t in enumerate(targets, start=1)])
    )
    # The outer form: for the inner one the optimiser adds a filter that computes _p again.
    return done.drop(x, "_w").select("*", F.inline_outer("_p")).drop("_p")


def additive_by_cycle(
    measured: DataFrame,
    *,
    key: str = "battery_id",
    targets: Sequence[str] = TARGETS,
    exog: Sequence[str] = EXOG,
    penalty: float = 1e-3,
    max_history: int | None = None,
) -> DataFrame:
    """Each target over each cycle from trend, seasonality and regressors.

    The inputs depend on one row alone, so the fit needs no ordering. ``max_history`` limits
    the training rows to the last so many cycles.
    """
    span = measured.groupBy(key).agg(F.min("datetime_").alias("_t0"), F.max("datetime_").alias("_t1"))
    x = additive_inputs(F.col("datetime_"), F.col("_t0"), F.col("_t1"), exog)
    rows = measured.join(span, key).select(
        key, "cycle", "event_id", x.alias("x"), F.array(*targets).alias("y")
    )
    models = cycle_models(rows, "x", "y", penalty, key, max_history)
    out = with_models(rows.drop("y"), models, "x", targets, key)
    return out.select(key, "cycle", "target", "event_id", "yhat")


def regression_by_cycle(
    measured: DataFrame,
    *,
    key: str = "battery_id",
    targets: Sequence[str] = TARGETS,
    exog: Sequence[str] = EXOG,
    penalty: float = 1e-3,
    max_history: int | None = None,
) -> DataFrame:
    """Each target over each cycle from the regressors alone."""
    rows = measured.select(
        key, "cycle", "event_id",
        F.array(*[F.col(c).cast("double") for c in exog]).alias("x"), F.array(*targets).alias("y"),
    )
    models = cycle_models(rows, "x", "y", penalty, key, max_history)
    out = with_models(rows.drop("y"), models, "x", targets, key)
    return out.select(key, "cycle", "target", "event_id", "yhat")


# --- next value from the last sequence, one per cycle


def capacity_next(
    measured: DataFrame,
    *,
    key: str = "battery_id",
    target: str = "Capacity",
    exog: Sequence[str] = EXOG,
    length: int = LONGEST_SEQUENCE,
    penalty: float = 1e-2,
    size: int = 4096,
) -> DataFrame:
    """One step of ``target`` per cycle from the ``length`` rows before it.

    Scaling uses the smallest and largest values of the history, the last
    ``length`` samples of the history are kept back from the fit. A history of
    at most ``2 * length`` rows is modelled with shorter sequences, as long as leave a
    training sample; the column ``length`` says how long. Below three rows: null.
    """
    cols = [target, *exog]
    rows = numbered(measured, key).select(key, "cycle", "pos", *cols)
    seg = segments(rows, [key], "pos", ["cycle", *cols], back=length, size=size)
    labels = [rows.schema[key], T.StructField("cycle", _L)]

    def windows(values: np.ndarray, idx: np.ndarray) -> np.ndarray:
        past = values[idx[:, None] + np.arange(-length, 0)]
        return np.hstack([np.ones((len(idx), 1)), past.reshape(len(idx), -1)])

    def design(row):
        v = np.column_stack([np.asarray(getattr(row, c), dtype=float) for c in cols])
        cyc = np.asarray(row.cycle)
        idx = np.arange(max(row.own_from, length), min(row.own_to, row.start + len(v))) - row.start
        for c in np.unique(cyc[idx]) if len(idx) else ():
            at = idx[cyc[idx] == c]
            yield (getattr(row, key), int(c)), windows(v, at), v[at, :1]

    sums = gram.add_up(gram.partial_sums(seg, labels, design), [key, "cycle"])
    starts = cycle_starts(rows, key)
    wanted = starts.select(key, F.col("cycle").cast("long").alias("cycle"))
    history = gram.cumulate(sums, [key], "cycle", wanted)

    ranges = rows.groupBy(key, "cycle").agg(
        *[f(c).alias(f"{n}_{c}") for c in cols for n, f in (("lo", F.min), ("hi", F.max))]
    )
    aggs = {f"{n}s_{c}": (k, F.col(f"{n}_{c}")) for c in cols for n, k in (("lo", "min"), ("hi", "max"))}
    ranges = running(ranges, [key], "cycle", aggs, inclusive=False)
    tail = tails(rows, starts, cols, 2 * length, key).join(
        ranges.select(
            key, "cycle",
            F.array(*[F.col(f"los_{c}").cast("double") for c in cols]).alias("lo"),
            F.array(*[F.col(f"his_{c}").cast("double") for c in cols]).alias("hi"),
        ),
        [key, "cycle"],
    ).withColumn("cycle", F.col("cycle").cast("long"))
    schema = T.StructType([*labels, T.StructField("length", _L), T.StructField("yhat", _D)])

    def fit(lines: pd.DataFrame, last: pd.DataFrame) -> pd.DataFrame:
        empty = pd.DataFrame(columns=schema.names)
        if last.empty:
            return empty
        one = last.iloc[0]
        v = np.column_stack([np.asarray(one[f"tail_{c}"], dtype=float) for c in cols])
        if one["cycle_start"] <= 2 * length:
            return of_short(one, v)
        if lines.empty:
            return empty
        held = np.arange(length, 2 * length)
        X = windows(v, held)
        m = gram.matrix(lines) - X.T @ np.hstack([X, v[held, :1]])
        lo, hi = np.asarray(one["lo"], dtype=float), np.asarray(one["hi"], dtype=float)
        width = np.where(hi > lo, hi - lo, 1.0)
        # Rescale the sums instead of the rows: scaled = raw @ S.
        p = m.shape[0]
        S = np.zeros((p + 1, p + 1))
        S[0, 0] = 1.0
        S[0, 1:p] = np.tile(-lo / width, length)
        S[np.arange(1, p), np.arange(1, p)] = np.tile(1 / width, length)
        S[0, p], S[p, p] = -lo[0] / width[0], 1 / width[0]
        full = np.zeros((p + 1, p + 1))
        full[:p], full[p, :p] = m, m[:, p]
        w = gram.ridge((S.T @ full @ S)[:p], penalty)
        if w is None:
            return empty
        x = np.concatenate([[1.0], ((v[-length:] - lo) / width).ravel()])
        yhat = float(x @ w[:, 0]) * width[0] + lo[0]
        return pd.DataFrame({key: [one[key]], "cycle": [one["cycle"]], "length": [length], "yhat": [yhat]})

    def of_short(one, v: np.ndarray) -> pd.DataFrame:
        """The whole history is at hand: its own design with sequences that fit."""
        m = len(v)
        own = min(length, (m - 1) // 2)
        empty = pd.DataFrame(columns=schema.names)
        if own < 1:
            return empty
        lo, hi = np.asarray(one["lo"], dtype=float), np.asarray(one["hi"], dtype=float)
        width = np.where(hi > lo, hi - lo, 1.0)
        s = (v - lo) / width
        past = lambda idx: s[idx[:, None] + np.arange(-own, 0)].reshape(len(idx), -1)
        idx = np.arange(own, m - own)
        sums = gram.outer_sums(np.hstack([np.ones((len(idx), 1)), past(idx)]), s[idx, :1])
        w = None if sums is None else gram.ridge(sums, penalty)
        yhat = np.nan if w is None else float(np.concatenate([[1.0], past(np.array([m]))[0]]) @ w[:, 0]) * width[0] + lo[0]
        if not np.isfinite(yhat):
            return empty
        return pd.DataFrame({key: [one[key]], "cycle": [one["cycle"]], "length": [own], "yhat": [yhat]})

    got = (
        gram.spread(history, [key, "cycle"])
        .groupBy(key, "cycle")
        .cogroup(gram.spread(tail, [key, "cycle"]).groupBy(key, "cycle"))
        .applyInPandas(fit, schema)
    )
    return starts.select(
        key, "cycle", F.lit(target).alias("target"), F.lit(1).cast("long").alias("step")
    ).join(got.withColumn("cycle", F.col("cycle").cast("int")), [key, "cycle"], "left")


# --- whole cycle from the end of the history and known regressors


def capacity_horizon(
    measured: DataFrame,
    *,
    key: str = "battery_id",
    target: str = "Capacity",
    exog: Sequence[str] = EXOG,
    encoder: int = ENCODER,
    penalty: float = 1e-2,
    max_history: int | None = None,
) -> DataFrame:
    """``target`` of every row of each cycle.

    Inputs are the last ``encoder`` values before the cycle, centred and scaled
    by their own mean and deviation, the mean regressors there, and the row's
    own position and regressors, which are known ahead. A shorter history is
    padded with its oldest value.
    """
    rows = numbered(measured, key).select(key, "cycle", "event_id", "pos", target, *exog)
    starts = cycle_starts(rows, key)
    flat = (F.min(target) == F.max(target)) | (F.count(target) < 2)
    means = [F.avg(c).alias(f"_m_{c}") for c in exog]
    tail = tails(
        rows, starts, [target], encoder, key,
        [F.avg(target).alias("centre"),
         F.when(flat, 1.0).otherwise(F.stddev_samp(target)).alias("width"),
         *means],
        carry=exog,
    )
    t = F.col(f"tail_{target}")
    padded = F.concat(F.array_repeat(F.get(t, F.lit(0)), F.lit(encoder) - F.size(t)), t)
    norm = F.transform(padded, lambda v: (v - F.col("centre")) / F.col("width"))
    tail = tail.select(
        key, "cycle", "centre", "width",
        F.concat(norm, F.array(*[F.col(f"_m_{c}") for c in exog])).alias("enc"),
    )
    d = rows.join(starts.select(key, "cycle", "cycle_start"), [key, "cycle"])
    d = d.join(tail, [key, "cycle"], "left")
    d = d.withColumn("step", F.col("pos") - F.col("cycle_start") + 1)
    own = F.array(F.col("step").cast("double"), *[F.col(c).cast("double") for c in exog])
    y = (F.col(target) - F.col("centre")) / F.col("width")
    d = d.withColumn("x", F.concat(own, F.col("enc"))).withColumn(
        "y", F.when(F.col("centre").isNotNull(), F.array(y))
    )
    models = cycle_models(d.select(key, "cycle", "x", "y"), "x", "y", penalty, key, max_history)
    out = with_models(d.drop("y"), models, "x", [target], key)
    return out.select(
        key, "cycle", "target", "event_id", "step",
        (F.col("yhat") * F.col("width") + F.col("centre")).alias("yhat"),
    )


# --- history mean: the simplest forecast of a cycle from the cycles before


def history_mean(
    measured: DataFrame,
    *,
    key: str = "battery_id",
    targets: Sequence[str] = TARGETS,
    max_history: int | None = None,
) -> DataFrame:
    """Mean of each target over all earlier cycles, or the last ``max_history`` of them, for
    every row of a cycle.

    The first cycle has no history, so its predictions are null, one per row.
    """
    per = measured.groupBy(key, "cycle").agg(
        F.count(F.lit(1)).alias("_n"), *[F.sum(t).alias(f"_s_{t}") for t in targets]
    )
    sums = {"_hn": "_n"} | {f"_h_{t}": f"_s_{t}" for t in targets}
    if max_history is None:
        h = running(per, [key], "cycle", {n: ("sum", F.col(c)) for n, c in sums.items()}, inclusive=False)
    else:
        if max_history < 1:
            raise ValueError("a history has at least one cycle")
        before = Window.partitionBy(key).orderBy("cycle").rowsBetween(-max_history, -1)  # of lines per cycle
        h = per.withColumns({n: F.sum(c).over(before) for n, c in sums.items()})
    h = h.select(key, "cycle", *[(F.col(f"_h_{t}") / F.col("_hn")).alias(f"yhat_{t}") for t in targets])
    return measured.select(key, "cycle", "event_id").join(h, [key, "cycle"], "left")


# --- all models in one table


def predictions(measured: DataFrame, *, key: str = "battery_id") -> DataFrame:
    """``battery, target, model, cycle, step, event_id, yhat`` of every per-cycle model.

    ``step`` counts the rows of a cycle from 1. A row that a model has no forecast for is
    null; the first cycle is null for all. The next-capacity model forecasts step 1 only.
    """
    rows = numbered(measured, key)
    starts = cycle_starts(rows, key)
    place = rows.join(starts, [key, "cycle"]).select(
        key, "cycle", "event_id", (F.col("pos") - F.col("cycle_start") + 1).cast("long").alias("step")
    )
    mean = history_mean(measured, key=key)
    names = F.array(*[F.struct(F.lit(t).alias("target"), F.col(f"yhat_{t}").alias("yhat")) for t in TARGETS])
    by_row = {
        "history mean": mean.select(key, "cycle", "event_id", F.inline(names)),
        "additive": additive_by_cycle(measured, key=key),
        "arimax": arimax_by_cycle(measured, key=key),
        "horizon": capacity_horizon(measured, key=key),
    }
    shape = [key, "cycle", "event_id", "target", "yhat"]
    out = None
    for name, found in by_row.items():
        one = found.select(*shape).withColumn("model", F.lit(name))
        out = one if out is None else out.unionByName(one)
    out = out.join(place, [key, "cycle", "event_id"])
    first = capacity_next(measured, key=key).select(key, "cycle", "step", "target", "yhat")
    first = first.join(place, [key, "cycle", "step"]).withColumn("model", F.lit("next value"))
    return out.unionByName(first).select(key, "target", "model", "cycle", "step", "event_id", "yhat")


def prediction_scores(found: DataFrame, measured: DataFrame, *, key: str = "battery_id") -> DataFrame:
    """RMSE by target, model and cycle; null, with ``n_scored`` 0, where nothing was forecast."""
    pairs = F.array(*[F.struct(F.lit(t).alias("target"), F.col(t).cast("double").alias("actual")) for t in TARGETS])
    actual = measured.select("event_id", F.inline(pairs))
    d = found.join(actual, ["event_id", "target"])
    return score.errors(d, [key, "target", "model", "cycle"], partial=True).select(
        key, "target", "model", "cycle", "n_points", "n_scored", "rmse"
    )


# --- models on the per-cycle features


def sequence_regression(
    features: DataFrame,
    inputs: Sequence[str],
    targets: Sequence[str],
    length: int,
    *,
    key: str = "battery_id",
    penalty: float = 1e-2,
    size: int = CHUNK,
) -> DataFrame:
    """Duration and capacity of the next cycle from the last ``length`` cycles."""
    s = sequences(features, [key], "pos", inputs, length, size=size)
    train = s.select(key, F.flatten("x").alias("x"), F.array(*targets).alias("y"))
    parts = gram.partial_sums_of_rows(train, [key], "x", "y")
    models = gram.solve(gram.add_up(parts, [key]), [key], [penalty])
    last = latest_window(features, [key], "pos", "n", inputs, length)
    names = F.array(*[F.lit(t) for t in targets])
    next_cycle = features.groupBy(key).agg((F.max("discharge_cycle_id") + 1).alias("discharge_cycle_id"))
    # Every battery and target has a row; without a whole window or a model it is null.
    wanted = next_cycle.select("*", F.posexplode(names).alias("_k", "target")).withColumn(
        "step", (F.col("_k") + 1).cast("long")
    )
    x = last.filter(F.size("x") == length).withColumn("x", F.flatten("x"))
    out = wanted.join(x, key, "left").join(models.drop("penalty_id"), [key, "step"], "left")
    return out.select(key, "discharge_cycle_id", "target", gram.dot("x", "w").alias("yhat"))


def boosted_trees(
    features: DataFrame,
    targets: Sequence[str],
    *,
    inputs: Sequence[str] = ("voltage_mean", "current_mean", "discharge_cycle_id"),
    key: str = "battery_id",
    trees: int = 20,
    depth: int = 5,
    seed: int = 1502,
):
    """One boosted-tree model per target; its forecast of the next cycle.

    Returns the predictions (the last cycle's means, one cycle on) and the
    fitted models by target.
    """
    spark = features.sparkSession
    to_vec = VectorAssembler(inputCols=list(inputs), outputCol="features")
    train = to_vec.transform(features)
    nxt = features.groupBy(key).agg(
        F.max_by(F.struct(*inputs), "discharge_cycle_id").alias("_r")
    ).select(key, *[F.col(f"_r.{c}").alias(c) for c in inputs])
    nxt = to_vec.transform(nxt.withColumn("discharge_cycle_id", F.col("discharge_cycle_id") + 1))
    # One line per cycle. Written, it has as few partitions as it needs, and
    # every one of the many jobs of a fit reads those.
    train = checkpointed(train.select("features", *targets))

    def fit(t):
        gbt = GBTRegressor(
            featuresCol="features", labelCol=t, predictionCol="yhat", maxIter=trees, maxDepth=depth, seed=seed
        )
        return gbt.fit(train)

    # The models are independent, and each is a chain of short jobs.
    with ThreadPoolExecutor(len(targets)) as pool:
        models = dict(zip(targets, pool.map(inheritable_thread_target(spark)(fit), targets)))
    out = None
    for t, m in models.items():
        p = m.transform(nxt).select(key, "discharge_cycle_id", F.lit(t).alias("target"), "yhat")
        out = p if out is None else out.unionByName(p)
    return out, models
