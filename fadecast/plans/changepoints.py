"""Piecewise-linear trends whose changepoints are selected, one model per cycle.

Knots carry an L1 penalty, all other inputs a ridge penalty. The history of every cycle is
given by the same cumulated sums that the plain models use, extended by the targets' own
products, so a whole path of penalties and the choice among them cost no further pass over
the rows.
"""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fadecast.plans import battery_models, gram

FLAT = 1e-9  # share of a knot's variance that no free input may explain alone
TIE = 1e-9  # share of a knot's own variance added to it: knots that no row separates share their weight
SHARES = tuple(float(x) for x in np.geomspace(1.0, 1e-3, 8))
SWEEPS = 2000


class Fit(NamedTuple):
    """A model at one penalty: weights with the constant first, in the inputs' units."""

    penalty_id: int
    penalty: float
    w: np.ndarray
    n_active: int
    gap: float
    bic: float


def violation(Q: np.ndarray, c: np.ndarray, lam: float, w: np.ndarray) -> float:
    """How far ``w`` is from the conditions of a minimum of w'Qw/2 - c'w + lam |w|."""
    r = c - Q @ w
    return float(np.where(w != 0, np.abs(r - lam * np.sign(w)), np.maximum(np.abs(r) - lam, 0)).max(initial=0))


def on_face(Q: np.ndarray, c: np.ndarray, lam: float, w: np.ndarray) -> np.ndarray:
    """From ``w`` to the minimum among weights of its signs; what reaches 0 stays there."""
    w = w.copy()
    while (on := np.flatnonzero(w)).size:
        try:
            to = np.linalg.solve(Q[np.ix_(on, on)], c[on] - lam * np.sign(w[on]))
        except np.linalg.LinAlgError:
            break
        crossing = np.flatnonzero(np.sign(to) != np.sign(w[on]))
        if not crossing.size:
            w[on] = to
            break
        way = w[on][crossing] / (w[on] - to)[crossing]
        w[on] += way.min() * (to - w[on])
        w[on[crossing[way.argmin()]]] = 0.0
    return w


def descend(Q: np.ndarray, c: np.ndarray, lam: float, start: np.ndarray) -> np.ndarray:
    """Coordinate descent from ``start``. Every few sweeps the weights that are not zero are
    solved together, which ends the descent once the right ones are there: knots beside each
    other are so alike that single steps alone would take thousands of sweeps."""
    w, r, d = start.copy(), c - Q @ start, np.diag(Q)
    for sweep in range(SWEEPS):
        moved = 0.0
        for k in range(len(c)):
            pull = r[k] + d[k] * w[k]
            new = np.sign(pull) * max(abs(pull) - lam, 0.0) / d[k]
            if new != w[k]:
                r -= Q[:, k] * (new - w[k])
                moved, w[k] = max(moved, abs(new - w[k]) * np.sqrt(d[k])), new
        if sweep % 4 == 0:
            w = on_face(Q, c, lam, w)
            r = c - Q @ w
            if (np.abs(r[w == 0]) <= lam + 1e-12).all() and violation(Q, c, lam, w) < 1e-12:
                break
        elif moved < 1e-13:
            break
    return w


def l1_path(m: np.ndarray, knots: slice, ridge: float, shares: Sequence[float] = SHARES) -> list[list[Fit]]:
    """Per target, models along falling penalties from the sums of [1, x, y] with [1, x, y, y].

    ``m`` are the lines of ``gram.outer_sums`` for X = [1, x, y] and Y = y; ``knots`` are the
    penalised places of x. Penalties are shares of the least one that keeps all knots out,
    and act on standardised columns. The free weights of every penalty are solved exactly,
    so the descent runs over the knots alone. Inputs without variation, and knots that
    repeat a free input on the history, get weight 0.
    """
    t = m.shape[1] - m.shape[0]
    p = m.shape[0] - t
    n, mean = m[0, 0], m[0] / m[0, 0]
    cov = m[:, : p + t] / n - np.outer(mean[: p + t], mean[: p + t])
    square = np.maximum(np.diag(m)[: p + t] / n, 1e-300)
    varies = np.diag(cov) > 1e-10 * square
    sd = np.sqrt(np.where(varies, np.diag(cov), 1.0))
    corr = cov / np.outer(sd, sd)
    at = np.arange(1, p)
    held = np.zeros(p, bool)
    held[1:][knots] = True
    free, pen = at[varies[at] & ~held[at]], at[varies[at] & held[at]]
    A = corr[np.ix_(free, free)] + ridge * np.eye(len(free))
    inner = np.linalg.pinv(A, hermitian=True)
    # A knot before all rows only repeats the straight line.
    pen = pen[1 - (corr[np.ix_(pen, free)] ** 2).max(axis=1, initial=0) > FLAT]
    Q = corr[np.ix_(pen, pen)] - corr[np.ix_(pen, free)] @ inner @ corr[np.ix_(free, pen)]
    Q[np.diag_indices_from(Q)] *= 1 + TIE
    out = []
    for y in range(p, p + t):
        b = corr[:, y] if varies[y] else np.zeros(p + t)
        c = b[pen] - corr[np.ix_(pen, free)] @ inner @ b[free]
        most, w, fits = float(np.abs(c).max(initial=0)), np.zeros(len(pen)), []
        for k, share in enumerate(shares):
            lam = most * share
            w = descend(Q, c, lam, w) if lam > 0 else w
            full = np.zeros(p)
            full[pen] = w
            full[free] = inner @ (b[free] - corr[np.ix_(free, pen)] @ w)
            rss = max(1 - 2 * b[:p] @ full + full @ corr[:p, :p] @ full, 1e-12)
            active = int((w != 0).sum())
            weights = full * sd[y] / sd[:p] if varies[y] else full
            weights[0] = mean[y] - mean[1:p] @ weights[1:]
            fits.append(Fit(k, lam, weights, active, violation(Q, c, lam, w), n * np.log(rss) + np.log(n) * active))
        out.append(fits)
    return out


_FITS = [
    T.StructField("step", T.LongType()),
    T.StructField("penalty_id", T.LongType()),
    T.StructField("penalty", T.DoubleType()),
    T.StructField("w", T.ArrayType(T.DoubleType())),
    T.StructField("n_rows", T.LongType()),
    T.StructField("n_active", T.LongType()),
    T.StructField("gap", T.DoubleType()),
    T.StructField("chosen", T.BooleanType()),
]


def models(
    rows: DataFrame,
    x: str,
    y: str,
    knots: slice,
    *,
    ridge: float = 1e-3,
    shares: Sequence[float] = SHARES,
    key: str = "battery_id",
    max_history: int | None = None,
) -> DataFrame:
    """The path of each cycle's models: one line per cycle, target (``step``) and penalty.

    ``gap`` is the distance from the conditions of the minimum in standardised units;
    ``chosen`` marks the penalty with the least Bayesian information criterion, of equal ones
    the largest penalty. A cycle without a complete row before it has no line.
    """
    both = rows.withColumn("_x", F.concat(x, y))
    parts = gram.partial_sums_of_rows(both, [key, "cycle"], "_x", y)
    sums = gram.add_up(parts, [key, "cycle"])
    wanted = rows.select(key, "cycle").distinct()
    history = gram.cumulate(sums, [key], "cycle", wanted, max_history)
    schema = T.StructType([*[history.schema[c] for c in (key, "cycle")], *_FITS])

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        m = gram.matrix(pdf)
        out = []
        if m[0, 0] >= 1:
            for step, fits in enumerate(l1_path(m, knots, ridge, shares), start=1):
                best = min(fits, key=lambda f: (f.bic, f.penalty_id)).penalty_id
                out += [
                    (step, f.penalty_id, f.penalty, f.w, int(m[0, 0]), f.n_active, f.gap, f.penalty_id == best)
                    for f in fits
                ]
        res = pd.DataFrame(out, columns=[f.name for f in _FITS])
        for c in (key, "cycle"):
            res[c] = pdf[c].iloc[0]
        return res[schema.names]

    return gram.spread(history, [key, "cycle"]).groupBy(key, "cycle").applyInPandas(run, schema)


# The trend knots among the inputs of the additive model, after the straight line.
TREND_KNOTS = slice(1, 1 + battery_models.KNOTS)


def additive_rows(measured: DataFrame, targets: Sequence[str], exog: Sequence[str], key: str = "battery_id") -> DataFrame:
    """``x``: trend, seasonality and regressors of each row; ``y``: its targets."""
    span = measured.groupBy(key).agg(F.min("datetime_").alias("_t0"), F.max("datetime_").alias("_t1"))
    x = battery_models.additive_inputs(F.col("datetime_"), F.col("_t0"), F.col("_t1"), exog)
    return measured.join(span, key).select(
        key, "cycle", "event_id", x.alias("x"), F.array(*[F.col(t).cast("double") for t in targets]).alias("y")
    )


def additive_changepoints(
    measured: DataFrame,
    *,
    key: str = "battery_id",
    targets: Sequence[str] = battery_models.TARGETS,
    exog: Sequence[str] = battery_models.EXOG,
    max_history: int | None = None,
) -> DataFrame:
    """Each target over each cycle from a trend with selected changepoints, seasonality and
    regressors; null where a cycle has no history."""
    rows = additive_rows(measured, targets, exog, key)
    found = models(rows, "x", "y", TREND_KNOTS, key=key, max_history=max_history).filter("chosen")
    out = battery_models.with_models(rows.drop("y"), found.select(key, "cycle", "step", "w"), "x", targets, key)
    return out.select(key, "cycle", "target", "event_id", "yhat")
