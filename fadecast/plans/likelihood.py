"""Autoregressive moving-average models per cycle by exact Gaussian likelihood.

A target follows known regressors with an error of order (1, 1, 1):

    dy[t] = beta dx[t] + n[t],    n[t] = phi n[t-1] + e[t] + theta e[t-1].

Every cycle has its own model on all earlier cycles. A state-space filter would read each
history once per cycle and per step of the search, which squares the table. Here the rows
are read once for all cycles and all steps:

* For a fixed theta the innovations are linear in the rows filtered by 1 / (1 + theta L). The
  outer products of filtered rows, cumulated over cycles, are therefore all that any phi, beta
  and history needs.
* In s = atanh(theta) these sums are smooth: they are kept at the Chebyshev nodes of the range
  of s and interpolated between them.
* The unknown state before the first row is one more linear term, an impulse that decays by
  -theta, with variance (phi + theta)^2 / (1 - phi^2). Integrating it out gives the exact
  likelihood: with S the sums of innovations e and impulse b and c that variance,
  Q = S_ee - c S_eb^2 / (1 + c S_bb) and
  -2 log L = n log(2 pi Q / n) + n + log(1 + c S_bb).
* theta stays within ``BOUND``, so a filter forgets a row after ``MEMORY`` others. A chunk that
  sees so many rows of its neighbour has its exact state; chunks are not chained.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fadecast.operators.ordered import segments
from fadecast.plans import gram
from fadecast.plans.battery_models import EXOG, TARGETS, cycle_starts, numbered
from fadecast.session import checkpointed

BOUND = 0.98
MEMORY = 1536  # 0.98 ** 1536 = 3e-14
NODES = 48
LEAST = 12  # rows below which a history has no model
ROUNDS = 22

_D, _L, _A = T.DoubleType(), T.LongType(), T.ArrayType(T.DoubleType())


def chebyshev(nodes: int = NODES, bound: float = BOUND) -> np.ndarray:
    """The thetas at which sums are kept, falling."""
    return np.tanh(np.arctanh(bound) * np.cos(np.pi * (np.arange(nodes) + 0.5) / nodes))


def between(thetas: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Weights (at x nodes) that interpolate values kept at ``thetas`` (Chebyshev nodes)."""
    if len(thetas) == 1:
        if not np.allclose(at, thetas[0], rtol=0, atol=1e-12):
            raise ValueError("one node serves one theta")
        return np.ones((len(at), 1))
    s, x = np.arctanh(thetas), np.arctanh(np.asarray(at, dtype=float))
    j = np.arange(len(s))
    w = (-1.0) ** j * np.sin(np.pi * (j + 0.5) / len(s))
    gap = x[:, None] - s[None, :]
    hit = np.abs(gap) < 1e-14
    out = w / np.where(hit, 1.0, gap)
    out /= out.sum(axis=1, keepdims=True)
    exact = hit.any(axis=1)
    out[exact] = hit[exact]
    return out


def filtered(x: np.ndarray, thetas: np.ndarray) -> np.ndarray:
    """z[t] = x[t] - theta z[t-1] from zero, per theta (thetas x rows x columns).

    By doubling: a filter of length 2 L is that of length L plus its own shift by L.
    """
    z = np.repeat(x[None, :, :], len(thetas), axis=0)
    shift, factor = 1, -thetas
    while shift < len(x) and np.abs(factor).max() > 1e-18:
        z[:, shift:] += factor[:, None, None] * z[:, :-shift]
        shift, factor = 2 * shift, factor * factor
    return z


def filtered_sums(
    rows: DataFrame,
    key: str,
    targets: Sequence[str],
    exog: Sequence[str],
    thetas: np.ndarray,
    size: int,
) -> DataFrame:
    """Per task, ``key`` and cycle: lines ``i`` >= 0 of the sums of all nodes side by side.

    The columns of a node are the filtered differences of targets and regressors, the same a
    row earlier, and the impulse. Line -1 of a cycle is what the rows before it leave behind:
    their last values, then the filtered differences of their last row, node by node.
    ``rows`` has ``pos`` and no missing number.
    """
    names = [*targets, *exog]
    labels = [rows.schema[key], T.StructField("cycle", _L)]
    seg = segments(rows, [key], "pos", ["cycle", *names], back=MEMORY, size=size)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for row in pdf.itertuples(index=False):
                held: dict[tuple, np.ndarray] = {}
                x = np.column_stack([np.asarray(getattr(row, c), dtype=float) for c in names])
                cycle, start = np.asarray(row.cycle), int(row.start)
                z = filtered(np.vstack([np.zeros((1, x.shape[1])), np.diff(x, axis=0)]), thetas)
                own = np.arange(max(int(row.own_from) - start, 1), len(x))
                for c in np.unique(cycle[own]) if len(own) else ():
                    at = own[cycle[own] == c]
                    impulse = np.power(-thetas[:, None], at + start - 1.0)
                    d = np.concatenate([z[:, at], z[:, at - 1], impulse[:, :, None]], axis=2)
                    s = d.transpose(0, 2, 1) @ d
                    held[(getattr(row, key), int(c))] = s.transpose(1, 0, 2).reshape(s.shape[1], -1)
                if held:
                    yield gram.lines(held, [key, "cycle"])
                first = own[cycle[own] != cycle[own - 1]] if len(own) else own
                if len(first):
                    yield pd.DataFrame({
                        key: [getattr(row, key)] * len(first),
                        "cycle": cycle[first].astype(np.int64),
                        "i": np.full(len(first), -1, dtype=np.int32),
                        "stripe": [np.concatenate([x[t - 1], z[:, t - 1].ravel()]) for t in first],
                    })

    return seg.mapInPandas(run, T.StructType([*labels, *gram.STRIPE]))


class Profile:
    """The likelihood of one target over one history, from its sums."""

    def __init__(self, sums: np.ndarray, thetas: np.ndarray, target: int, targets: int):
        d = sums.shape[0]
        m = (d - 1) // 2
        self.thetas = thetas
        self.columns = [target, *range(targets, m)]
        lagged = [m + c for c in self.columns]
        pick = [*self.columns, *lagged, d - 1]
        s = sums.reshape(d, len(thetas), d).transpose(1, 0, 2)
        self.sums = s[:, pick][:, :, pick]

    def at(self, phi: np.ndarray, theta: np.ndarray, n: int):
        """-2 log L, beta and innovation variance of each pair, arrays of one length."""
        k = len(self.columns)
        S = np.tensordot(between(self.thetas, theta), self.sums, axes=1)
        a, ab, bb = S[:, :k, :k], S[:, :k, k : 2 * k], S[:, k : 2 * k, k : 2 * k]
        p = phi[:, None, None]
        E = a - p * (ab + ab.transpose(0, 2, 1)) + p * p * bb
        eb = S[:, :k, -1] - phi[:, None] * S[:, k : 2 * k, -1]
        c = (phi + theta) ** 2 / (1 - phi * phi)
        more = 1 + c * np.maximum(S[:, -1, -1], 0)
        E = E - (c / more)[:, None, None] * eb[:, :, None] * eb[:, None, :]
        q, beta = E[:, 0, 0], np.zeros((len(phi), k - 1))
        if k > 1:
            scale = np.sqrt(np.maximum(np.diagonal(E, axis1=1, axis2=2)[:, 1:], 0))
            scale[scale <= 0] = 1.0
            X = E[:, 1:, 1:] / (scale[:, :, None] * scale[:, None, :])
            X[:, np.arange(k - 1), np.arange(k - 1)] += 1e-10
            g = E[:, 1:, 0] / scale
            b = np.linalg.solve(X, g[:, :, None])[:, :, 0]
            # The sum at b itself, so that the small ridge does not enter the likelihood.
            X[:, np.arange(k - 1), np.arange(k - 1)] -= 1e-10
            q = q - 2 * (b * g).sum(1) + np.einsum("ni,nij,nj->n", b, X, b)
            beta = b / scale
        var = np.maximum(q, 1e-14 * np.maximum(a[:, 0, 0], 1e-300)) / n
        return n * np.log(2 * np.pi * var) + n + np.log(more), beta, var

    def start(self, n: int) -> tuple[float, float]:
        """The best phi of a grid without (nearly, at the node next to zero) a moving average."""
        near = np.array([self.thetas[np.argmin(np.abs(self.thetas))]])
        phis = np.linspace(-BOUND, BOUND, 41)
        value = self.at(phis, np.repeat(near, len(phis)), n)[0]
        return float(phis[value.argmin()]), float(near[0])

    def best(self, n: int) -> tuple[float, float]:
        """phi and theta of the largest likelihood: a grid over both, then finer ones around its best.

        The grid is even in atanh. A finer one reaches two of its steps to each side and so
        may move on; the best pair found is kept, hence the likelihood never falls.
        """
        edge = np.arctanh(BOUND)
        axis = np.linspace(-edge, edge, 25)
        r, s = (g.ravel() for g in np.meshgrid(axis, axis, indexing="ij"))
        r0, s0 = np.arctanh(self.start(n))
        r, s = np.append(r, r0), np.append(s, s0)
        step, best = axis[1] - axis[0], np.inf
        at = (0.0, 0.0)
        for _ in range(ROUNDS + 1):
            value = self.at(np.tanh(r), np.tanh(s), n)[0]
            k = int(value.argmin())
            if value[k] < best:
                best, at = value[k], (r[k], s[k])
            step /= 2
            moves = step * np.arange(-2, 3)
            r, s = (g.ravel() for g in np.meshgrid(at[0] + moves, at[1] + moves, indexing="ij"))
            r, s = np.clip(r, -edge, edge), np.clip(s, -edge, edge)
        return float(np.tanh(at[0])), float(np.tanh(at[1]))


def models(
    measured: DataFrame,
    *,
    key: str = "battery_id",
    targets: Sequence[str] = TARGETS,
    exog: Sequence[str] = EXOG,
    fixed: tuple[float, float] | None = None,
    size: int = 16384,
) -> DataFrame:
    """One model per target and cycle on the rows of all earlier cycles.

    ``key, cycle, target, n, phi, theta, beta, sigma2, loglik, start_loglik, aic`` and what the
    forecast starts from: ``y_last, x_last, n_next`` (the error one step ahead). ``n`` is the
    number of differences. ``start_loglik`` is that of the best model without a moving average
    on a grid of phi. ``fixed`` gives (phi, theta) instead of searching them. Rows with a
    missing target or regressor are left out, so differences run over them; a cycle whose
    history has fewer than 12 differences has no model.
    """
    names = [*targets, *exog]
    rows = numbered(measured.filter(_complete(names)), key).select(key, F.col("cycle").cast("long").alias("cycle"), "pos", *names)
    thetas = chebyshev() if fixed is None else np.array([fixed[1]])
    # Read twice, as sums and as states: written once.
    parts = checkpointed(filtered_sums(rows, key, targets, exog, thetas, size))
    starts = cycle_starts(rows, key)
    sums = gram.add_up(parts.filter("i >= 0"), [key, "cycle"])
    history = gram.cumulate(sums, [key], "cycle", starts.select(key, "cycle"))
    state = parts.filter("i = -1").join(starts.select(key, "cycle", F.col("cycle_start").alias("n")), [key, "cycle"])
    state = state.select(key, "cycle", "i", "stripe", (F.col("n") - 1).alias("n"))
    lines = history.select(key, "cycle", "i", "stripe", F.lit(None).cast("long").alias("n")).unionByName(state)
    schema = T.StructType([
        rows.schema[key], T.StructField("cycle", _L), T.StructField("target", T.StringType()), T.StructField("n", _L),
        *[T.StructField(c, _D) for c in ("phi", "theta")], T.StructField("beta", _A),
        *[T.StructField(c, _D) for c in ("sigma2", "loglik", "start_loglik", "aic", "y_last")],
        T.StructField("x_last", _A), T.StructField("n_next", _D),
    ])

    def fit(pdf: pd.DataFrame) -> pd.DataFrame:
        last, body = pdf[pdf["i"] == -1], pdf[pdf["i"] >= 0]
        out = []
        if len(last) and len(body) and int(last["n"].iloc[0]) >= LEAST:
            n, end = int(last["n"].iloc[0]), np.asarray(last["stripe"].iloc[0], dtype=float)
            m = len(names)
            level, z = end[:m], end[m:].reshape(len(thetas), m)
            S = gram.matrix(body)
            for k, t in enumerate(targets):
                out.append((t, n, *_model(Profile(S, thetas, k, len(targets)), n, fixed, level, z, k, len(targets))))
        got = pd.DataFrame(out, columns=schema.names[2:])
        got.insert(0, "cycle", pdf["cycle"].iloc[0])
        got.insert(0, key, pdf[key].iloc[0])
        return got

    return gram.spread(lines, [key, "cycle"]).groupBy(key, "cycle").applyInPandas(fit, schema)


def _model(profile: Profile, n: int, fixed, level: np.ndarray, z: np.ndarray, target: int, targets: int) -> tuple:
    phi, theta = fixed or profile.best(n)
    first = fixed or profile.start(n)
    value, beta, var = (v[0] for v in profile.at(np.array([phi]), np.array([theta]), n))
    start = profile.at(np.array([first[0]]), np.array([first[1]]), n)[0][0]
    now = between(profile.thetas, np.array([theta]))[0] @ z
    weights = np.concatenate([[1.0], -beta])
    columns = [target, *range(targets, len(level))]
    # With u the filtered errors, n = (1 + theta L) u and e = (1 - phi L) u: one step ahead,
    # phi n + theta e is (phi + theta) u.
    u = float(weights @ now[columns])
    S = np.tensordot(between(profile.thetas, np.array([theta])), profile.sums, axes=1)[0]
    k = len(profile.columns)
    eb = weights @ (S[:k, -1] - phi * S[k : 2 * k, -1])
    c = (phi + theta) ** 2 / (1 - phi * phi)
    h = c * eb / (1 + c * S[-1, -1])
    # The state before the first row takes its share of the last innovation away.
    ahead = (phi + theta) * u - theta * (-theta) ** (n - 1) * h
    return (phi, theta, beta, float(var), -value / 2, -start / 2, value + 2 * (k + 2), float(level[target]),
            level[targets:], float(ahead))


def _complete(names: Sequence[str]) -> Column:
    kept = F.lit(True)
    for c in names:
        kept = kept & F.col(c).isNotNull() & ~F.isnan(F.col(c).cast("double"))
    return kept


def arimax_likelihood(
    measured: DataFrame,
    *,
    key: str = "battery_id",
    targets: Sequence[str] = TARGETS,
    exog: Sequence[str] = EXOG,
    size: int = 16384,
) -> DataFrame:
    """Each target over each cycle, from the model of the cycles before it.

    ``key, cycle, target, event_id, step, yhat, reason``. A row with a missing target or
    regressor has neither step nor forecast (reason ``missing``), one without enough history
    has no forecast (``history``).
    """
    names = [*targets, *exog]
    rows = numbered(measured.filter(_complete(names)), key).select(key, F.col("cycle").cast("long").alias("cycle"), "event_id", "pos", *exog)
    rows = rows.join(cycle_starts(rows, key).select(key, "cycle", "cycle_start"), [key, "cycle"])
    rows = rows.withColumn("step", F.col("pos") - F.col("cycle_start") + 1)
    rows = rows.withColumn("target", F.explode(F.array(*[F.lit(t) for t in targets])))
    found = models(measured, key=key, targets=targets, exog=exog, size=size)
    m = found.select(key, "cycle", "target", "phi", "beta", "y_last", "x_last", "n_next")
    done = rows.join(m, [key, "cycle", "target"], "left")
    phi = F.col("phi")
    drift = F.col("n_next") * (1 - F.pow(phi, F.col("step"))) / (1 - phi)
    yhat = F.col("y_last") + drift
    for k, c in enumerate(exog):
        yhat = yhat + F.col("beta")[k] * (F.col(c).cast("double") - F.col("x_last")[k])
    out = done.select(
        key, "cycle", "target", "event_id", "step", yhat.alias("yhat"),
        F.when(phi.isNull(), F.lit("history")).alias("reason"),
    )
    lost = measured.filter(~_complete(names)).select(
        key, F.col("cycle").cast("long").alias("cycle"),
        F.explode(F.array(*[F.lit(t) for t in targets])).alias("target"), "event_id",
        F.lit(None).cast("long").alias("step"), F.lit(None).cast("double").alias("yhat"),
        F.lit("missing").alias("reason"),
    )
    return out.unionByName(lost)
