"""Whitening by an incremental eigendecomposition.

Each task keeps the eigenvectors and eigenvalues of the scatter of the vectors it has seen.
A new vector is a centred rank-one update: its eigenvalues are the roots of a secular
equation, one between every two old ones; directions the vector does not touch, and all but
one direction of equal eigenvalues, are deflated and stay. The spectra of two tasks are
combined by rank-one updates with the scaled eigenvectors of one and the difference of the
means; groups of spectra are combined on Spark until one is left. Its eigenvectors are only
a basis: a Rayleigh-Ritz step over all vectors, centred by their exact integer mean, gives
the components to double precision.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fadecast.llm import common
from fadecast.llm.vafile import LARGEST, _pieces, _vectors

EPS = np.finfo(float).eps
STEPS = 60  # of the root finder at most; bisection alone needs no more
COMBINED = 8  # spectra combined by one group
VANISHING = 1e-12  # of the trace: an eigenvalue below is 0

_L, _D = T.LongType(), T.DoubleType()


# --- the secular equation


def secular_roots(lam: np.ndarray, z: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Roots of 1 + sum z_j^2 / (lam_j - mu) for ascending ``lam`` and no zero in ``z``,
    and the matrix lam_j - mu_i, free of cancellation."""
    k, zz = len(lam), z * z
    upper = np.append(lam[1:], lam[-1] + zz.sum())
    gap = upper - lam
    from_left = lam[:, None] - lam[None, :]  # pole j seen from pole i
    middle = 1.0 + (zz[:, None] / (from_left - gap / 2)).sum(axis=0)
    # The origin of each root is the nearer pole; the last root stays with its own.
    right = (middle < 0) & (np.arange(k) < k - 1)
    delta = from_left - np.where(right, gap, 0.0)
    # Where the middle was exact for the left pole, so is it for the right one.
    for i in np.flatnonzero(right):
        delta[:, i] = lam - lam[i + 1]
    lo = np.where(right, -gap / 2, np.where(middle < 0, gap / 2, 0.0))
    hi = np.where(right, 0.0, np.where(middle < 0, gap, gap / 2))
    tau = (lo + hi) / 2
    own, after = np.arange(k), np.minimum(np.arange(k) + 1, k - 1)
    below = np.tri(k, k, dtype=bool).T  # pole j at or left of root i
    last = np.arange(k) == k - 1
    with np.errstate(all="ignore"):
        for _ in range(STEPS):
            part = delta - tau
            term = zz[:, None] / part
            slope = term / part
            f = 1.0 + term.sum(axis=0)
            size = 1.0 + np.abs(term).sum(axis=0)
            lo, hi = np.where(f < 0, tau, lo), np.where(f > 0, tau, hi)
            done = (np.abs(f) <= 4 * EPS * size) | (hi - lo <= 2 * EPS * np.abs(tau))
            if done.all():
                break
            # A rational model with the two neighbouring poles, matched in value and slope.
            psi, dpsi = (term * below).sum(axis=0), (slope * below).sum(axis=0)
            phi, dphi = (term * ~below).sum(axis=0), (slope * ~below).sum(axis=0)
            a, b = part[own, own], part[after, own]
            s, big = a * a * dpsi, b * b * dphi
            c = 1.0 + psi - a * dpsi + phi - b * dphi
            a1, a0 = c * (a + b) + s + big, a * b * f
            root = np.sqrt(np.maximum(a1 * a1 - 4 * c * a0, 0.0))
            step = np.where(a1 > 0, 2 * a0 / (a1 + root), (a1 - root) / (2 * c))
            step = np.where(last, a + s / (1.0 + psi - a * dpsi), step)
            new = tau + step
            inside = np.isfinite(new) & (new > lo) & (new < hi)
            tau = np.where(done, tau, np.where(inside, new, (lo + hi) / 2))
    base = np.where(right, lam[after], lam)
    return base + tau, delta - tau


def _vectors_of(lam: np.ndarray, z: np.ndarray, part: np.ndarray) -> np.ndarray:
    """Eigenvectors for the computed roots, of weights for which these roots are exact."""
    k = len(lam)
    with np.errstate(all="ignore"):
        poles = lam[:, None] - lam[None, :]
        # Root i is paired with pole i left of j, with pole i + 1 from j on, the last with none.
        i = np.arange(k)
        paired = np.where(i[None, :] < i[:, None], poles, np.roll(poles, -1, axis=1))
        paired[:, -1] = -1.0
        weight = np.sqrt(np.abs(np.prod(part / paired, axis=1)))
    w = np.where(z < 0, -weight, weight)[:, None] / part
    return w / np.sqrt((w * w).sum(axis=0))


def rank_one(lam: np.ndarray, q: np.ndarray, v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues (ascending) and eigenvectors of q diag(lam) q' + v v'."""
    z = q.T @ v
    total = float(z @ z)
    if total == 0.0:
        return lam, q
    size = max(float(lam[-1]), total)
    tiny = 8 * EPS * size
    # Of equal eigenvalues one direction takes the whole of the vector, the others stay.
    near = np.flatnonzero(np.diff(lam) <= tiny)
    if len(near):
        q = q.copy()
        for g in np.split(near, np.flatnonzero(np.diff(near) > 1) + 1):
            at = slice(g[0], g[-1] + 2)
            part = z[at]
            norm = np.sqrt(part @ part)
            if norm > 0:
                u = part.copy()
                u[-1] += norm if u[-1] >= 0 else -norm
                u /= np.sqrt(u @ u)
                q[:, at] -= 2.0 * np.outer(q[:, at] @ u, u)
                z[at] = 0.0
                z[at.stop - 1] = -norm if part[-1] >= 0 else norm
                z[at.stop - 1] = float(q[:, at.stop - 1] @ v)
    touched = np.abs(z) * np.sqrt(total) > tiny
    if not touched.any():
        return lam, q
    roots, part = secular_roots(lam[touched], z[touched])
    out, vec = lam.copy(), q.copy()
    out[touched] = roots
    vec[:, touched] = q[:, touched] @ _vectors_of(lam[touched], z[touched], part)
    order = np.argsort(out, kind="stable")
    return out[order], vec[:, order]


@dataclass
class Spectrum:
    """Count, mean and eigendecomposition of the scatter of some vectors."""

    n: int
    mean: np.ndarray
    lam: np.ndarray
    q: np.ndarray

    @classmethod
    def empty(cls, dims: int) -> "Spectrum":
        return cls(0, np.zeros(dims), np.zeros(dims), np.eye(dims))

    def add(self, x: np.ndarray) -> None:
        diff = x - self.mean
        self.n += 1
        self.mean = self.mean + diff / self.n
        if self.n > 1:
            self.lam, self.q = rank_one(self.lam, self.q, diff * np.sqrt((self.n - 1) / self.n))

    def join(self, other: "Spectrum") -> None:
        if not self.n or not other.n:
            if other.n:
                self.n, self.mean, self.lam, self.q = other.n, other.mean, other.lam, other.q
            return
        n = self.n + other.n
        for lam, q in zip(other.lam, other.q.T):
            if lam > 0:
                self.lam, self.q = rank_one(self.lam, self.q, np.sqrt(lam) * q)
        diff = other.mean - self.mean
        self.lam, self.q = rank_one(self.lam, self.q, diff * np.sqrt(self.n * other.n / n))
        self.mean, self.n = self.mean + diff * (other.n / n), n


# --- on Spark

_SPECTRUM = T.StructType(
    [T.StructField("part", _L), T.StructField("n", _L)]
    + [T.StructField(c, T.ArrayType(_D)) for c in ("mean", "lam", "q")]
)


def _as_batch(part: int, s: Spectrum) -> pa.RecordBatch:
    cols = [[part], [s.n], [s.mean.tolist()], [s.lam.tolist()], [s.q.ravel().tolist()]]
    kinds = [pa.int64(), pa.int64(), *[pa.list_(pa.float64())] * 3]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds)], names=_SPECTRUM.names)


def _of_row(mean, lam, q, n) -> Spectrum:
    lam = np.asarray(lam)
    return Spectrum(int(n), np.asarray(mean), lam, np.asarray(q).reshape(len(lam), -1))


def spectrum(x: DataFrame, dims: int) -> Spectrum:
    """The spectrum of all vectors of column ``x``: one per task, combined in groups."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        s = Spectrum.empty(dims)
        for b in _pieces(batches):
            for v in _vectors(b.column("x"), dims).astype(float):
                s.add(v)
        if s.n:
            yield _as_batch(TaskContext.get().partitionId(), s)

    def combine(rows: pa.Table) -> pa.Table:
        out = Spectrum.empty(dims)
        for r in sorted(rows.to_pylist(), key=lambda r: r["part"]):
            out.join(_of_row(r["mean"], r["lam"], r["q"], r["n"]))
        part = rows.column("part")[0].as_py() // COMBINED
        return pa.Table.from_batches([_as_batch(part, out)])

    parts = common.written(x.select("x").mapInArrow(run, _SPECTRUM), "spectra")
    while parts.count() > 1:
        grouped = parts.groupBy(F.floor(F.col("part") / COMBINED))
        parts = common.written(grouped.applyInArrow(combine, _SPECTRUM), "spectra")
    r = parts.first()
    return _of_row(r["mean"], r["lam"], r["q"], r["n"])


_CELL = T.StructType([T.StructField("i", _L), T.StructField("j", _L), T.StructField("v", _D)])


def _moments(x: DataFrame, dims: int, mean: np.ndarray, basis: np.ndarray) -> np.ndarray:
    """Mean of the outer products of (x - mean) basis, with a leading constant 1."""
    k = basis.shape[1] + 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((k, k))
        for b in _pieces(batches):
            p = (_vectors(b.column("x"), dims) - mean) @ basis
            p = np.hstack([np.ones((len(p), 1)), p])
            total += p.T @ p
        i, j = np.divmod(np.arange(k * k), k)
        yield pa.RecordBatch.from_arrays([pa.array(i), pa.array(j), pa.array(total.ravel())], names=_CELL.names)

    out = np.zeros((k, k))
    for r in x.select("x").mapInArrow(run, _CELL).groupBy("i", "j").agg(F.sum("v").alias("v")).collect():
        out[r.i, r.j] = r.v
    return out / out[0, 0]


@dataclass
class Whitening:
    """Mean, components as columns by falling eigenvalue, and how well they whiten."""

    n: int
    sums: list[int]
    values: np.ndarray
    vectors: np.ndarray
    trace: float
    identity_error: float


def fit(distinct: DataFrame, dims: int, n_components: int = 4) -> Whitening | None:
    """Components of the distinct integer vectors in column ``x``; None without a vector."""
    row = distinct.agg(F.count(F.lit(1)).alias("n"), *[F.sum(F.get("x", F.lit(d))).alias(f"s{d}") for d in range(dims)]).first()
    if not row.n:
        return None
    sums = [row[f"s{d}"] for d in range(dims)]
    mean = np.array([s / row.n for s in sums])
    basis, _ = np.linalg.qr(spectrum(distinct, dims).q)
    ritz = _moments(distinct, dims, mean, basis)[1:, 1:]
    values, turn = np.linalg.eigh((ritz + ritz.T) / 2)
    order = np.argsort(-values)[: min(n_components, dims)]
    trace = float(np.trace(ritz))
    values, vectors = np.maximum(values[order], 0.0), (basis @ turn)[:, order]
    values[values <= VANISHING * trace] = 0.0
    known = values > 0
    error = 0.0
    if known.any():
        m = _moments(distinct, dims, mean, vectors[:, known] / np.sqrt(values[known]))
        covariance = m[1:, 1:] - np.outer(m[0, 1:], m[0, 1:])
        error = float(np.abs(covariance - np.eye(known.sum())).max())
    return Whitening(int(row.n), sums, values, vectors, trace, error)


def _deviations(x: np.ndarray, n: int, sums: list[int]) -> list[int | None]:
    """Exact sums of (n x - S)^2; None where they leave 64 bits."""
    if not len(x):
        return []
    reach = n * int(np.abs(x).max()) + max(map(abs, sums))
    if reach * reach * x.shape[1] < 1 << 63:
        diff = n * x - np.array(sums, np.int64)
        return np.einsum("nd,nd->n", diff, diff).tolist()
    exact = [sum((n * a - s) ** 2 for a, s in zip(v, sums)) for v in x.tolist()]
    return [e if e < 1 << 63 else None for e in exact]


_OUT = ["component", "n", "deviation", "whitened", "explained", "identity_error"]


def whiten(vectors: DataFrame, key: str = "vec_id", vec: str = "embedding", *, n_components: int = 4) -> DataFrame:
    """``key`` and, for each component, ``component, n, deviation, whitened, explained,
    identity_error`` per vector.

    Vectors that are null, or hold null or non-finite components, are left out, as are those
    whose length is not the commonest one (of equally common ones the smaller). Components are
    limited to 2**27 in size. Repeated rows give equal rows; the fit has each vector once. A
    component without variance has a null ``whitened`` and explains 0; a ``deviation`` beyond
    64 bits is null. An empty table gives an empty result. Only ``key`` and ``vec`` are read.
    """
    spark = vectors.sparkSession
    schema = T.StructType(
        [vectors.schema[key], T.StructField("component", T.IntegerType()), T.StructField("n", _L),
         T.StructField("deviation", _L), *[T.StructField(c, _D) for c in _OUT[3:]]]
    )
    whole = F.col(vec).isNotNull() & F.forall(
        vec, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v.cast("double")) < F.lit(float("inf")))
    )
    bound = F.lit(float(LARGEST))
    x = F.transform(
        vec, lambda v: F.greatest(-bound, F.least(bound, F.floor(v.cast("double") * 256).cast("double"))).cast("long")
    )
    rows = vectors.filter(whole).select(F.col(key).alias("_key"), x.alias("x")).filter(F.size("x") > 0)
    rows = common.written(rows, "vectors")
    common_one = rows.groupBy(F.size("x").alias("d")).count().orderBy(F.desc("count"), "d").first()
    if common_one is None:
        return spark.createDataFrame([], schema)
    dims = common_one.d
    rows = rows.filter(F.size("x") == dims)
    distinct = common.written(rows.select("x").distinct(), "distinct")
    w = fit(distinct, dims, n_components)
    k = len(w.values)
    scale = np.where(w.values > 0, 1 / np.sqrt(np.maximum(w.values, 1e-300)), np.nan)
    mean = np.array([s / w.n for s in w.sums])
    explained = w.values / w.trace if w.trace > 0 else np.zeros(k)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in _pieces(batches):
            v = _vectors(b.column("x"), dims)
            p = ((v - mean) @ w.vectors) * scale
            each = np.repeat(np.arange(len(v)), k)
            comp = np.tile(np.arange(k), len(v))
            deviation = pa.array(_deviations(v, w.n, w.sums), pa.int64()).take(pa.array(each))
            yield pa.RecordBatch.from_arrays(
                [
                    b.column("_key").take(pa.array(each)), pa.array((comp + 1).astype(np.int32)),
                    pa.array(np.full(len(each), w.n)), deviation,
                    pa.array(p.ravel(), from_pandas=True), pa.array(explained[comp]),
                    pa.array(np.full(len(each), w.identity_error)),
                ],
                names=schema.names,
            )

    return rows.mapInArrow(run, schema)


def op13_whiten_embeddings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whiten(common.table(spark, sf_dir, "embeddings"))
