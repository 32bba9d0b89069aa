"""Least squares on Spark from sums of outer products.

A linear learner needs only X'X and X'Y. Tasks add them up over their rows,
Spark adds the partial sums row by row of the matrix, and one small group per
model solves it. Nothing that grows with the training rows leaves the tasks,
and models fitted on growing histories share one pass: their sums are
cumulative over blocks of rows.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

Labelled = tuple[tuple, np.ndarray, np.ndarray]
HELD_FLOATS = 16_000_000

STRIPE = [T.StructField("i", T.IntegerType()), T.StructField("stripe", T.ArrayType(T.DoubleType()))]


def outer_sums(X: np.ndarray, Y: np.ndarray) -> np.ndarray | None:
    """[X'X | X'Y] of the lines without a missing number, None without a line."""
    whole = np.isfinite(X).all(axis=1) & np.isfinite(Y).all(axis=1)
    if not whole.all():
        X, Y = X[whole], Y[whole]
    return X.T @ np.hstack([X, Y]) if len(X) else None


def partial_sums(
    df: DataFrame, labels: Sequence[T.StructField], design: Callable[[tuple], Iterable[Labelled]]
) -> DataFrame:
    """Per task and label, the rows of [X'X | X'Y].

    ``design`` turns one input row into labelled ``(label, X, Y)`` blocks; lines with a
    missing number do not take part. A task holding many labels hands its sums on before
    they fill its memory.
    """
    names = [f.name for f in labels]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: dict[tuple, np.ndarray] = {}
        floats = 0
        for pdf in batches:
            for row in pdf.itertuples(index=False):
                for label, X, Y in design(row):
                    part = outer_sums(X, Y)
                    if part is None:
                        continue
                    if label in held:
                        held[label] += part
                    else:
                        held[label] = part
                        floats += part.size
                    if floats > HELD_FLOATS:
                        yield lines(held, names)
                        held, floats = {}, 0
        if held:
            yield lines(held, names)

    return df.mapInPandas(run, T.StructType([*labels, *STRIPE]))


def lines(held: dict[tuple, np.ndarray], names: Sequence[str]) -> pd.DataFrame:
    """Labelled matrices as a table of their lines."""
    cols = {n: [] for n in (*names, "i", "stripe")}
    for label, m in held.items():
        for i, line in enumerate(m):
            for n, v in zip(names, label):
                cols[n].append(v)
            cols["i"].append(i)
            cols["stripe"].append(line)
    return pd.DataFrame({n: pd.Series(v, dtype=None if v else object) for n, v in cols.items()})


def partial_sums_of_rows(
    df: DataFrame, labels: Sequence[str], x: str, y: str
) -> DataFrame:
    """As ``partial_sums`` for a table with arrays ``x`` (no constant) and ``y``.

    Rows whose ``x`` or ``y`` is null, or has an element that is null or no number, do not
    take part.
    """
    names = list(labels)
    schema = T.StructType([*[df.schema[c] for c in names], *STRIPE])

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: dict[tuple, np.ndarray] = {}
        floats = 0
        for pdf in batches:
            for label, part in pdf.groupby(names, sort=False):
                X = np.vstack(part[x].to_numpy()).astype(float)
                m = outer_sums(np.hstack([np.ones((len(X), 1)), X]), np.vstack(part[y].to_numpy()).astype(float))
                if m is None:
                    continue
                if label in held:
                    held[label] += m
                else:
                    held[label] = m
                    floats += m.size
                if floats > HELD_FLOATS:
                    yield lines(held, names)
                    held, floats = {}, 0
        if held:
            yield lines(held, names)

    # Elements are looked at in the task: a filter on them would compute the arrays twice.
    rows = df.filter(F.col(x).isNotNull() & F.col(y).isNotNull())
    return rows.select(*names, x, y).mapInPandas(run, schema)


def spread(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Partition by ``cols`` for groups that are small but costly to solve.

    Adaptive execution would merge them by their bytes into one task; a fixed
    number of partitions is left alone, and the grouping needs no other shuffle.
    """
    n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return df.repartition(n, *cols)


def add_up(parts: DataFrame, labels: Sequence[str]) -> DataFrame:
    """Sum the partial matrices; Spark combines them line by line."""
    return parts.groupBy(*labels, "i").agg(
        vector_to_array(Summarizer.sum(array_to_vector("stripe"))).alias("stripe")
    )


def cumulate(
    sums: DataFrame, scope: Sequence[str], block: str, wanted: DataFrame, last: int | None = None
) -> DataFrame:
    """Sums over all smaller ``block`` values, for each block in ``wanted``.

    ``wanted`` has the columns ``scope`` and ``block``. With ``last`` only so many blocks of
    ``wanted`` before each one count: the difference of two sums. A block with nothing
    before it has no result. A group holds one matrix line per block, never
    data rows.
    """
    if last is not None and last < 1:
        raise ValueError("a history has at least one block")
    schema = T.StructType([*[sums.schema[c] for c in (*scope, block)], *STRIPE])
    at = wanted.groupBy(*scope).agg(F.sort_array(F.collect_set(block)).alias("_at"))

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(block)
        at = np.asarray(pdf["_at"].iloc[0])
        total = np.cumsum(np.vstack(pdf["stripe"].to_numpy()), axis=0)
        total = np.vstack([np.zeros((1, total.shape[1])), total])
        hi = np.searchsorted(pdf[block].to_numpy(), at, side="left")
        lo = np.zeros_like(hi)
        if last is not None:
            lo[last:] = hi[:-last]
        out = pd.DataFrame({block: at[hi > lo], "stripe": list(total[hi[hi > lo]] - total[lo[hi > lo]])})
        for c in (*scope, "i"):
            out[c] = pdf[c].iloc[0]
        return out[[*schema.names]]

    lines = spread(sums.join(at, list(scope)), [*scope, "i"])
    return lines.groupBy(*scope, "i").applyInPandas(run, schema)


def matrix(pdf: pd.DataFrame) -> np.ndarray:
    return np.vstack(pdf.sort_values("i")["stripe"].to_numpy())


def ridge(m: np.ndarray, penalty: float) -> np.ndarray | None:
    """Coefficients (constant first) from [X'X | X'Y] whose first column is 1.

    The penalty acts on standardised columns and not on the constant; a column
    without variation gets weight 0. None without rows.
    """
    p = m.shape[0]
    n = m[0, 0]
    if n < 1:
        return None
    mean = m[0] / n
    cov = m / n - np.outer(mean[:p], mean)
    var = np.diag(cov[:, :p]).copy()
    scale = np.maximum(np.diag(m)[:p] / n, 1e-300)
    use = (var > 1e-10 * scale) & (np.arange(p) > 0)
    w = np.zeros((p, m.shape[1] - p))
    if use.any():
        sd = np.sqrt(var[use])
        a = cov[:, :p][np.ix_(use, use)] / np.outer(sd, sd)
        a[np.diag_indices_from(a)] += penalty
        b = cov[:, p:][use] / sd[:, None]
        try:
            if not penalty:
                raise np.linalg.LinAlgError
            w[use] = np.linalg.solve(a, b) / sd[:, None]
        except np.linalg.LinAlgError:
            w[use] = np.linalg.lstsq(a, b, rcond=None)[0] / sd[:, None]
    w[0] = mean[p:] - mean[1:p] @ w[1:]
    return w


_FITTED = [
    T.StructField("penalty_id", T.LongType()),
    T.StructField("step", T.LongType()),
    T.StructField("w", T.ArrayType(T.DoubleType())),
]


def _fitted(m: np.ndarray, penalties: Sequence[float]) -> list[tuple]:
    out = []
    for k, lam in enumerate(penalties):
        w = ridge(m, lam)
        if w is not None:
            out += [(k, s + 1, w[:, s]) for s in range(w.shape[1])]
    return out


def solve(sums: DataFrame, model: Sequence[str], penalties: Sequence[float]) -> DataFrame:
    """One ridge model per ``model`` group: ``penalty_id, step, w`` (step 1-based).

    A group is the p lines of one matrix. Several penalties share the matrix.
    """
    names = list(model)
    schema = T.StructType([*[sums.schema[c] for c in names], *_FITTED])

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        res = pd.DataFrame(_fitted(matrix(pdf), penalties), columns=["penalty_id", "step", "w"])
        for c in names:
            res[c] = pdf[c].iloc[0]
        return res[schema.names]

    return spread(sums, names).groupBy(*names).applyInPandas(run, schema)


def cumulated(by_level: dict[int, np.ndarray], wanted: Iterable[int]) -> Iterator[tuple[int, np.ndarray]]:
    """Each wanted level that has any sums, with the sums of all levels up to it."""
    total, below = None, sorted(by_level)
    for k in sorted(wanted):
        while below and below[0] <= k:
            m = by_level[below.pop(0)]
            total = m if total is None else total + m
        if total is not None:
            yield k, total


def solve_levels(
    sums: DataFrame,
    scope: Sequence[str],
    level: str,
    levels: int,
    penalties: Sequence[float],
) -> DataFrame:
    """As ``solve`` for models 0 .. levels-1, each on the levels up to its own.

    A group holds one matrix per level; their number is a setting.
    """
    names = [*scope, level]
    schema = T.StructType([*[sums.schema[c] for c in names], *_FITTED])

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        by_level = {int(k): matrix(g) for k, g in pdf.groupby(level)}
        out = [(k, *r) for k, total in cumulated(by_level, range(levels)) for r in _fitted(total, penalties)]
        res = pd.DataFrame(out, columns=[level, "penalty_id", "step", "w"])
        for c in scope:
            res[c] = pdf[c].iloc[0]
        return res[schema.names]

    return spread(sums, scope).groupBy(*scope).applyInPandas(run, schema)


def dot(x: str | Column, w: str | Column, *, constant: bool = True) -> Column:
    """w0 + w1 x1 + ... in the JVM; with ``constant`` the array x lacks the 1.

    Null if an element is null or no number.
    """
    x, w = (F.col(c) if isinstance(c, str) else c for c in (x, w))
    xs = F.concat(F.array(F.lit(1.0)), x) if constant else x
    total = F.aggregate(F.zip_with(xs, w, lambda a, b: a * b), F.lit(0.0), lambda s, v: s + v)
    return F.nanvl(total, F.lit(None).cast("double"))
