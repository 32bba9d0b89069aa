"""Window forecasters: a stretch of history in, the next steps out.

``local`` models are fitted per series, ``global`` ones on all series with
static covariates. Both are linear in the window and fitted from sums of outer
products, so a rolling-origin back-test that retrains on every fold reads the
data once.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass, replace
from types import SimpleNamespace

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fadecast.functions import calendar
from fadecast.operators import scale, series
from fadecast.operators.ordered import segments
from fadecast.plans import gram
from fadecast.plans.backtest import FOLDS, HORIZON, covered, first_origin, fold_count, origin_of
from fadecast.session import checkpointed
from fadecast.spec import SeriesSpec


@dataclass(frozen=True)
class WindowModel:
    """Shape of the input window and the columns it is made of.

    ``inputs`` lists pairs (target lags, past-covariate lags) fitted at once. A fold starts
    every ``stride`` rows (None: every ``horizon`` rows) of the last ``folds * horizon``.
    """

    target: str = "y"
    past: tuple[str, ...] = ()
    future: tuple[str, ...] = ()
    calendar: tuple[str, ...] = ()
    static: tuple[str, ...] = ()
    inputs: tuple[tuple[int, int], ...] = ((96, 24),)
    horizon: int = HORIZON
    folds: int = FOLDS
    stride: int | None = None
    local: bool = False
    penalties: tuple[float, ...] = (0.1,)

    @property
    def columns(self) -> list[str]:
        seen: dict[str, None] = {self.target: None}
        for c in (*self.past, *self.future, *self.calendar, *self.static):
            seen.setdefault(c)
        return list(seen)

    @property
    def n_folds(self) -> int:
        """Number of back-test folds, and the fold of the forecast after the last row."""
        return fold_count(self.horizon, self.folds, self.stride)

    def origin(self, n, fold):
        """First predicted position of a fold of a series with ``n`` rows."""
        inner = n - self.folds * self.horizon + fold * (self.stride or self.horizon)
        return np.where(np.asarray(fold) >= self.n_folds, n, inner)

    def fold_of_end(self, n, end: np.ndarray) -> np.ndarray:
        """The first fold that starts at or after position ``end``."""
        first, stride = n - self.folds * self.horizon, self.stride or self.horizon
        return np.clip(-((first - end) // stride), 0, self.n_folds)

    @property
    def scaled(self) -> list[str]:
        """Columns that have a scale: all but those of the calendar and the static ones."""
        return list(dict.fromkeys([self.target, *self.past, *self.future]))

    @property
    def reach(self) -> int:
        return max(max(a, b) for a, b in self.inputs)

    def groups(self, lags: int, cov_lags: int) -> list[tuple[str, int]]:
        """(variable, lag) of every input but the constant; lag 0 = last row seen."""
        out = [(self.target, k) for k in range(lags - 1, -1, -1)]
        for c in self.past:
            out += [(c, k) for k in range(cov_lags - 1, -1, -1)]
        for c in self.future:
            out += [(c, -k) for k in range(1, self.horizon + 1)]
        out += [(c, 0) for c in (*self.calendar, *self.static)]
        return out


class _Design:
    """Cuts the arrays of one segment into windows."""

    def __init__(self, model: WindowModel, keys: Sequence[str]):
        self.m, self.keys = model, list(keys)

    def inputs(self, row, lags: int, cov_lags: int, ends: np.ndarray) -> np.ndarray:
        """Window ending at each position of ``ends`` (index into the arrays)."""
        m, col = self.m, lambda c: np.asarray(getattr(row, c), dtype=float)
        back = lambda k: ends[:, None] + np.arange(-k + 1, 1)
        blocks = [np.ones((len(ends), 1)), col(m.target)[back(lags)]]
        blocks += [col(c)[back(cov_lags)] for c in m.past]
        ahead = ends[:, None] + np.arange(1, m.horizon + 1)
        blocks += [col(c)[ahead] for c in m.future]
        blocks += [col(c)[ends][:, None] for c in (*m.calendar, *m.static)]
        return np.hstack(blocks)

    def ends(self, row, lags, cov_lags, n_rows):
        """Positions owned by the segment at which a whole window ends."""
        need = max(lags, cov_lags)
        lo = max(row.own_from, row.start + need - 1)
        hi = min(row.own_to, row.start + n_rows - (self.m.horizon if self.m.future else 0))
        return np.arange(lo, max(lo, hi))

    def training(self, row):
        m = self.m
        y = np.asarray(getattr(row, m.target), dtype=float)
        for lags, cov_lags in m.inputs:
            pos = self.ends(row, lags, cov_lags, len(y))
            pos = pos[pos + m.horizon <= row.n - 1]
            idx = pos - row.start
            block = m.fold_of_end(row.n, pos + m.horizon + 1)
            X = self.inputs(row, lags, cov_lags, idx)
            Y = y[idx[:, None] + np.arange(1, m.horizon + 1)]
            scope = tuple(getattr(row, k) for k in self.keys) if m.local else ()
            for b in np.unique(block):
                at = block == b
                yield (*scope, lags, cov_lags, int(b)), X[at], Y[at]

    def origins(self, row, folds: Sequence[int]):
        m = self.m
        y = np.asarray(getattr(row, m.target), dtype=float)
        for lags, cov_lags in m.inputs:
            pos = self.ends(row, lags, cov_lags, len(y))
            for f in folds:
                e = int(m.origin(row.n, f)) - 1
                if len(pos) and pos[0] <= e <= pos[-1]:
                    x = self.inputs(row, lags, cov_lags, np.array([e - row.start]))[0]
                    yield (lags, cov_lags, f, x)


_SHAPE = [
    T.StructField("lags", T.LongType()),
    T.StructField("cov_lags", T.LongType()),
]
_BLOCK = T.StructField("fold", T.LongType())


def _segments(grid: DataFrame, model: WindowModel, keys: Sequence[str], size: int) -> DataFrame:
    # n depends on the key only; as a grouping column it reaches every chunk.
    return segments(
        grid, [*keys, "n"], "pos", model.columns, back=model.reach - 1, ahead=model.horizon, size=size
    )


def _scope(model: WindowModel, keys: Sequence[str]) -> list[str]:
    return [*(keys if model.local else ()), "lags", "cov_lags"]


def _window_sums(grid, keys, model, size) -> tuple[DataFrame, list[str]]:
    design = _Design(model, keys)
    key_fields = [grid.schema[k] for k in keys] if model.local else []
    labels = [*key_fields, *_SHAPE, _BLOCK]
    parts = gram.partial_sums(_segments(grid, model, keys, size), labels, design.training)
    return parts, [f.name for f in labels]


def fit(
    grid: DataFrame, keys: Sequence[str], model: WindowModel, *, size: int = 4096
) -> DataFrame:
    """Coefficients of every fold: ``lags, cov_lags, fold, penalty_id, step, w``.

    Fold f is trained on the windows whose outputs end before its origin; the
    last one, ``n_folds``, on everything, for the final forecast. Folds may overlap: sums
    are kept per run of windows that the same folds see, and the folds' sums are nested.
    """
    parts, names = _window_sums(grid, keys, model, size)
    sums = gram.add_up(parts, names)
    return gram.solve_levels(sums, names[:-1], "fold", model.n_folds + 1, model.penalties)


def predict(
    grid: DataFrame,
    keys: Sequence[str],
    model: WindowModel,
    coefficients: DataFrame,
    folds: Sequence[int],
    *,
    extra: Sequence[str] = (),
    scales: DataFrame | None = None,
    size: int = 4096,
) -> DataFrame:
    """``keys, n, lags, cov_lags, fold, penalty_id, step, pos, yhat`` at each origin.

    ``extra`` names further columns of the coefficients to keep. With ``scales`` (from
    ``fold_scales``) the coefficients are those of scaled columns and the grid is not scaled.
    """
    design = _Design(model, keys)
    key_fields = [grid.schema[k] for k in keys]
    schema = T.StructType(
        [*key_fields, T.StructField("n", T.LongType()), *_SHAPE, _BLOCK,
         T.StructField("x", T.ArrayType(T.DoubleType()))]
    )
    names = list(keys)

    def run(batches):
        for pdf in batches:
            out = []
            for row in pdf.itertuples(index=False):
                head = tuple(getattr(row, k) for k in names)
                out += [(*head, row.n, *r) for r in design.origins(row, folds)]
            yield pd.DataFrame(out, columns=schema.names)

    # The windows before the origins and the steps after them, not the whole grid.
    first, last = min(folds), max(folds)
    origin_at = lambda f: origin_of(F.lit(f), "n", model.horizon, model.folds, model.stride)
    near = grid.filter(
        (F.col("pos") >= origin_at(first) - model.reach)
        & (F.col("pos") < origin_at(last) + model.horizon)
    )
    x = _segments(near, model, keys, size).mapInPandas(run, schema)
    on = [*_scope(model, keys), "fold"]
    # Global coefficients number shapes x folds x penalties x steps, all of them
    # settings; per-series ones are left to Spark's size check.
    w = coefficients if model.local else F.broadcast(coefficients)
    yhat = gram.dot("x", "w", constant=False)
    if scales is not None:
        x = x.join(scales, [*keys, "fold"])
        lo, width = _of_design(model, "_lo", 0.0), _of_design(model, "_width", 1.0)
        moved = F.zip_with(F.zip_with("x", lo, lambda a, b: a - b), width, lambda a, b: a / b)
        x = x.withColumn("x", moved)
        yhat = yhat * F.col("_width")[0] + F.col("_lo")[0]
    origin = origin_at(F.col("fold"))
    return x.join(w, on).select(
        *keys, "n", "lags", "cov_lags", "fold", "penalty_id", "step", *extra,
        (origin + F.col("step") - 1).cast("long").alias("pos"), yhat.alias("yhat"),
    )


# --- series that lie whole in one task

ROWS_A_TASK = 4096  # at least, so that short series are not spread over idle tasks


def _whole_series(model: WindowModel, keys: Sequence[str], ahead: int):
    """Reads rows sorted by key and position and yields ``(key, arrays or None)`` per series:
    arrays if all of its rows were in the task, None if a border of the task cuts it."""
    names, columns = list(keys), model.columns

    def read(batches: Iterator[pd.DataFrame]):
        key, parts, last = None, [], None

        def settled(at_end: bool):
            if parts is None:
                return key, None
            n = int(parts[0]["n"].iloc[0])
            if at_end and last < n + ahead - 1:
                return key, None
            whole = pd.concat(parts) if len(parts) > 1 else parts[0]
            arrays = {c: whole[c].to_numpy(dtype=float, na_value=np.nan) for c in columns}
            return key, (n, arrays)

        for pdf in batches:
            for k, g in pdf.groupby(names, sort=False, dropna=False):
                if key is None or k != key:
                    if key is not None:
                        yield settled(False)
                    # A series whose first rows lie elsewhere is cut: its rows are not held.
                    key, parts = k, [] if int(g["pos"].iloc[0]) == 0 else None
                if parts is not None:
                    parts.append(g)
                last = int(g["pos"].iloc[-1])
        if key is not None:
            yield settled(True)

    return read


def _chunks(model: WindowModel, keys: Sequence[str], key, n: int, arrays: dict, size: int):
    """A whole series in pieces that overlap by what a window reaches."""
    total = len(arrays[model.target])
    for lo in range(0, total, size):
        start, stop = max(0, lo - model.reach + 1), min(total, lo + size + model.horizon)
        row = SimpleNamespace(n=n, start=start, own_from=lo, own_to=lo + size)
        for c, v in arrays.items():
            setattr(row, c, v[start:stop])
        for name, v in zip(keys, key):
            setattr(row, name, v)
        yield row


def _dealt(grid: DataFrame, keys: Sequence[str], model: WindowModel) -> DataFrame:
    """Rows in ranges of key and position: a short series stays whole, a long one is spread."""
    rows = grid.select(*keys, "n", "pos", *model.columns)
    most = int(grid.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    parts = max(1, min(most, rows.count() // ROWS_A_TASK))
    return rows.repartitionByRange(parts, *keys, "pos").sortWithinPartitions(*keys, "pos")


def _sums_of_series(model, keys, key, n, arrays, size) -> dict[tuple, dict[int, np.ndarray]]:
    """Sums per shape and fold block of one whole series."""
    design, out = _Design(model, keys), {}
    for row in _chunks(model, keys, key, n, arrays, size):
        for label, X, Y in design.training(row):
            m = gram.outer_sums(X, Y)
            if m is not None:
                *_, lags, cov, block = label
                blocks = out.setdefault((lags, cov), {})
                blocks[block] = blocks[block] + m if block in blocks else m
    return out


def fit_predict(
    grid: DataFrame, keys: Sequence[str], model: WindowModel, folds: Sequence[int], *, size: int = 4096
) -> DataFrame:
    """The forecasts of ``predict`` with per-series models, fitted where the series lies.

    Rows are shuffled once, in ranges of key and position. A series that lies whole in a task
    is summed, solved and predicted there, and only forecasts leave it. The few series that a
    range border cuts (at most two a task, long ones among them) are left to ``fit``.
    """
    if not model.local:
        raise ValueError("a global model is not fitted per series")
    names, wanted = list(keys), sorted(folds)
    last = model.horizon if model.future and wanted and wanted[-1] >= model.n_folds else 0
    read, design = _whole_series(model, keys, last), _Design(model, keys)
    head = [grid.schema[k] for k in keys]
    whole = T.StructType(
        [*head, T.StructField("n", T.LongType()), *_SHAPE, _BLOCK,
         *[T.StructField(c, T.LongType()) for c in ("penalty_id", "step", "pos")],
         T.StructField("yhat", T.DoubleType()), T.StructField("_cut", T.BooleanType())]
    )

    def of_series(key, n, arrays):
        sums = _sums_of_series(model, keys, key, n, arrays, size)
        at = {}
        for row in _chunks(model, keys, key, n, arrays, size):
            for lags, cov, f, x in design.origins(row, wanted):
                at[lags, cov, f] = x
        for (lags, cov), blocks in sums.items():
            for f, total in gram.cumulated(blocks, wanted):
                if (lags, cov, f) not in at:
                    continue
                for k, lam in enumerate(model.penalties):
                    w = gram.ridge(total, lam)
                    if w is None:
                        continue
                    found = at[lags, cov, f] @ w
                    start = int(model.origin(n, f))
                    for s, v in enumerate(found):
                        yield (*key, n, lags, cov, f, k, s + 1, start + s, v if np.isfinite(v) else None, False)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        out = []
        for key, series_ in read(batches):
            if series_ is None:
                out.append((*key, *[None] * (len(whole) - len(key) - 1), True))
            else:
                out += of_series(key, *series_)
            if len(out) > 100_000:
                yield _frame(out, whole)
                out = []
        yield _frame(out, whole)

    # Read twice: forecasts, and the keys of cut series.
    done = checkpointed(_dealt(grid, keys, model).mapInPandas(run, whole))
    cut = done.filter("_cut").select(*names).distinct()
    found = done.filter("NOT _cut").drop("_cut")
    if not cut.count():
        return found
    rest = _only(grid, cut, names)
    return found.unionByName(predict(rest, keys, model, fit(rest, keys, model, size=size), folds, size=size))


def _frame(rows: list[tuple], schema: T.StructType) -> pd.DataFrame:
    out = pd.DataFrame(rows, columns=schema.names)
    for f in schema:
        if isinstance(f.dataType, T.LongType):
            out[f.name] = out[f.name].astype("Int64")
    return out


def _only(grid: DataFrame, cut: DataFrame, keys: Sequence[str]) -> DataFrame:
    # At most two keys a task.
    c = F.broadcast(cut.select(*[F.col(k).alias(f"_cut_{k}") for k in keys]))
    same = [F.col(k).eqNullSafe(F.col(f"_cut_{k}")) for k in keys]
    on = same[0]
    for s in same[1:]:
        on = on & s
    return grid.join(c, on, "left_semi")


# --- a scaler per fold


def _of_design(model: WindowModel, column: str, rest: float) -> Column:
    """Statistics of the scaled columns, repeated as the design repeats the columns."""
    at = {c: F.col(column)[k] for k, c in enumerate(model.scaled)}
    parts = [F.array(F.lit(rest)), F.array_repeat(at[model.target], F.col("lags").cast("int"))]
    parts += [F.array_repeat(at[c], F.col("cov_lags").cast("int")) for c in model.past]
    parts += [F.array_repeat(at[c], F.lit(model.horizon)) for c in model.future]
    return F.concat(*parts, F.array_repeat(F.lit(rest), F.lit(len(model.calendar) + len(model.static))))


def fold_scales(grid: DataFrame, keys: Sequence[str], model: WindowModel) -> DataFrame:
    """``keys, fold, _lo, _width``: smallest values and ranges of the scaled columns over the
    rows before each fold's origin. A constant column has the range 1. Folds with no row
    before them have no line."""
    n, end = F.col("n"), F.col("pos") + 1
    stride = model.stride or model.horizon
    block = F.ceil((end - first_origin(n, model.horizon, model.folds)) / stride)
    block = F.greatest(F.lit(0), F.least(F.lit(model.n_folds), block)).cast("long")
    aggs = [f(c).alias(f"{k}_{c}") for c in model.scaled for k, f in (("lo", F.min), ("hi", F.max))]
    per = grid.filter(F.col("pos") < n).groupBy(*keys, block.alias("fold")).agg(*aggs)
    every = F.sequence(F.lit(0).cast("long"), F.lit(model.n_folds).cast("long"))
    frame = per.select(*keys).distinct().withColumn("fold", F.explode(every))
    over = Window.partitionBy(*keys).orderBy("fold").rowsBetween(Window.unboundedPreceding, 0)
    run = frame.join(per, [*keys, "fold"], "left").select(
        *keys, "fold",
        *[f(f"{k}_{c}").over(over).alias(f"{k}_{c}") for c in model.scaled for k, f in (("lo", F.min), ("hi", F.max))],
    )
    lo = [F.col(f"lo_{c}").cast("double") for c in model.scaled]
    width = [F.when(F.col(f"hi_{c}") > F.col(f"lo_{c}"), F.col(f"hi_{c}") - F.col(f"lo_{c}")).otherwise(1.0) for c in model.scaled]
    return run.filter(F.col(f"lo_{model.target}").isNotNull()).select(
        *keys, "fold", F.array(*lo).alias("_lo"), F.array(*width).alias("_width")
    )


def _rescaled(m: np.ndarray, lo: np.ndarray, width: np.ndarray, lo_y: float, width_y: float) -> np.ndarray:
    """Sums of scaled columns from sums of raw ones: scaled = raw @ S."""
    p = m.shape[0]
    S = np.diag(1 / width)
    S[0] = -lo / width
    S[0, 0] = 1.0
    xy = (m[:, p:] - np.outer(m[:, 0], np.full(m.shape[1] - p, lo_y))) / width_y
    return np.hstack([S.T @ m[:, :p] @ S, S.T @ xy])


def fit_fold_scope(grid: DataFrame, keys: Sequence[str], model: WindowModel, *, size: int = 4096) -> DataFrame:
    """As ``fit`` for a global model whose scaler is fitted per series and fold, on the rows
    before the fold's origin. ``grid`` is not scaled.

    Sums of raw columns do not depend on the scaler; each fold's nested sums of a series are
    rescaled by that fold's statistics before the series are added up.
    """
    if model.local:
        raise ValueError("a model per series does not depend on the scaler")
    read, names = _whole_series(model, keys, 0), list(keys)
    labels = [*_SHAPE, _BLOCK]
    head = [grid.schema[k] for k in keys]
    schema = T.StructType([*head, *labels, *gram.STRIPE, T.StructField("_cut", T.BooleanType())])
    label_names = [f.name for f in labels]

    def repeat(v: np.ndarray, lags: int, cov: int, rest: float) -> np.ndarray:
        at = dict(zip(model.scaled, v))
        out = [np.array([rest]), np.full(lags, at[model.target])]
        out += [np.full(cov, at[c]) for c in model.past] + [np.full(model.horizon, at[c]) for c in model.future]
        return np.concatenate([*out, np.full(len(model.calendar) + len(model.static), rest)])

    def of_fold(total, lags, cov, lo, width):
        return _rescaled(total, repeat(lo, lags, cov, 0.0), repeat(width, lags, cov, 1.0), lo[0], width[0])

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held, cut = {}, []
        for key, series_ in read(batches):
            if series_ is None:
                cut.append((*key, *[None] * (len(schema) - len(key) - 1), True))
                continue
            n, arrays = series_
            for (lags, cov), blocks in _sums_of_series(model, keys, key, n, arrays, size).items():
                for f, total in gram.cumulated(blocks, range(model.n_folds + 1)):
                    seen = [arrays[c][: int(model.origin(n, f))] for c in model.scaled]
                    lo, hi = (np.array([g(v) for v in seen]) for g in (np.nanmin, np.nanmax))
                    m = of_fold(total, lags, cov, lo, np.where(hi > lo, hi - lo, 1.0))
                    held[lags, cov, f] = held[lags, cov, f] + m if (lags, cov, f) in held else m
        out = gram.lines(held, label_names)
        for k in names:
            out[k] = None
        out["_cut"] = False
        yield out[schema.names]
        if cut:
            yield pd.DataFrame(cut, columns=schema.names)

    done = checkpointed(_dealt(grid, keys, model).mapInPandas(run, schema))
    parts = done.filter("NOT _cut").select(*label_names, "i", "stripe")
    cut = done.filter("_cut").select(*names).distinct()
    if cut.count():
        rest = _only(grid, cut, names)
        own = replace(model, local=True)
        raw, raw_names = _window_sums(rest, keys, own, size)
        sums = gram.add_up(raw, raw_names)
        scales = fold_scales(rest, keys, model).groupBy(*keys).agg(
            F.sort_array(F.collect_list(F.struct("fold", "_lo", "_width"))).alias("_scales")
        )
        part_schema = T.StructType([*labels, *gram.STRIPE])

        def rescale(pdf: pd.DataFrame) -> pd.DataFrame:
            lags, cov = int(pdf["lags"].iloc[0]), int(pdf["cov_lags"].iloc[0])
            by = {int(r["fold"]): (np.asarray(r["_lo"]), np.asarray(r["_width"])) for r in pdf["_scales"].iloc[0]}
            blocks = {int(k): gram.matrix(g) for k, g in pdf.groupby("fold")}
            held = {
                (lags, cov, f): of_fold(total, lags, cov, *by[f])
                for f, total in gram.cumulated(blocks, range(model.n_folds + 1))
            }
            return gram.lines(held, label_names)[part_schema.names]

        # A group is the matrices of one series, one per fold: settings, not rows.
        joined = sums.join(F.broadcast(scales), names)
        parts = parts.unionByName(joined.groupBy(*names, "lags", "cov_lags").applyInPandas(rescale, part_schema))
    return gram.solve(gram.add_up(parts, label_names), label_names, model.penalties)


@dataclass(frozen=True)
class ModelTable:
    """Regular series ready for modelling.

    ``raw`` has the values in their own unit, ``grid`` scaled ones with
    calendar and static columns; both run on into the known future, where the
    target is null and ``pos`` is at least ``n``.
    """

    raw: DataFrame
    grid: DataFrame
    stats: DataFrame
    calendar: tuple[str, ...]
    static: tuple[str, ...]
    spec: SeriesSpec
    fit_scope: str = "all"

    @property
    def history(self) -> DataFrame:
        seen = self.raw.filter(F.col("pos") < F.col("n"))
        return seen.select(*self.spec.keys, self.spec.time, *self.spec.target)


def model_table(
    history: DataFrame,
    future: DataFrame | None,
    spec: SeriesSpec,
    *,
    static: dict[str, Sequence[str]] | None = None,
    calendar_names: Sequence[str] = ("hour", "dayofweek"),
    zone: str | None = None,
    fit_scope: str = "all",
    holdout: int = FOLDS * HORIZON,
) -> ModelTable:
    """Grid of history and known future, scaled per series.

    Gaps in target and covariates count as 0. An hour named by both tables
    counts as history. ``fit_scope`` says which rows the scaler sees: ``all``, ``train``,
    the history without its last ``holdout`` steps, or ``fold``, what lies before each fold;
    then ``grid`` is not scaled and the models scale their sums. ``zone``
    shifts the clock the calendar columns are read from.

    The regular table is written once, since fitting, predicting, unscaling and
    scoring all read it.
    """
    if fit_scope not in ("all", "train", "fold"):
        raise ValueError("fit_scope must be all, train or fold")
    keys, time = list(spec.keys), spec.time
    (target,) = spec.target
    covariates = [c for c in spec.values if c != target]
    values = [target, *covariates]
    rows = history.select(*keys, time, *values, F.col(time).alias("_seen"))
    if future is not None:
        known = future.select(*keys, time, *covariates)
        rows = rows.unionByName(known, allowMissingColumns=True)
        rows = rows.groupBy(*keys, time).agg(
            *[F.coalesce(F.max_by(c, "_seen"), F.max(c)).alias(c) for c in values],
            F.max("_seen").alias("_seen"),
        )
    last = rows.groupBy(*keys).agg(F.min(time).alias("_t0"), F.max("_seen").alias("_t1"))
    grid = series.regularise(rows, keys, time, spec.step, values=values).drop("n").join(last, keys)
    n = F.floor(series.seconds_between("_t0", "_t1") / spec.step).cast("long") + 1
    seen = F.col(time) <= F.col("_t1")
    raw = checkpointed(
        grid.select(
            *keys, time, "pos", n.alias("n"),
            F.when(seen, F.coalesce(F.col(target), F.lit(0.0))).alias(target),
            *[F.coalesce(F.col(c), F.lit(0.0)).alias(c) for c in covariates],
        )
    )
    fitted = F.col("pos") < F.col("n") - holdout if fit_scope == "train" else None
    stats = scale.minmax_stats(raw, keys, values, where=fitted)
    if fit_scope == "fold":  # the identity
        ends = {f"{c}_{e}": F.lit(v) for c in values for e, v in (("min", 0.0), ("max", 1.0))}
        stats = stats.select(*keys).withColumns(ends)
    clock = calendar.in_zone(time, zone) if zone else F.col(time)
    cols = {f"cal_{k}": v for k, v in calendar.cyclic(clock, calendar_names).items()}
    cols["cal_year"] = calendar.encode_year(clock)
    flags = {
        f"is_{v}": k
        for k, listed in (static or {}).items()
        for v in listed
    }
    scaled = scale.minmax_apply(raw, stats, keys, values, suffix="").withColumns(cols)
    for k, listed in (static or {}).items():
        scaled = series.one_hot(scaled, k, listed)
    return ModelTable(raw, scaled, stats, tuple(cols), tuple(flags), spec, fit_scope)


def forecasts(table: ModelTable, model: WindowModel, folds: Sequence[int]) -> DataFrame:
    """Forecasts of one or more configurations, in the scale of ``table.grid``."""
    keys = list(table.spec.keys)
    if model.local:
        return fit_predict(table.grid, keys, model, folds)
    if table.fit_scope == "fold":
        w = fit_fold_scope(table.grid, keys, model)
        return predict(table.grid, keys, model, w, folds, scales=fold_scales(table.grid, keys, model))
    return predict(table.grid, keys, model, fit(table.grid, keys, model), folds)


def complete(
    predictions: DataFrame,
    table: ModelTable,
    model: WindowModel,
    folds: Sequence[int],
    configs: DataFrame | None = None,
) -> DataFrame:
    """``unscaled`` predictions for every series, fold and step.

    A series too short for the model has rows with a null ``yhat`` and a ``reason``. With
    ``configs``, a table of one column, this holds for every configuration of it.
    """
    keys = list(table.spec.keys)
    lengths = table.raw.groupBy(*keys).agg(F.max("n").alias("n"))
    if configs is not None:
        (name,) = configs.columns
        # The number of configurations is a setting.
        kind = configs.schema[name].dataType
        every = F.array(*[F.lit(r[0]).cast(kind) for r in configs.distinct().collect()])
        lengths, keys = lengths.withColumn(name, F.explode(every)), [*keys, name]
    return covered(
        predictions.drop("n"), lengths, keys, horizon=model.horizon, folds=model.folds,
        stride=model.stride, which=list(folds),
    )


def unscaled(predictions: DataFrame, table: ModelTable) -> DataFrame:
    """Forecasts in the target's own unit with their time stamps."""
    spec = table.spec
    keys, (target,) = list(spec.keys), spec.target
    lo, hi = F.col(f"{target}_min"), F.col(f"{target}_max")
    start = table.raw.groupBy(*keys).agg(F.min(spec.time).alias("_t0"))
    start = start.join(table.stats.select(*keys, f"{target}_min", f"{target}_max"), keys)
    at = F.timestamp_add("SECOND", F.col("pos") * spec.step, F.col("_t0"))
    out = predictions.join(start, keys).withColumns(
        {"yhat": F.col("yhat") * (hi - lo) + lo, spec.time: at}
    )
    return out.drop("_t0", f"{target}_min", f"{target}_max")


def importance(
    grid: DataFrame, keys: Sequence[str], model: WindowModel, by: str, *, size: int = 4096
) -> DataFrame:
    """Expected rise of the squared error when inputs are permuted over rows.

    ``by`` is ``variable`` (all inputs of one column move together) or ``lag``.
    The mean over all permutations follows from X'X and X'Y, so no row has to
    be shuffled or scored again.
    """
    parts, names = _window_sums(grid, keys, model, size)
    scope, penalty = names[:-1], model.penalties[0]
    sums = gram.add_up(parts, scope)
    kind = T.StringType() if by == "variable" else T.LongType()
    schema = T.StructType(
        [*[sums.schema[c] for c in scope], T.StructField(by, kind), T.StructField("loss_rise", T.DoubleType())]
    )

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        m = gram.matrix(pdf)
        p = m.shape[0]
        w = gram.ridge(m, penalty)
        lags, cov = int(pdf["lags"].iloc[0]), int(pdf["cov_lags"].iloc[0])
        place: dict = {}
        for i, (name, lag) in enumerate(model.groups(lags, cov), start=1):
            if by == "variable":
                place.setdefault(name, []).append(i)
            elif lag >= 0 and name in (model.target, *model.past):
                place.setdefault(lag, []).append(i)
        n = m[0, 0]
        mean = m[0] / n
        cov_m = m / n - np.outer(mean[:p], mean)
        with_error = cov_m[:, :p] @ w - cov_m[:, p:]
        out = []
        for name, at in place.items():
            g = w[at]
            own = np.einsum("is,ij,js->", g, cov_m[np.ix_(at, at)], g)
            out.append((name, float(2 * own - 2 * (g * with_error[at]).sum())))
        res = pd.DataFrame(out, columns=[by, "loss_rise"])
        for c in scope:
            res[c] = pdf[c].iloc[0]
        return res[[*scope, by, "loss_rise"]]

    return sums.groupBy(*scope).applyInPandas(run, schema)
