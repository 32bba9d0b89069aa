"""Rolling-origin back-tests: fold tables and the seasonal-naive forecaster."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fadecast.operators.ordered import CHUNK, sliding

# Forecast horizon in grid steps and number of folds.
HORIZON = 24
FOLDS = 10


def first_origin(n: str | Column, horizon: int = HORIZON, folds: int = FOLDS) -> Column:
    """Position of the first predicted row: n - folds * horizon."""
    c = F.col(n) if isinstance(n, str) else n
    return c - folds * horizon


def fold_count(horizon: int = HORIZON, folds: int = FOLDS, stride: int | None = None) -> int:
    """Folds of a whole horizon within the last ``folds * horizon`` rows, one every ``stride``."""
    return (folds * horizon - horizon) // (stride or horizon) + 1


def origin_of(
    fold: str | Column, n: str | Column, horizon: int = HORIZON, folds: int = FOLDS, stride: int | None = None
) -> Column:
    """First predicted position of a fold; the fold after the last one starts at ``n``."""
    f, n = (F.col(c) if isinstance(c, str) else c for c in (fold, n))
    inner = first_origin(n, horizon, folds) + f * (stride or horizon)
    return F.when(f >= fold_count(horizon, folds, stride), n).otherwise(inner).cast("long")


def folds_of_series(
    lengths: DataFrame,
    n: str = "n",
    *,
    horizon: int = HORIZON,
    folds: int = FOLDS,
    stride: int | None = None,
) -> DataFrame:
    """One row per series and fold: ``fold, origin, n_train``.

    Everything before ``origin`` may be trained on, ``horizon`` rows from it on
    are predicted.
    """
    count = fold_count(horizon, folds, stride)
    d = lengths.withColumn("fold", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(count - 1).cast("long"))))
    origin = origin_of("fold", n, horizon, folds, stride)
    return d.withColumn("origin", origin).withColumn("n_train", F.col("origin"))


def covered(
    forecasts: DataFrame,
    lengths: DataFrame,
    keys: Sequence[str],
    *,
    n: str = "n",
    horizon: int = HORIZON,
    folds: int = FOLDS,
    stride: int | None = None,
    which: Sequence[int] | None = None,
) -> DataFrame:
    """``forecasts`` (keys, fold, step, yhat, ...) completed to every series, fold and step.

    What no forecaster could predict has a null ``yhat`` and a ``reason``, so that a short
    series is seen and not lost. ``lengths`` has one row per series; the fold after the
    last one is the forecast after the last row.
    """
    every = range(fold_count(horizon, folds, stride)) if which is None else which
    chosen = F.array(*[F.lit(f).cast("long") for f in every])
    steps = F.sequence(F.lit(1).cast("long"), F.lit(horizon).cast("long"))
    frame = lengths.select(*keys, F.col(n).alias("_n"), F.explode(chosen).alias("fold"))
    frame = frame.withColumn("step", F.explode(steps))
    origin = origin_of("fold", "_n", horizon, folds, stride)
    out = frame.join(forecasts, [*keys, "fold", "step"], "left")
    reason = F.when(F.col("yhat").isNotNull(), F.lit(None).cast("string")).when(
        origin <= 0, "the origin lies before the series"
    ).otherwise("the history is too short")
    return out.withColumn("reason", reason).drop("_n")


def shared_by_all(forecasts: DataFrame, keys: Sequence[str], config: str, n_configs: int) -> DataFrame:
    """Of ``covered`` forecasts of several configurations the series and folds that every one
    of the ``n_configs`` predicts, so that scores compare like with like.

    Adds nothing; what is left out is counted by ``coverage``.
    """
    cell = [*keys, "fold"]
    whole = forecasts.groupBy(*cell, config).agg((F.count("yhat") == F.count(F.lit(1))).alias("_whole"))
    n = F.sum(F.col("_whole").cast("long"))
    shared = whole.groupBy(*cell).agg(n.alias("_n")).filter(F.col("_n") == n_configs).drop("_n")
    return forecasts.join(shared, cell, "left_semi")


def coverage(forecasts: DataFrame, config: str) -> DataFrame:
    """``n_points, n_predicted`` of ``covered`` forecasts per configuration."""
    return forecasts.groupBy(config).agg(
        F.count(F.lit(1)).alias("n_points"), F.count("yhat").alias("n_predicted")
    )


def fold_rows(
    grid: DataFrame,
    *,
    pos: str = "pos",
    n: str = "n",
    horizon: int = HORIZON,
    folds: int = FOLDS,
    stride: int | None = None,
) -> DataFrame:
    """The predicted rows with ``fold`` and ``step`` (1-based).

    With a stride shorter than the horizon a row is predicted by several folds
    and appears once for each.
    """
    stride = stride or horizon
    count = fold_count(horizon, folds, stride)
    rel = (F.col(pos) - first_origin(n, horizon, folds)).cast("long")
    test = grid.filter(rel >= 0)
    lo = F.greatest(F.lit(0).cast("long"), F.floor((rel - horizon) / stride) + 1)
    hi = F.least(F.lit(count - 1).cast("long"), F.floor(rel / stride))
    d = test.filter(lo <= hi).withColumn("fold", F.explode(F.sequence(lo, hi)))
    return d.withColumn("step", (rel - F.col("fold") * stride + 1).cast("long"))


def seasonal_naive(
    grid: DataFrame,
    keys: Sequence[str],
    value: str,
    configs: Sequence[dict],
    *,
    pos: str = "pos",
    n: str = "n",
    horizon: int = HORIZON,
    folds: int = FOLDS,
    size: int = CHUNK,
) -> DataFrame:
    """Back-test of "as one season ago" for several configurations at once.

    A configuration has ``config_id``, ``season`` and ``depth``; the forecast is
    the mean of the same phase in the last ``depth`` complete seasons before
    the origin. Only rows before the origin are read.
    """
    reach = {
        c["config_id"]: [
            [c["season"] * (-(-s // c["season"]) + i) for i in range(c["depth"])]
            for s in range(1, horizon + 1)
        ]
        for c in configs
    }
    lags = sorted({k for per_step in reach.values() for ks in per_step for k in ks})

    def cols(w):
        return {f"_l{k}": F.lag(value, k).over(w) for k in lags}

    # Only the test range and what its lags reach is read; the filter stands before the
    # window, through which it could not be pushed.
    near = grid.filter(F.col(pos) >= first_origin(n, horizon, folds) - max(lags))
    d = sliding(near, keys, pos, cols, back=max(lags), size=size)
    d = fold_rows(d, pos=pos, n=n, horizon=horizon, folds=folds)

    def mean_of(ks):
        a = F.array(*[F.col(f"_l{k}") for k in ks])
        return F.aggregate(
            F.array_compact(a), F.lit(0.0), lambda s, x: s + x
        ) / F.nullif(F.size(F.array_compact(a)), F.lit(0))

    def forecast(per_step):
        groups: dict[tuple, int] = {}
        for i, ks in enumerate(per_step, start=1):
            groups[tuple(ks)] = max(groups.get(tuple(ks), 0), i)
        out = None
        for ks, last in sorted(groups.items(), key=lambda kv: kv[1]):
            cond = F.col("step") <= last
            out = F.when(cond, mean_of(ks)) if out is None else out.when(cond, mean_of(ks))
        return out

    rows = F.array(
        *[
            F.struct(
                F.lit(c["config_id"]).cast("long").alias("config_id"),
                forecast(reach[c["config_id"]]).alias("yhat"),
            )
            for c in configs
        ]
    )
    return d.withColumn("_r", F.explode(rows)).select(
        *[c for c in grid.columns if c not in (value, n)],
        n,
        F.col(value).alias("actual"),
        "fold",
        "step",
        "_r.config_id",
        "_r.yhat",
    )


def next_season(
    grid: DataFrame,
    keys: Sequence[str],
    time: str,
    value: str,
    season: int,
    step_seconds: int,
    *,
    pos: str = "pos",
    n: str = "n",
) -> DataFrame:
    """Forecast of the season after the last row: the last season again."""
    last = grid.filter(F.col(pos) >= F.col(n) - season)
    shifted = F.timestamp_add("SECOND", F.lit(season * step_seconds), F.col(time))
    return last.select(
        *keys,
        shifted.alias(time),
        (F.col(pos) - F.col(n) + season + 1).cast("long").alias("step"),
        F.col(value).alias("yhat"),
    )
