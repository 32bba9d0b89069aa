"""Pairing forecasts with actual values and scoring them."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def align(
    forecast: DataFrame, actual: DataFrame, keys: Sequence[str], time: str, value: str
) -> DataFrame:
    """Pair each forecast row with the actual value of its series and time.

    A forecast row without an actual value fails: leaving it out would score
    fewer points than were forecast.
    """
    a = actual.select(*keys, time, F.col(value).alias("actual"), F.lit(True).alias("_hit"))
    d = forecast.join(a, [*keys, time], "left")
    miss = F.raise_error(F.concat(F.lit("no actual value at "), F.col(time).cast("string")))
    return d.withColumn(
        "actual", F.when(F.col("_hit").isNull(), miss.cast("double")).otherwise(F.col("actual"))
    ).drop("_hit")


def _scored(yhat: str, partial: bool) -> Column:
    """The forecast; a missing one fails, unless a partial score is asked for."""
    if partial:
        return F.col(yhat)
    missing = F.raise_error(F.lit("a forecast is missing; ask for a partial score")).cast("double")
    return F.when(F.col(yhat).isNull(), missing).otherwise(F.col(yhat))


def errors(
    aligned: DataFrame, by: Sequence[str], yhat: str = "yhat", *, partial: bool = False
) -> DataFrame:
    """RMSE, MAE and MAPE per group; a zero actual value has no MAPE share.

    With ``partial`` missing forecasts are left out, and ``n_scored`` stands beside
    ``n_points``.
    """
    e = F.col("actual") - _scored(yhat, partial)
    rel = F.abs(e) / F.nullif(F.abs(F.col("actual")), F.lit(0.0))
    return aligned.groupBy(*by).agg(
        F.count(F.lit(1)).alias("n_points"),
        *([F.count(yhat).alias("n_scored")] if partial else []),
        F.sqrt(F.avg(e * e)).alias("rmse"),
        F.avg(F.abs(e)).alias("mae"),
        F.avg(rel).alias("mape"),
    )


def nested_rmse(
    aligned: DataFrame,
    keys: Sequence[str],
    fold: str,
    by: Sequence[str] = (),
    yhat: str = "yhat",
    *,
    partial: bool = False,
) -> DataFrame:
    """Mean over folds of the mean over series of the RMSE of one fold.

    Not the RMSE of all points pooled. A missing forecast fails unless ``partial``.
    """
    e = F.col("actual") - _scored(yhat, partial)
    per_series = aligned.groupBy(*by, fold, *keys).agg(F.sqrt(F.avg(e * e)).alias("_s"))
    per_fold = per_series.groupBy(*by, fold).agg(F.avg("_s").alias("_f"))
    return per_fold.groupBy(*by).agg(F.avg("_f").alias("rmse"), F.count(F.lit(1)).alias("n_folds"))


def best_with_ties(scores: DataFrame, score: str) -> DataFrame:
    """All rows with the smallest score."""
    least = scores.agg(F.min(score).alias("_least"))
    # One row by construction, so it is safe to send to every task.
    return scores.join(F.broadcast(least), F.col(score) == F.col("_least")).drop("_least")


def best_first(scores: DataFrame, score: str, tie: Sequence[str]) -> DataFrame:
    """The one row with the smallest score; ties are broken by ``tie``."""
    return scores.orderBy(score, *tie).limit(1)


def extents(df: DataFrame, keys: Sequence[str], time: str) -> DataFrame:
    return df.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n"), F.min(time).alias("first"), F.max(time).alias("last")
    )


def shared_extents(ext: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Number the groups of series that cover the same range.

    ``group_first`` names a group by its smallest key, ``group_size`` counts
    its members: many series may share one range, so members are not listed.
    """
    g = ext.groupBy("first", "last").agg(
        F.min(F.struct(*keys)).alias("_g"), F.count(F.lit(1)).alias("group_size")
    )
    return ext.join(g, ["first", "last"]).withColumns(
        {f"group_first_{k}": F.col("_g")[k] for k in keys}
    ).drop("_g")
