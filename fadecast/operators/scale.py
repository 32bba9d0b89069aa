"""Per-series scaling from tables of statistics."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def minmax_stats(
    df: DataFrame, keys: Sequence[str], columns: Sequence[str], *, where: Column | None = None
) -> DataFrame:
    """Smallest and largest value per key; ``where`` limits the rows fitted on."""
    d = df if where is None else df.filter(where)
    aggs = []
    for c in columns:
        aggs += [F.min(c).alias(f"{c}_min"), F.max(c).alias(f"{c}_max")]
    return d.groupBy(*keys).agg(*aggs)


def _with_stats(df: DataFrame, stats: DataFrame, keys: Sequence[str]) -> DataFrame:
    # No hint: Spark broadcasts the table if it is small, otherwise adaptive
    # execution splits the partition of a hot key.
    return df.join(stats, list(keys), "left")


def minmax_apply(
    df: DataFrame,
    stats: DataFrame,
    keys: Sequence[str],
    columns: Sequence[str],
    *,
    suffix: str = "_scaled",
) -> DataFrame:
    """(x - min) / (max - min); a constant series gives 0."""
    d = _with_stats(df, stats, keys)
    cols = {}
    for c in columns:
        lo, hi, x = F.col(f"{c}_min"), F.col(f"{c}_max"), F.col(c)
        cols[c + suffix] = F.when(hi == lo, x - lo).otherwise((x - lo) / F.nullif(hi - lo, F.lit(0.0)))
    return d.withColumns(cols).drop(*_stat_names(columns))


def minmax_invert(
    df: DataFrame,
    stats: DataFrame,
    keys: Sequence[str],
    columns: dict[str, str],
    *,
    suffix: str = "_raw",
) -> DataFrame:
    """x * (max - min) + min; ``columns`` maps a scaled column to its source."""
    d = _with_stats(df, stats, keys)
    cols = {
        s + suffix: F.col(s) * (F.col(f"{c}_max") - F.col(f"{c}_min")) + F.col(f"{c}_min")
        for s, c in columns.items()
    }
    return d.withColumns(cols).drop(*_stat_names(columns.values()))


def _stat_names(columns) -> list[str]:
    return [f"{c}_{s}" for c in columns for s in ("min", "max")]


def normalise_group(
    df: DataFrame, keys: Sequence[str], column: str, *, out: str = "normalised"
) -> DataFrame:
    """(x - mean) / standard deviation per key; deviation 0 or null counts as 1."""
    stats = df.groupBy(*keys).agg(
        F.avg(column).alias("_mean"),
        F.stddev_samp(column).alias("_sd"),
        (F.min(column) == F.max(column)).alias("_flat"),
    )
    sd = F.when(F.col("_flat") | F.col("_sd").isNull() | (F.col("_sd") == 0), 1.0).otherwise(
        F.col("_sd")
    )
    d = _with_stats(df, stats, keys)
    return d.withColumn(out, (F.col(column) - F.col("_mean")) / sd).drop("_mean", "_sd", "_flat")
