"""Projection, filters, duplicates and timestamp repair."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fadecast.operators.ordered import CHUNK, positions, running, sliding

# The battery columns kept for modelling and the sampling step.
BATTERY_COLUMNS = (
    "cycle",
    "ambient_temperature",
    "Voltage_measured",
    "Current_measured",
    "Temperature_measured",
    "Time",
    "Capacity",
)
SAMPLE_SECONDS = 15


def project_tail(df: DataFrame, skip: int, keep: Sequence[str] = ()) -> DataFrame:
    """``keep`` plus the columns from position ``skip`` on."""
    tail = [c for c in df.columns[skip:] if c not in keep]
    return df.select(*keep, *tail)


def time_between(col: str, start: str, end: str) -> Column:
    """Closed range: both ends belong to it."""
    return F.col(col).between(
        F.lit(start).cast("timestamp_ntz"), F.lit(end).cast("timestamp_ntz")
    )


def time_from(col: str, partial: str) -> Column:
    """Everything from the start of the year, month or day ``yyyy[-MM[-dd]]``."""
    parts = partial.split("-")
    full = "-".join(parts + ["01"] * (3 - len(parts)))
    return F.col(col) >= F.lit(f"{full} 00:00:00").cast("timestamp_ntz")


def discharge_cycle_id(cycle: str = "cycle") -> Column:
    """Discharge cycles carry even numbers: 2 is the first, 4 the second."""
    return F.floor(F.col(cycle) / 2).cast("long")


def keep_first(df: DataFrame, keys: Sequence[str], ordinal: str) -> DataFrame:
    """One row per ``keys``: the first by ``ordinal``.

    An aggregate and not a window: copies collapse before the shuffle, however
    many there are of one timestamp.
    """
    rest = [c for c in df.columns if c not in keys]
    first = F.min_by(F.struct(*rest), F.col(ordinal)).alias("_r")
    return df.groupBy(*keys).agg(first).select(
        *[F.col(c) if c in keys else F.col(f"_r.{c}").alias(c) for c in df.columns]
    )


def rows_at(
    df: DataFrame,
    keys: Sequence[str],
    ordinal: str,
    labels: dict[str, int],
    *,
    size: int | None = None,
) -> DataFrame:
    """Rows picked by position; a negative position counts from the end."""
    p = positions(df, keys, ordinal, pos="_p", total="_n", size=size)
    names = [
        F.when(F.col("_p") == (F.lit(i) if i >= 0 else F.col("_n") + i), F.lit(n))
        for n, i in labels.items()
    ]
    return (
        p.withColumn("label", F.explode(F.array_compact(F.array(*names))))
        .drop("_p", "_n")
    )


def head(df: DataFrame, ordinal: str, n: int = 5) -> DataFrame:
    return df.orderBy(ordinal).limit(n)


def profile(df: DataFrame) -> DataFrame:
    """Type and number of non-null values of every column, in one pass."""
    counts = df.agg(*[F.count(c).alias(c) for c in df.columns])
    long = counts.unpivot([], list(df.columns), "column_name", "non_null")
    types = F.create_map(*[F.lit(v) for f in df.dtypes for v in f])
    return long.withColumn("dtype", types[F.col("column_name")])


def repair_timestamps(
    df: DataFrame,
    keys: Sequence[str],
    ordinal: str,
    time: str = "datetime",
    *,
    out: str = "repaired",
    step: int = SAMPLE_SECONDS,
    size: int = CHUNK,
    ordinals: int | None = None,
) -> DataFrame:
    """Spread a run of equal consecutive timestamps ``step`` seconds apart.

    A run is counted in file order; a value that comes back later starts a new
    run. The start of a run is carried over chunk borders as a running maximum
    of start positions.
    """
    p = positions(df, keys, ordinal, pos="_p", size=ordinals)
    starts = sliding(
        p,
        keys,
        "_p",
        lambda w: {"_start": ~F.lag(time).over(w).eqNullSafe(F.col(time)) | (F.col("_p") == 0)},
        back=1,
        size=size,
    )
    run = running(
        starts, keys, "_p", {"_from": ("max", F.when(F.col("_start"), F.col("_p")))}, size=size
    )
    n = F.col("_p") - F.col("_from")
    shift = F.make_dt_interval(secs=(n * step).cast("decimal(18,6)"))
    return run.withColumn(out, F.col(time) + shift).drop("_p", "_start", "_from")
