"""Regular grids, frequency inference, category codes and static covariates."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fadecast.operators.ordered import CHUNK, running, sliding, sorted_positions

FILLS = ("error", "none", "zero", "ffill", "linear")


def seconds_between(start: str | Column, end: str | Column) -> Column:
    return F.timestamp_diff("SECOND", _c(start), _c(end))


def _c(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def time_extents(df: DataFrame, keys: Sequence[str], time: str) -> DataFrame:
    return df.groupBy(*keys).agg(F.min(time).alias("_t0"), F.max(time).alias("_t1"))


def _with_inferred_step(ext: DataFrame, df: DataFrame, keys: Sequence[str], time: str) -> DataFrame:
    """The step of each key; a key with one time has a grid of one row."""
    steps = infer_step(df, keys, time).withColumnsRenamed({k: f"_k_{k}" for k in keys})
    same = [F.col(k).eqNullSafe(F.col(f"_k_{k}")) for k in keys]
    d = ext.join(steps, same, "left") if keys else ext.join(steps, how="left")
    irregular = F.raise_error(F.lit("the times of a series have no common step"))
    step = F.when(~F.col("regular"), irregular.cast("long")).otherwise(F.coalesce("step_seconds", F.lit(1)))
    return d.select(*keys, "_t0", "_t1", step.cast("long").alias("_step"))


def _add_steps(start: Column, steps: Column, step: int | Column) -> Column:
    return F.timestamp_add("SECOND", (steps * step).cast("long"), start)


def regularise(
    df: DataFrame,
    keys: Sequence[str],
    time: str,
    step: int | None,
    *,
    fill: str = "none",
    values: Sequence[str] | None = None,
    size: int = CHUNK,
) -> DataFrame:
    """One row per grid step from the first to the last time of each key.

    Adds ``pos`` (0-based grid position) and ``n`` (grid length). Two rows at one time
    of a key fail: every position after them would be off by one. Without ``step`` the
    step of each key is inferred, and an irregular key fails. Missing steps
    get null values, or are filled: ``zero``, ``ffill`` (last seen value),
    ``linear`` (between the neighbours); ``error`` fails on a gap. A row off the
    grid also fails: dropping it would change the result without a word.

    The grid of a key is made chunk by chunk on many tasks, so a long series
    does not have to fit one of them.
    """
    if fill not in FILLS:
        raise ValueError(f"fill must be one of {FILLS}")
    values = list(values if values is not None else [c for c in df.columns if c not in (*keys, time)])
    ext = time_extents(df, keys, time)
    if step is None:
        ext = _with_inferred_step(ext, df, keys, time)
        each = F.col("_step")
    else:
        each = F.lit(step).cast("long")
        ext = ext.withColumn("_step", each)
    ext = ext.withColumn("n", F.floor(seconds_between("_t0", "_t1") / each).cast("long") + 1)
    chunks = ext.withColumn(
        "_from", F.explode(F.sequence(F.lit(0).cast("long"), F.col("n") - 1, F.lit(size).cast("long")))
    ).repartition(*keys, "_from")
    grid = chunks.withColumn(
        "pos",
        F.explode(F.sequence(F.col("_from"), F.least(F.col("_from") + size, F.col("n")) - 1)),
    ).select(*keys, _add_steps(F.col("_t0"), F.col("pos"), F.col("_step")).alias(time), "pos", "n")
    # One row per time, by the same partitioning as the join below.
    seen = df.groupBy(*keys, time).agg(
        *[F.first(v).alias(v) for v in values], F.count(F.lit(1)).alias("_seen")
    )
    twice = F.raise_error(F.concat(F.lit("two rows at one time: "), F.col(time).cast("string")))
    if fill == "error":
        miss = F.raise_error(F.lit("the series has gaps; choose a fill"))
        joined = grid.join(seen, [*keys, time], "full")
        joined = joined.withColumn("pos", F.when(F.col("_seen").isNull(), miss.cast("long")).otherwise(F.col("pos")))
    else:
        joined = grid.join(seen, [*keys, time], "full")
    off = F.raise_error(F.concat(F.lit("time off the grid: "), F.col(time).cast("string")))
    joined = joined.withColumn(
        "pos", F.when(F.col("n").isNull(), off.cast("long")).otherwise(F.col("pos"))
    )
    joined = joined.withColumn(
        "pos", F.when(F.col("_seen") > 1, twice.cast("long")).otherwise(F.col("pos"))
    ).drop("_seen")
    if fill == "zero":
        joined = joined.withColumns({v: F.coalesce(F.col(v), F.lit(0.0)) for v in values})
    elif fill == "ffill":
        joined = _fill_forward(joined, keys, values, size)
    elif fill == "linear":
        joined = _fill_linear(joined, keys, values, size)
    return joined.select(*keys, time, *values, "pos", "n")


def _fill_forward(df, keys, values, size):
    at = {f"_at_{v}": ("max", F.when(F.col(v).isNotNull(), F.struct("pos", v))) for v in values}
    r = running(df, keys, "pos", at, size=size)
    return r.withColumns({v: F.col(f"_at_{v}")[v] for v in values}).drop(*at)


def _fill_linear(df, keys, values, size):
    """Straight line between the neighbours seen; the ends stay as they are."""
    before = {f"_b_{v}": ("max", F.when(F.col(v).isNotNull(), F.struct("pos", v))) for v in values}
    d = running(df, keys, "pos", before, size=size).withColumn("_rev", F.col("n") - 1 - F.col("pos"))
    after = {f"_a_{v}": ("max", F.when(F.col(v).isNotNull(), F.struct("_rev", v))) for v in values}
    d = running(d, keys, "_rev", after, size=size)
    cols = {}
    for v in values:
        b, a = F.col(f"_b_{v}"), F.col(f"_a_{v}")
        p0, p1 = b["pos"], F.col("n") - 1 - a["_rev"]
        part = (F.col("pos") - p0) / (p1 - p0)
        cols[v] = F.when(F.col(v).isNotNull(), F.col(v)).otherwise(b[v] + (a[v] - b[v]) * part)
    return d.withColumns(cols).drop("_rev", *before, *after)


def infer_step(df: DataFrame, keys: Sequence[str], time: str) -> DataFrame:
    """Step of each key: the smallest gap, which must divide all the others.

    Returns ``keys, step_seconds, n_gaps, regular``. Gaps are taken between
    neighbours in sorted order; equal times give no gap.
    """
    p = sorted_positions(df.select(*keys, time).distinct(), keys, [time], pos="_p")
    g = sliding(
        p, keys, "_p", lambda w: {"_gap": seconds_between(F.lag(time).over(w), time)}, back=1
    ).filter(F.col("_gap").isNotNull())
    # Distinct gaps are few, but their number is not bounded: test each against
    # the smallest by a join of two aggregates.
    sizes = g.groupBy(*keys, "_gap").agg(F.count(F.lit(1)).alias("_n"))
    least = sizes.groupBy(*keys).agg(F.min("_gap").alias("step_seconds"))
    return (
        sizes.join(least, list(keys))
        .groupBy(*keys, "step_seconds")
        .agg(
            F.sum("_n").alias("n_gaps"),
            F.min((F.col("_gap") % F.col("step_seconds")) == 0).alias("regular"),
        )
    )


def category_codes(df: DataFrame, key: str, *, out: str = "code") -> DataFrame:
    """Dictionary of the distinct values of ``key``, numbered in sorted order.

    Build it once and join it to every table that needs the codes, so that one
    value has one code everywhere.
    """
    keys = df.select(key).filter(F.col(key).isNotNull()).distinct()
    return sorted_positions(keys, [], [key], pos=out)


def with_codes(df: DataFrame, codes: DataFrame, key: str) -> DataFrame:
    return df.join(codes, key, "left")


MAX_ONE_HOT = 64


def known_values(df: DataFrame, key: str) -> tuple[str, ...]:
    """The distinct values of ``key`` in order, for one-hot columns.

    More than MAX_ONE_HOT values fail: number them by ``category_codes`` instead.
    """
    rows = df.select(key).filter(F.col(key).isNotNull()).distinct().limit(MAX_ONE_HOT + 1).collect()
    if len(rows) > MAX_ONE_HOT:
        raise ValueError(f"{key} has more than {MAX_ONE_HOT} values; use codes")
    return tuple(sorted(r[0] for r in rows))


def one_hot(df: DataFrame, key: str, values: Sequence[str]) -> DataFrame:
    """Static covariates: one 0/1 column per listed value of the key.

    A value that is not listed fails, since all-zero columns would hide it; a null key has nulls.
    """
    stray = F.raise_error(F.concat(F.lit("value without a column: "), F.col(key).cast("string"))).cast("double")
    listed = F.col(key).isin(*values) if values else F.lit(False)
    return df.withColumns(
        {f"is_{v}": F.when(listed | F.col(key).isNull(), (F.col(key) == v).cast("double")).otherwise(stray) for v in values}
    )


def covariates_full(history: DataFrame, future: DataFrame, target: Sequence[str]) -> DataFrame:
    """History without its target, followed by the known future."""
    return history.drop(*target).unionByName(future, allowMissingColumns=True)
