"""Lags, fixed-length sequences, latest windows and walk-forward folds."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fadecast.operators.ordered import CHUNK, running, sliding


def lag_features(
    df: DataFrame,
    keys: Sequence[str],
    pos: str,
    columns: Sequence[str],
    lags: Sequence[int],
    *,
    size: int = CHUNK,
) -> DataFrame:
    """``<column>_lag<k>`` for every column and lag."""

    def cols(w):
        return {f"{c}_lag{k}": F.lag(c, k).over(w) for c in columns for k in lags}

    return sliding(df, keys, pos, cols, back=max(lags), size=size)


def sequences(
    df: DataFrame,
    keys: Sequence[str],
    pos: str,
    features: Sequence[str],
    length: int,
    *,
    size: int = CHUNK,
) -> DataFrame:
    """Add ``x``: the ``length`` rows before each row, oldest first.

    The row itself is the label; rows with a shorter past are left out, so a
    series of n rows gives n - length samples.
    """

    def cols(w):
        past = w.rowsBetween(-length, -1)
        return {"x": F.collect_list(F.array(*[F.col(c) for c in features])).over(past)}

    s = sliding(df, keys, pos, cols, back=length, size=size)
    return s.filter(F.size("x") == length)


def spread(x: str, features: Sequence[str], length: int) -> dict[str, Column]:
    """One column per step and feature of a sequence."""
    return {
        f"x{i}_{f}": F.col(x)[i][j] for i in range(length) for j, f in enumerate(features)
    }


def adaptive_length(n: str | Column, longest: int = 20) -> Column:
    """min(longest, n - 1)."""
    c = F.col(n) if isinstance(n, str) else n
    return F.least(F.lit(longest).cast("long"), c.cast("long") - 1)


def hold_out(pos: str, n: str, length: str | Column) -> Column:
    """Role of a labelled row when the last ``length`` samples are kept back."""
    L = F.col(length) if isinstance(length, str) else length
    return F.when(F.col(pos) >= F.col(n) - L, "holdout").otherwise("train")


def latest_window(
    df: DataFrame,
    keys: Sequence[str],
    pos: str,
    total: str,
    features: Sequence[str],
    length: int,
) -> DataFrame:
    """The last ``length`` rows of each key as one array, oldest first."""
    last = df.filter(F.col(pos) >= F.col(total) - length)
    body = F.struct(F.col(pos), F.array(*[F.col(c) for c in features]).alias("v"))
    return last.groupBy(*keys).agg(F.sort_array(F.collect_list(body)).alias("_s")).select(
        *keys, F.col("_s.v").alias("x")
    )


def walk_forward(
    df: DataFrame,
    keys: Sequence[str],
    pos: str,
    first: int,
    sums: Sequence[str],
    *,
    size: int = CHUNK,
) -> DataFrame:
    """Expanding folds: row i is tested on everything before it, from i = first.

    The training side of a fold is its row count and sums, kept by cumulative
    aggregates: listing the rows of every fold would square the table.
    """
    aggs = {"n_train": ("sum", F.lit(1).cast("long"))}
    aggs |= {f"train_sum_{c}": ("sum", F.col(c)) for c in sums}
    r = running(df, keys, pos, aggs, inclusive=False, size=size)
    return r.filter(F.col(pos) >= first)


def history_rows(
    df: DataFrame, keys: Sequence[str], block: str, last: int, *, before: str = "history_"
) -> DataFrame:
    """The rows of the ``last`` blocks before each block, one copy for each block they serve.

    ``block`` is the block served, ``<before><block>`` the row's own. Blocks without rows do
    not count, rows without a block take no part. Rows meet their blocks by an equality on
    the block's number, so nothing is compared that does not match.
    """
    if last < 1:
        raise ValueError("a history has at least one block")
    # One line per block, never rows.
    number = F.row_number().over(Window.partitionBy(*keys).orderBy(block)).cast("long")
    blocks = df.filter(F.col(block).isNotNull()).select(*keys, block).distinct().withColumn("_number", number)
    rows = df.withColumnRenamed(block, before + block).join(
        blocks.withColumnRenamed(block, before + block), [*keys, before + block]
    )
    served = F.explode(F.sequence(F.col("_number") + 1, F.col("_number") + last))
    return rows.withColumn("_number", served).join(blocks, [*keys, "_number"]).drop("_number")
