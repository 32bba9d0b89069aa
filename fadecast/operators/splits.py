"""Chronological splits by position and their boundary report."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fadecast.operators.ordered import positions, sorted_positions

# Shares of the training and validation split.
TRAIN_SHARE = 0.8
VAL_SHARE = 0.1


def split_by_position(
    df: DataFrame,
    keys: Sequence[str],
    ordinal: str,
    *,
    train: float = TRAIN_SHARE,
    val: float = VAL_SHARE,
    gap: int = 0,
    by_time: str | None = None,
    size: int | None = None,
) -> DataFrame:
    """Label rows ``train``, ``val`` or ``test``.

    Sizes are whole parts of the shares, the test split takes the rest. Rows
    are counted in file order, or by ``by_time`` first if given. With ``gap``
    the validation split starts that many rows later and the rows between
    belong to no split.
    """
    if by_time:
        p = sorted_positions(df, keys, [by_time, ordinal], pos="pos", total="n")
    else:
        p = positions(df, keys, ordinal, pos="pos", total="n", size=size)
    t_end = F.floor(F.lit(float(train)) * F.col("n"))
    v_end = t_end + F.floor(F.lit(float(val)) * F.col("n"))
    label = (
        F.when(F.col("pos") < t_end, "train")
        .when((F.col("pos") >= t_end + gap) & (F.col("pos") < v_end), "val")
        .when(F.col("pos") >= v_end, "test")
    )
    return p.withColumn("split", label).filter(F.col("split").isNotNull())


def split_boundaries(split: DataFrame, keys: Sequence[str], time: str) -> DataFrame:
    """Sizes, time range per split, second-last training row, first validation row."""
    s, t, p = F.col("split"), F.col(time), F.col("pos")

    def part(name):
        return F.when(s == name, t)

    cols = []
    for name in ("train", "val", "test"):
        cols += [
            F.count(F.when(s == name, 1)).alias(f"n_{name}"),
            F.min(part(name)).alias(f"min_{name}"),
            F.max(part(name)).alias(f"max_{name}"),
        ]
    t_end = F.floor(F.lit(TRAIN_SHARE) * F.col("n"))
    cols.append(F.max(F.when(p == t_end - 2, t)).alias("second_last_train"))
    cols.append(F.min_by(part("val"), F.when(s == "val", p)).alias("first_val"))
    return split.groupBy(*keys).agg(*cols)
