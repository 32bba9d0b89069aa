"""Encoder/decoder windows: what a model sees before and at a row."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fadecast.operators.ordered import CHUNK, sliding

# Fixed value: longest encoder.
ENCODER = 30


def encoder_windows(
    df: DataFrame,
    keys: Sequence[str],
    pos: str,
    columns: Sequence[str],
    *,
    known: Sequence[str],
    unknown: Sequence[str],
    longest: int = ENCODER,
    size: int = CHUNK,
) -> DataFrame:
    """Add ``encoder`` and ``decoder`` to each row of the horizon.

    ``encoder`` holds up to ``longest`` earlier rows of the group; ``decoder``
    is the row itself with its ``unknown`` columns blanked.
    """
    types = dict(df.dtypes)
    blank = [F.lit(None).cast(types[c]).alias(c) for c in unknown]

    def cols(w):
        past = w.rowsBetween(-longest, -1)
        body = F.struct(*[F.col(c) for c in columns])
        return {
            "encoder": F.collect_list(body).over(past),
            "decoder": F.struct(*[F.col(c) for c in known], *blank),
        }

    return sliding(df, keys, pos, cols, back=longest, size=size)
