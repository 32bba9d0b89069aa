"""Calendar encoders as column expressions."""

from __future__ import annotations

import math
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Encoded attributes, their period and their smallest value.
PERIODS = {"hour": 24, "day": 31, "dayofweek": 7, "week": 52, "month": 12}
FIRST = {"hour": 0, "day": 1, "dayofweek": 0, "week": 1, "month": 1}
ATTRIBUTES = tuple(PERIODS)
ZONE = "CET"


def attribute(name: str, time: str | Column) -> Column:
    """hour, day (of month), dayofweek (Monday 0), week (ISO) or month."""
    t = F.col(time) if isinstance(time, str) else time
    fn = {
        "hour": F.hour,
        "day": F.dayofmonth,
        "dayofweek": F.weekday,
        "week": F.weekofyear,
        "month": F.month,
    }[name]
    return fn(t).cast("long")


def angle(name: str, time: str | Column) -> Column:
    return (attribute(name, time) - FIRST[name]) * (2.0 * math.pi / PERIODS[name])


def cyclic(time: str | Column, names: Sequence[str] = ATTRIBUTES) -> dict[str, Column]:
    out = {}
    for n in names:
        out[f"{n}_sin"] = F.sin(angle(n, time))
        out[f"{n}_cos"] = F.cos(angle(n, time))
    return out


def attributes(time: str | Column, names: Sequence[str] = ATTRIBUTES) -> dict[str, Column]:
    return {n: attribute(n, time) for n in names}


def relative_position(pos: str, n_history: str) -> Column:
    """0 at the last observed row, negative before it, positive after it."""
    return (F.col(pos) - F.col(n_history) + 1).cast("long")


def encode_year(time: Column) -> Column:
    return (F.year(time) - 2000) / 50


def in_zone(time: str | Column, zone: str = ZONE, source: str = "UTC") -> Column:
    t = F.col(time) if isinstance(time, str) else time
    return F.convert_timezone(F.lit(source), F.lit(zone), t)


def encode(
    df: DataFrame,
    time: str,
    *,
    cyclic_of: Sequence[str] = (),
    attributes_of: Sequence[str] = (),
    custom: dict[str, Callable[[Column], Column]] | None = None,
    zone: str | None = None,
) -> DataFrame:
    """Add the chosen encodings; ``zone`` shifts the clock first."""
    t = in_zone(time, zone) if zone else F.col(time)
    cols = cyclic(t, cyclic_of) | attributes(t, attributes_of)
    cols |= {n: f(t) for n, f in (custom or {}).items()}
    return df.withColumns(cols)
