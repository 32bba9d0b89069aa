"""Seasonal decomposition, autocorrelation and partial autocorrelation."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fadecast.operators.ordered import CHUNK, segments, sliding

# Lags shown, and the normal quantile of a 95 % band.
LAGS = 100
Z95 = 1.959964


def seasonal_decompose(
    df: DataFrame,
    keys: Sequence[str],
    value: str,
    period: int,
    *,
    pos: str = "pos",
    n: str = "n",
    size: int = CHUNK,
) -> DataFrame:
    """Additive ``trend``, ``seasonal``, ``resid`` on a gap-free regular series.

    The trend is a centred moving average (ends weighted half for an even
    period) and null where the average is not complete. Nulls in the series and
    series shorter than two periods fail.
    """
    half = period // 2
    checked = F.when(F.col(value).isNull(), F.raise_error(F.lit("null in the series")).cast("double"))
    checked = checked.when(
        F.col(n) < 2 * period, F.raise_error(F.lit("needs two full periods")).cast("double")
    ).otherwise(F.col(value))
    d = df.withColumn("_y", checked)

    def trend(w):
        mid = w.rowsBetween(-half, half)
        s = F.sum("_y").over(mid)
        if period % 2 == 0:
            s = s - (F.lag("_y", half).over(w) + F.lead("_y", half).over(w)) / 2
        inside = (F.col(pos) >= half) & (F.col(pos) < F.col(n) - half)
        return {"trend": F.when(inside, s / period)}

    d = sliding(d, keys, pos, trend, back=half, ahead=half, size=size)
    d = d.withColumn("_phase", F.col(pos) % period).withColumn("_dev", F.col("_y") - F.col("trend"))
    # At most ``period`` rows per key, so centring them in a window is safe.
    phase = d.groupBy(*keys, "_phase").agg(F.avg("_dev").alias("_m"))
    phase = phase.withColumn(
        "seasonal", F.col("_m") - F.avg("_m").over(Window.partitionBy(*keys))
    ).drop("_m")
    d = d.join(phase, [*keys, "_phase"])
    return d.withColumn("resid", F.col("_dev") - F.col("seasonal")).drop("_y", "_phase", "_dev")


def autocovariance_sums(
    df: DataFrame,
    keys: Sequence[str],
    value: str,
    lags: int = LAGS,
    *,
    pos: str = "pos",
    size: int = 4096,
) -> DataFrame:
    """``keys, lag, s``: sums of products of deviations ``lag`` rows apart.

    Rows are cut into chunks that see ``lags`` rows ahead; each chunk gives one
    partial sum per lag, so what is shuffled does not grow with the rows of a
    chunk.
    """
    mean = df.groupBy(*keys).agg(F.avg(value).alias("_mean"))
    d = df.join(mean, list(keys)).withColumn("_d", F.col(value) - F.col("_mean"))
    seg = segments(d, keys, pos, ["_d"], ahead=lags, size=size)

    @F.pandas_udf(T.ArrayType(T.DoubleType()))
    def products(d: pd.Series, start: pd.Series, stop: pd.Series) -> pd.Series:
        out = []
        for a, s, e in zip(d, start, stop):
            m = int(e - s)
            later = [a[k : k + m] for k in range(lags + 1)]
            out.append([float(a[: len(b)] @ b) for b in later])
        return pd.Series(out)

    # A copied row before the chunk does not exist (ahead only), so the array
    # starts at the chunk's first own row.
    p = seg.select(*keys, products("_d", "start", "own_to").alias("_p"))
    return (
        p.select(*keys, F.posexplode("_p").alias("lag", "_s"))
        .groupBy(*keys, "lag")
        .agg(F.sum("_s").alias("s"))
    )


def acf(
    df: DataFrame,
    keys: Sequence[str],
    value: str,
    lags: int = LAGS,
    *,
    pos: str = "pos",
    size: int = 4096,
) -> DataFrame:
    """``keys, lag, r, band``: autocorrelation with its 95 % band.

    A constant series has no autocorrelation: ``r`` and ``band`` are null.
    """
    sums = autocovariance_sums(df, keys, value, lags, pos=pos, size=size)
    n = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"), F.min(value).alias("_lo"), F.max(value).alias("_hi"))
    base = sums.filter("lag = 0").select(*keys, F.col("s").alias("_s0"))
    r = F.when(F.col("_lo") != F.col("_hi"), F.col("s") / F.nullif(F.col("_s0"), F.lit(0.0)))
    d = sums.join(base, list(keys)).join(n, list(keys)).filter(F.col("lag") < F.col("n"))
    d = d.withColumn("r", r)
    # lags + 1 rows per key.
    w = Window.partitionBy(*keys).orderBy("lag").rowsBetween(Window.unboundedPreceding, -1)
    prior = F.coalesce(F.sum(F.when(F.col("lag") > 0, F.col("r") * F.col("r"))).over(w), F.lit(0.0))
    band = F.when(F.col("lag") == 0, F.lit(0.0)).otherwise(
        Z95 * F.sqrt((1 + 2 * prior) / F.col("n"))
    )
    return d.withColumn("band", F.when(F.col("r").isNotNull(), band)).select(
        *keys, F.col("lag").cast("long").alias("lag"), "r", "band", "n"
    )


def _durbin_levinson(r: np.ndarray) -> np.ndarray:
    """Partial autocorrelations from autocorrelations r[0..m]."""
    m = len(r) - 1
    out, phi = np.full(m + 1, np.nan), np.zeros(0)
    out[0] = 1.0
    for k in range(1, m + 1):
        den = 1.0 - phi @ r[1:k]
        if abs(den) < 1e-12:
            break
        last = (r[k] - phi @ r[k - 1 : 0 : -1]) / den
        phi = np.append(phi - last * phi[::-1], last)
        out[k] = last
    return out


def pacf(acf_table: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``keys, lag, pacf, band`` from the autocorrelations (one row per lag)."""
    key_fields = [acf_table.schema[k] for k in keys]
    schema = T.StructType(
        [*key_fields, T.StructField("lag", T.LongType()), T.StructField("pacf", T.DoubleType()),
         T.StructField("band", T.DoubleType())]
    )

    def solve(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("lag")
        r = pdf["r"].to_numpy(dtype=float)
        ok = not np.isnan(r).any()
        vals = _durbin_levinson(r) if ok else np.full(len(r), np.nan)
        n = float(pdf["n"].iloc[0])
        band = np.where(pdf["lag"] == 0, 0.0, Z95 / np.sqrt(n))
        out = pdf[[*keys, "lag"]].copy()
        out["pacf"] = vals
        out["band"] = np.where(np.isnan(vals), np.nan, band)
        return out

    solved = acf_table.groupBy(*keys).applyInPandas(solve, schema)
    return solved.withColumns(
        {c: F.when(~F.isnan(c), F.col(c)) for c in ("pacf", "band")}
    )
