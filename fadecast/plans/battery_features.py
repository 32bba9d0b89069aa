"""Per-cycle features of battery discharge measurements."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fadecast.operators.clean import discharge_cycle_id
from fadecast.operators.ordered import positions


def cycle_features(measured: DataFrame, keys: tuple[str, ...] = ("battery_id",)) -> DataFrame:
    """Means and extremes of each discharge cycle, its duration and capacity."""
    return measured.groupBy(*keys, discharge_cycle_id().alias("discharge_cycle_id")).agg(
        F.avg("Voltage_measured").alias("voltage_mean"),
        F.min("Voltage_measured").alias("voltage_min"),
        F.max("Voltage_measured").alias("voltage_max"),
        F.avg("Current_measured").alias("current_mean"),
        F.max("Current_measured").alias("current_max"),
        F.avg("Temperature_measured").alias("temperature_mean"),
        F.max("Temperature_measured").alias("temperature_max"),
        F.max("Time").alias("time_total"),
        F.max("Capacity").alias("capacity"),
    )


def numbered_features(
    measured: DataFrame, keys: tuple[str, ...] = ("battery_id",), *, size: int | None = None
) -> DataFrame:
    """Cycle features with ``pos`` and ``n`` in the order of the cycles."""
    f = cycle_features(measured, keys)
    return positions(f, keys, "discharge_cycle_id", total="n", size=size)


def capacity_fade(features: DataFrame, keys: tuple[str, ...] = ("battery_id",)) -> DataFrame:
    """Capacity lost since the first cycle."""
    first = features.groupBy(*keys).agg(F.min_by("capacity", "discharge_cycle_id").alias("_c0"))
    return features.join(first, list(keys)).withColumn(
        "capacity_fade", F.col("_c0") - F.col("capacity")
    ).drop("_c0")
