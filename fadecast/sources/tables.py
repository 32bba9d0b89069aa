"""Input tables: the driver's parquet files and the two model cases over them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fadecast.session import prepare


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    prepare(spark)
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _number_in(props: str) -> F.Column:
    return F.regexp_extract(props, "[0-9]+", 0).cast("int")


def _hourly(events: DataFrame, key, unit: str) -> DataFrame:
    """Price-like series with gaps: mean value per key and time unit.

    The mean is taken over whole cents so that it is the same for every order
    of summation.
    """
    cents = F.round(F.col("value") * 100.0).cast("long")
    return (
        events.groupBy(
            key.alias("unique_id"),
            F.date_trunc(unit, "ts").cast("timestamp_ntz").alias("ds"),
        )
        .agg(
            F.sum(cents).cast("double").alias("_cents"),
            F.count(F.lit(1)).cast("double").alias("Exogenous1"),
            F.max(_number_in("props")).cast("double").alias("Exogenous2"),
        )
        .select(
            "unique_id",
            "ds",
            (F.col("_cents") / (100.0 * F.col("Exogenous1"))).alias("y"),
            "Exogenous1",
            "Exogenous2",
        )
    )


def electricity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``unique_id, ds, y, Exogenous1, Exogenous2``, hourly with gaps."""
    return _hourly(load(spark, sf_dir, "events"), F.col("event_type"), "hour")


def electricity_by_user(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Many short daily series, for tests of width."""
    return _hourly(load(spark, sf_dir, "events"), F.col("user_id").cast("string"), "day")


def electricity_future(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Known covariates of the day after the history; no target."""
    past = electricity(spark, sf_dir)
    last = past.groupBy("unique_id").agg(F.date_trunc("day", F.max("ds")).cast("timestamp_ntz").alias("_day"))
    return (
        past.join(last, "unique_id")
        .filter(F.col("ds") >= F.col("_day"))
        .select(
            "unique_id",
            (F.col("ds") + F.expr("INTERVAL '1' DAY")).alias("ds"),
            "Exogenous1",
            "Exogenous2",
        )
    )


def discharge(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Battery measurements; ``event_id`` is the file order."""
    e = load(spark, sf_dir, "events")
    k = _number_in("props")
    day, cell = F.dayofmonth("ts"), F.col("user_id") % 4
    clock = F.hour("ts") * 3600 + F.minute("ts") * 60 + F.floor(F.second("ts"))
    return e.select(
        "event_id",
        F.concat(F.lit("B"), cell.cast("string")).alias("battery_id"),
        (2 * day).cast("int").alias("cycle"),
        F.lit(24.0).alias("ambient_temperature"),
        F.date_trunc("day", "ts").cast("timestamp_ntz").alias("datetime"),
        F.col("ts").cast("timestamp_ntz").alias("datetime_"),
        (2.0 + F.col("value") / 250.0).alias("Voltage_measured"),
        (-k / 50.0).alias("Current_measured"),
        (24.0 + k / 5.0).alias("Temperature_measured"),
        clock.cast("double").alias("Time"),
        (2.0 - 0.01 * day - 0.001 * cell).alias("Capacity"),
    )


def order_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows in file order whose timestamps repeat."""
    return load(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("row_id"),
        F.col("o_orderdate").alias("datetime"),
        F.col("o_totalprice").alias("value"),
    )
