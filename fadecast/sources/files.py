"""CSV and Parquet readers and writers with explicit schemas."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The text format of the dates in the known-future file.
US_DATES = "M/d/yyyy H:mm"

ELECTRICITY_SCHEMA = T.StructType(
    [
        T.StructField("unique_id", T.StringType()),
        T.StructField("ds", T.TimestampNTZType()),
        T.StructField("y", T.DoubleType()),
        T.StructField("Exogenous1", T.DoubleType()),
        T.StructField("Exogenous2", T.DoubleType()),
    ]
)

BATTERY_SCHEMA = T.StructType(
    [
        T.StructField("cycle", T.IntegerType()),
        T.StructField("ambient_temperature", T.DoubleType()),
        T.StructField("datetime", T.TimestampNTZType()),
        T.StructField("Voltage_measured", T.DoubleType()),
        T.StructField("Current_measured", T.DoubleType()),
        T.StructField("Temperature_measured", T.DoubleType()),
        T.StructField("Time", T.DoubleType()),
        T.StructField("Capacity", T.DoubleType()),
        T.StructField("datetime_", T.TimestampNTZType()),
    ]
)

FUTURE_SCHEMA = T.StructType(
    [
        T.StructField("unique_id", T.StringType()),
        T.StructField("ds", T.StringType()),
        T.StructField("Exogenous1", T.DoubleType()),
        T.StructField("Exogenous2", T.DoubleType()),
    ]
)


def read_csv(
    spark: SparkSession, path: str, schema: T.StructType, *, file_order: bool = False
) -> DataFrame:
    """CSV with a header line. ``file_order`` keeps the order of the lines."""
    df = (
        spark.read.schema(schema)
        .option("header", True)
        .option("timestampNTZFormat", "yyyy-MM-dd[ HH:mm:ss[.SSSSSS]]")
        .csv(path)
    )
    return with_file_order(df) if file_order else df


def with_file_order(df: DataFrame) -> DataFrame:
    """Add ``_file, _block, _row``: sorting by them gives the lines in order.

    The row id alone would not do, since Spark packs file splits by size.
    """
    return df.select(
        "*",
        F.col("_metadata.file_path").alias("_file"),
        F.col("_metadata.file_block_start").alias("_block"),
        F.monotonically_increasing_id().alias("_row"),
    )


def write_csv(df: DataFrame, path: str) -> None:
    (
        df.write.mode("errorifexists")
        .option("header", True)
        .option("timestampNTZFormat", "yyyy-MM-dd HH:mm:ss.SSSSSS")
        .csv(path)
    )


def write_splits(df: DataFrame, path: str, split: str = "split") -> None:
    """Parquet with one folder per split."""
    df.write.mode("errorifexists").partitionBy(split).parquet(path)


def read_split(spark: SparkSession, path: str, name: str | None = None) -> DataFrame:
    df = spark.read.parquet(path)
    return df if name is None else df.filter(F.col("split") == name)


def parse_time(col: str | Column, formats: Sequence[str], *, strict: bool = True) -> Column:
    """Text to zone-free timestamp; the first format that fits wins.

    ``strict`` fails on text no format fits, otherwise such text gives null.
    """
    c = F.col(col) if isinstance(col, str) else col
    tries = [F.try_to_timestamp(c, F.lit(f)).cast("timestamp_ntz") for f in formats]
    out = F.coalesce(*tries)
    if strict:
        bad = F.raise_error(F.concat(F.lit("not a timestamp: "), c))
        out = F.when(c.isNotNull() & out.isNull(), bad.cast("timestamp_ntz")).otherwise(out)
    return out
