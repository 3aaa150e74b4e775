"""In-situ loggers: files with differing channels into one resampled series table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F

from sensorloom.operators.filters import drop_null_keys
from sensorloom.operators.resample import resample_grid
from sensorloom.sources.delimited import overwrite_csv, read_logger_long, read_logger_wide


def merged_wide(spark: SparkSession, path: str, channels: Sequence[str]) -> DataFrame:
    """All files as one table with a column per channel."""
    return read_logger_wide(spark, path, channels)


def resampled_wide(merged: DataFrame, period: str = "10min") -> DataFrame:
    """One gapless grid for all channels of a merged table."""
    channels = [name for name in merged.columns if name != "date_time"]
    return resample_grid(merged, "date_time", channels, period)


def resampled_long(spark: SparkSession, path: str, period: str = "10min") -> DataFrame:
    """(channel, date_time, value) with a grid per channel; needs no list of channels."""
    cells = read_logger_long(spark, path).withColumn("value", F.col("value").try_cast("double"))
    return resample_grid(cells, "date_time", ["value"], period, ["channel"])


def read_merged(spark: SparkSession, path: str, channels: Sequence[str]) -> DataFrame:
    """A merged table that was written earlier; unreadable times are dropped."""
    columns = ", ".join(f"`{name}` double" for name in channels)
    merged = spark.read.schema(f"date_time string, {columns}").option("header", True).csv(path)
    return drop_null_keys(merged.withColumn("date_time", F.col("date_time").try_cast("timestamp")), ["date_time"])


def merge_and_resample(
    spark: SparkSession, path: str, channels: Sequence[str], merged_path: str, resampled_path: str,
    period: str = "10min",
) -> None:
    """Write the merged table, then the resampled one from it, so the source files are parsed once."""
    overwrite_csv(merged_wide(spark, path, channels), merged_path)
    overwrite_csv(resampled_wide(read_merged(spark, merged_path, channels), period), resampled_path)
