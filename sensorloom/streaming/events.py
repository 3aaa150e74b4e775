"""Duplicate removal and resampling on a stream.

Rows later than ``delay`` behind the newest one are dropped here.  The raw archive keeps them, and
the batch operators over it give the complete result.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F
from pyspark.sql.streaming import StreamingQuery

from sensorloom.functions.temporal import seconds_of
from sensorloom.streaming.ingest import trigger_options


def with_event_time(df: DataFrame, timestamp: str, delay: str) -> DataFrame:
    """Watermarks need a timestamp with a zone."""
    return df.withColumn(timestamp, F.col(timestamp).cast("timestamp")).withWatermark(timestamp, delay)


def dedupe_stream(df: DataFrame, keys: Sequence[str], timestamp: str, delay: str = "1 hour") -> DataFrame:
    """First arrival of each key within the delay."""
    return with_event_time(df, timestamp, delay).dropDuplicatesWithinWatermark(list(keys))


def resample_stream(
    df: DataFrame, timestamp: str, values: Sequence[str], period: str | int = "10min", by: Sequence[str] = (),
    delay: str = "1 hour",
) -> DataFrame:
    """Mean per series and bin, emitted when the bin can no longer change.

    The period must divide a day: other bins depend on the first day of a series.
    """
    seconds = seconds_of(period)
    if 86_400 % seconds:
        raise ValueError("a streamed period must divide a day")
    means = [
        F.avg(F.nanvl(F.col(name).cast("double"), F.lit(None).cast("double"))).alias(name) for name in values]
    return (
        with_event_time(df, timestamp, delay)
        .groupBy(*by, F.window(timestamp, f"{seconds} seconds").alias("_bin")).agg(*means)
        .select(*by, F.col("_bin.start").alias(timestamp), F.col("_bin.end").alias("bin_end"), *values)
    )


def append_parquet(df: DataFrame, path: str, checkpoint: str, period: str | None = None) -> StreamingQuery:
    """Write a stream to a Parquet folder; the checkpoint records how far it got."""
    return (
        df.writeStream.format("parquet").outputMode("append").option("path", path)
        .option("checkpointLocation", checkpoint).trigger(**trigger_options(period)).start()
    )
