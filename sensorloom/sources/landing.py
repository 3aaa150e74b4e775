"""The landing folder: days that arrived, days that are missing, and the raw archive."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T


def read_days(spark: SparkSession, path: str, schema: T.StructType, first_day: str, end_day: str) -> DataFrame:
    """JSON documents of ``first_day <= day < end_day`` from folders named ``day=...``.

    Only the folders of the range are listed into the scan.
    """
    full = T.StructType([*schema.fields, T.StructField("day", T.DateType())])
    return spark.read.schema(full).json(path).filter(
        (F.col("day") >= F.lit(first_day).cast("date")) & (F.col("day") < F.lit(end_day).cast("date")))


def day_range(spark: SparkSession, first_day: str, end_day: str) -> DataFrame:
    """One row per day of a half-open range."""
    return spark.range(1).select(F.explode(_days(first_day, end_day)).alias("day"))


def _days(first_day: str, end_day: str) -> Column:
    start, end = F.lit(first_day).cast("date"), F.lit(end_day).cast("date")
    return F.when(end > start, F.sequence(start, F.date_sub(end, 1), F.expr("interval 1 day")))


def missing_days(landed: DataFrame, day: str, first_day: str, end_day: str, by: Sequence[str] = ()) -> DataFrame:
    """Days of the range for which nothing has landed; with ``by``, for each source that has landed at any time."""
    present = landed.select(*by, F.to_date(day).alias("day")).distinct()
    if not by:
        return day_range(landed.sparkSession, first_day, end_day).join(present, "day", "left_anti")
    wanted = present.select(*by).distinct().withColumn("day", F.explode(_days(first_day, end_day)))
    return wanted.subtract(present)


def raw_lines(spark: SparkSession, path: str, stream: bool = False) -> DataFrame:
    """Untouched payload text with its file and arrival time."""
    reader = spark.readStream if stream else spark.read
    return reader.text(path).select(
        F.col("value").alias("payload"),
        F.col("_metadata.file_path").alias("source_file"),
        F.col("_metadata.file_modification_time").alias("arrived_at"),
    )


def archive_raw(lines: DataFrame, path: str) -> None:
    """Append payload text to the archive, by day of arrival."""
    dated = lines.withColumn("day", F.to_date("arrived_at"))
    dated.hint("rebalance", "day").write.mode("append").partitionBy("day").parquet(path)
