"""CSV history files and logger files."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from sensorloom.functions.temporal import lenient_day_first
from sensorloom.functions.text import remove_quotes
from sensorloom.operators.clean import REJECT, split_rejects, with_reject_reason

LOGGER_SEPARATOR = ";"
DATE_COLUMN = "DATE"
TIME_COLUMN = "TIME"


def read_history(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame:
    """Comma-separated files that all have the header of ``schema``."""
    return spark.read.schema(schema).option("header", True).option("enforceSchema", False).csv(path)


def _cells(text: str) -> Column:
    """Cells of a logger line.  Quotes are removed first; ``\\;`` is a semicolon inside a cell."""
    line = remove_quotes(F.col(text))
    escaped = F.transform(
        F.split(line, rf"(?<!\\){LOGGER_SEPARATOR}"), lambda part: F.regexp_replace(part, r"\\(.)", "$1"))
    return F.when(F.contains(line, F.lit("\\")), escaped).otherwise(F.split(line, LOGGER_SEPARATOR))


def _cell(name: str) -> Column:
    """The cell under a header, NULL where the file or the line lacks it."""
    place = F.nullif(F.array_position("header", name), F.lit(0))
    return F.get(F.col("cells"), (place - 1).cast("int"))


def _logger_lines(spark: SparkSession, path: str) -> DataFrame:
    return (
        spark.read.text(path)
        .select(F.col("_metadata.file_path").alias("file"), F.col("value").alias("_line"))
        .filter(F.trim("_line") != "")
        .select("file", _cells("_line").alias("cells"))
    )


def read_logger_lines(spark: SparkSession, path: str) -> DataFrame:
    """(file, header cells, line cells) of semicolon files whose headers may differ per file.

    The reader of Spark would take the header of one file for all.  Here each line is paired with
    the header of its own file; the headers are one row per file.  Lines of files without a header, or
    with different ones, are in :func:`read_logger_rejects`.
    """
    return _with_header(_logger_lines(spark, path), _headers(spark, path))[0]


def _headers(spark: SparkSession, path: str) -> DataFrame:
    """(file, header, another header of the file).  Only lines with both names are cut into cells."""
    both = F.contains(F.col("value"), F.lit(DATE_COLUMN)) & F.contains(F.col("value"), F.lit(TIME_COLUMN))
    lines = spark.read.text(path).filter(both).select(
        F.col("_metadata.file_path").alias("file"), _cells("value").alias("cells"))
    return lines.filter(_is_header()).groupBy("file").agg(F.min("cells").alias("header"), F.max("cells").alias("_other"))


def _is_header() -> Column:
    return F.array_contains("cells", DATE_COLUMN) & F.array_contains("cells", TIME_COLUMN)


def _with_header(lines: DataFrame, headers: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Lines with the header of their file, and the lines of files without exactly one, with a reason."""
    rows = lines.filter(~_is_header()).join(headers, "file", "left")
    return split_rejects(with_reject_reason(rows, {
        "no header with date and time": F.col("header").isNull(),
        "several headers in one file": F.col("header") != F.col("_other"),
    }).drop("_other"))


def _stamped(lines: DataFrame) -> DataFrame:
    """Lines with a readable date, each parsed once: a filter of its own would parse it again."""
    parsed = lenient_day_first(_cell(DATE_COLUMN), _cell(TIME_COLUMN))
    return lines.select("*", F.explode(F.array_compact(F.array(parsed))).alias("date_time"))


def read_logger_rejects(spark: SparkSession, path: str) -> DataFrame:
    """(file, cells, reject_reason) of the lines that the other readers leave out."""
    accepted, rejected = _with_header(_logger_lines(spark, path), _headers(spark, path))
    dated = accepted.withColumn("date_time", lenient_day_first(_cell(DATE_COLUMN), _cell(TIME_COLUMN)))
    undated = split_rejects(with_reject_reason(dated, {"unreadable date": F.col("date_time").isNull()}))[1]
    columns = ["file", "cells", REJECT]
    return rejected.select(*columns).unionByName(undated.select(*columns))


def read_logger_long(spark: SparkSession, path: str) -> DataFrame:
    """(date_time, channel, value): one row per cell; rows with an unreadable date are dropped."""
    stamped = _stamped(read_logger_lines(spark, path))
    pairs = F.arrays_zip(F.col("header").alias("channel"), F.col("cells").alias("value"))
    return (
        stamped.select("date_time", F.explode(pairs).alias("_pair"))
        .select("date_time", F.col("_pair.channel").alias("channel"), F.col("_pair.value").alias("value"))
        .filter(F.col("channel").isNotNull() & ~F.col("channel").isin(DATE_COLUMN, TIME_COLUMN))
        .withColumn("value", F.nullif(F.trim("value"), F.lit("")))
    )


def read_logger_wide(spark: SparkSession, path: str, channels: Sequence[str]) -> DataFrame:
    """One row per line with a column per listed channel; a channel that the file lacks is NULL."""
    return _stamped(read_logger_lines(spark, path)).select(
        "date_time", *[_cell(name).try_cast("double").alias(name) for name in channels])


def read_logger_layout(spark: SparkSession, path: str, columns: Sequence[str]) -> DataFrame:
    """Files that share one known header: every cell as text, quotes removed.

    For archives where the layout of a folder is known, this needs no pass for the headers.
    """
    schema = T.StructType([T.StructField(name, T.StringType()) for name in columns])
    raw = (
        spark.read.schema(schema).option("sep", LOGGER_SEPARATOR).option("quote", "").option("header", True)
        .option("enforceSchema", True).csv(path)
    )
    return raw.select(*[remove_quotes(F.col(name)).alias(name) for name in columns])


def append_csv(df: DataFrame, path: str) -> None:
    """Add files to a folder, each with the header."""
    df.write.mode("append").option("header", True).csv(path)


def overwrite_csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("header", True).csv(path)
