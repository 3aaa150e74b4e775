"""Duplicate removal and its cascade to child tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window, functions as F


def drop_identical(df: DataFrame, keys: Sequence[str] | None = None) -> DataFrame:
    """For rows with deterministic ids, where copies are equal in every column.

    ``keys`` are columns that already tell rows apart; of rows that differ elsewhere all the same, the
    smallest stays.  Each task drops its own copies before the shuffle.  Without keys all columns are
    compared, which is a plain distinct.
    """
    if not keys or set(keys) == set(df.columns):
        return df.distinct()
    return keep_one_per_key(df, keys, [name for name in df.columns if name not in keys])


def keep_one_per_key(df: DataFrame, keys: Sequence[str], tie_break: Sequence[str]) -> DataFrame:
    """For rows with random ids: of each group of copies the row first by ``tie_break``.

    NULL key values are equal.  The rank limit is applied inside each task before the shuffle, so a
    huge group of copies sends one row per task.
    """
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*tie_break))
    return df.withColumn("_rank", rank).filter("_rank = 1").drop("_rank")


def copies_per_key(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that occur more than once, with the number of surplus rows."""
    return df.groupBy(*keys).agg((F.count("*") - 1).alias("surplus")).filter("surplus > 0")


def cascade(children: DataFrame, survivors: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Child rows whose parent survived."""
    return children.join(survivors.select(*keys), list(keys), "left_semi")
