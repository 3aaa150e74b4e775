"""Appending frames, ordering and limits."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, functions as F


def append_by_name(*frames: DataFrame) -> DataFrame:
    """Rows of all frames; a column that a frame lacks is NULL there."""
    return reduce(lambda left, right: left.unionByName(right, allowMissingColumns=True), frames)


def newest_first(df: DataFrame, timestamp: str, tie_break: Sequence[str] = ()) -> DataFrame:
    """Descending by time.  Tie-break columns also spread many rows of one instant over tasks."""
    return df.orderBy(F.desc(timestamp), *tie_break)


def newest(df: DataFrame, count: int, timestamp: str, tie_break: Sequence[str]) -> DataFrame:
    """The newest rows, each task keeping only its own best ``count``."""
    return newest_first(df, timestamp, tie_break).limit(count)


def any_rows(df: DataFrame, count: int) -> DataFrame:
    """Some rows, in no order."""
    return df.limit(count)


def distinct_rows(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.select(*columns).distinct()
