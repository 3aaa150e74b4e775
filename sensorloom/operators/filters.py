"""Row selections."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from typing import Any

from pyspark.sql import Column, DataFrame, functions as F


def keep_network(df: DataFrame, network_id: int, column: str = "networkID") -> DataFrame:
    return df.filter(F.col(column) == network_id)


def keep_listed(df: DataFrame, column: str, listed: Sequence[Any] | DataFrame) -> DataFrame:
    """Rows whose value is listed; a list that is itself data comes as a DataFrame."""
    if isinstance(listed, DataFrame):
        key = listed.columns[0]
        return df.join(listed.select(F.col(key).alias("_listed")), F.col(column) == F.col("_listed"), "left_semi")
    return df.filter(F.col(column).isin(list(listed)))


def drop_null_keys(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.dropna(subset=list(columns))


def between_exclusive(df: DataFrame, column: str, start: Any, end: Any) -> DataFrame:
    """Both ends excluded; an end left as None is open.  The bounds are literals, so the range reaches the scan."""
    if start is not None:
        df = df.filter(F.col(column) > F.lit(start))
    return df if end is None else df.filter(F.col(column) < F.lit(end))


def matching(df: DataFrame, values: Mapping[str, Any]) -> DataFrame:
    """Equality on every given parameter; a parameter left as None is not applied."""
    for name, value in values.items():
        if value is not None:
            df = df.filter(F.col(name) == value)
    return df


def present_only(df: DataFrame, column: str) -> DataFrame:
    return df.filter(F.col(column).isNotNull())


def first_present(*columns: Column | str) -> Column:
    return F.coalesce(*columns)


def non_empty(array: Column) -> Column:
    """The list, or NULL when it is empty or absent."""
    return F.when(F.size(array) > 0, array)
