"""Dimension conformance with deterministic ids, and fact rows that carry them.

The id of a dimension row is computed from its natural key, so facts get it without a join and a
replayed batch finds its rows already there.  The first write of a natural key wins: later
attribute changes are ignored.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from sensorloom.functions.keys import surrogate_key

#: Types that a hash aggregate can keep the least value of.
FIXED_WIDTH = (
    T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType, T.DoubleType, T.DateType, T.TimestampType, T.TimestampNTZType)


def first_per_key(
    df: DataFrame, keys: Sequence[str], attributes: Sequence[str] = (), order_by: Sequence[str] = ()
) -> DataFrame:
    """Distinct natural keys with the attributes of their earliest row.

    A hash aggregate of the first order column, if it has a fixed width, first finds the earliest instant of each
    key; only the rows of that instant are sorted.  In that, each task keeps one row per key before the
    shuffle, so a key that holds most of the rows costs one row per task.  Equal order values are resolved
    by the smallest attributes; NULL order values come last.
    """
    if not attributes:
        return df.select(*keys).distinct()
    rows = df.select(*dict.fromkeys([*keys, *attributes, *order_by]))
    if order_by and isinstance(df.schema[order_by[0]].dataType, FIXED_WIDTH):
        rows = _earliest(rows, keys, order_by[0])
    order = [*[F.col(name).asc_nulls_last() for name in order_by], *attributes]
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return rows.withColumn("_rank", rank).filter("_rank = 1").select(*keys, *attributes)


def _earliest(df: DataFrame, keys: Sequence[str], at: str) -> DataFrame:
    """The rows at the smallest value of each key."""
    first = df.groupBy(*keys).agg(F.min(at).alias("_first_at")).select(
        *[F.col(key).alias(f"_first_{index}") for index, key in enumerate(keys)], "_first_at")
    same = [F.col(key).eqNullSafe(F.col(f"_first_{index}")) for index, key in enumerate(keys)]
    return df.join(first, [*same, F.col(at).eqNullSafe(F.col("_first_at"))], "left_semi")


def absent_from(df: DataFrame, existing: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows whose key does not exist yet; a NULL key part equals another NULL."""
    known = existing.select(*[F.col(key).alias(f"_known_{key}") for key in keys])
    return df.join(known, [F.col(key).eqNullSafe(F.col(f"_known_{key}")) for key in keys], "left_anti")


def new_dimension_rows(
    batch: DataFrame,
    existing: DataFrame | None,
    natural_key: Sequence[str],
    attributes: Sequence[str] = (),
    order_by: Sequence[str] = (),
    id_column: str | None = None,
    tag: str = "",
) -> DataFrame:
    """Rows of the batch that the dimension lacks, with their ids.

    ``id_column`` is None for dimensions whose natural key is their id.
    """
    rows = first_per_key(batch, natural_key, attributes, order_by)
    if existing is not None:
        rows = absent_from(rows, existing, natural_key)
    if id_column is None:
        return rows
    return rows.select(surrogate_key(tag, *natural_key).alias(id_column), "*")


def get_or_create(
    batch: DataFrame,
    existing: DataFrame,
    natural_key: Sequence[str],
    attributes: Sequence[str] = (),
    order_by: Sequence[str] = (),
    id_column: str | None = None,
    tag: str = "",
) -> DataFrame:
    """The dimension after the batch: existing rows, then the new ones."""
    fresh = new_dimension_rows(batch, existing, natural_key, attributes, order_by, id_column, tag)
    return existing.unionByName(fresh)


def with_id(df: DataFrame, id_column: str, tag: str, parts: Sequence[Column | str]) -> DataFrame:
    """Add a generated id."""
    return df.withColumn(id_column, surrogate_key(tag, *parts))


def child_rows(df: DataFrame, *columns: Column | str, present: str | None = None) -> DataFrame:
    """Child rows taken from the parent's frame; ``present`` skips parents that lack the value."""
    rows = df if present is None else df.filter(F.col(present).isNotNull())
    return rows.select(*columns)
