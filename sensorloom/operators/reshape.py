"""Multi-value cells, nested lists and wide channels to rows.  All of it is narrow: no shuffle."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F, types as T

from sensorloom.functions.text import channel_number, split_any


def split_parallel(
    df: DataFrame, columns: Sequence[str], delimiters: Sequence[str], position: str | None = None
) -> DataFrame:
    """Split several cells by any delimiter and pair the parts by position, one row per position.

    The longest cell sets the number of rows; missing parts (and NULL cells) become ``''``.
    ``position`` names an extra column with the 0-based position.
    """
    if not columns:
        empty = df.filter(F.lit(False))
        return empty.withColumn(position, F.lit(0)) if position else empty
    zipped = F.arrays_zip(*[
        split_any(F.coalesce(F.col(name).cast("string"), F.lit("")), delimiters).alias(f"p{index}")
        for index, name in enumerate(columns)
    ])
    others = [name for name in df.columns if name not in columns]
    exploded = df.select(*others, F.posexplode(zipped).alias("_position", "_part"))
    field = {name: exploded["_part"].getField(f"p{index}") for index, name in enumerate(columns)}
    output = [
        F.coalesce(field[name], F.lit("")).alias(name) if name in field else F.col(name) for name in df.columns
    ]
    if position:
        output.append(F.col("_position").alias(position))
    return exploded.select(*output)


def unpivot_channels(
    df: DataFrame, ids: Sequence[str], channels: Sequence[str] | None = None,
    name: str = "aid", value: str = "value",
) -> DataFrame:
    """Wide to long; NULL values are kept."""
    chosen = list(channels) if channels is not None else [c for c in df.columns if c not in ids]
    return df.unpivot(list(ids), chosen, name, value)


def number_channels(df: DataFrame, column: str = "aid", prefix_characters: str = "AI") -> DataFrame:
    return df.withColumn(column, channel_number(F.col(column), prefix_characters))


def pivot_channels(df: DataFrame, ids: Sequence[str], name: str, value: str, channels: Sequence[str]) -> DataFrame:
    """Long to wide for a known list of channels; several values of one cell are averaged."""
    return df.groupBy(*ids).pivot(name, list(channels)).agg(F.avg(value))


def explode_children(
    df: DataFrame, array: Column | str, item: str = "item", position: str = "pos", keep_empty: bool = False
) -> DataFrame:
    """One row per list element; ``keep_empty`` keeps parents without elements."""
    explode = F.posexplode_outer if keep_empty else F.posexplode
    return df.select("*", explode(array).alias(position, item))


def zip_names_values(names: Column, values: Column) -> Column:
    """Pairs by position; values beyond the last name are ignored."""
    kept = F.slice(values, F.lit(1), F.size(names))
    return F.arrays_zip(names.alias("name"), kept.alias("value"))


def labelled_fields(labels: Mapping[str, str], payload: Column) -> Column:
    """Fixed fields of a struct as (name, value) pairs, values as text."""
    return F.array(*[
        F.struct(F.lit(label).alias("name"), payload.getField(field).cast("string").alias("value"))
        for field, label in labels.items()
    ])


def first_of(array: Column) -> Column:
    return F.get(array, F.lit(0))


def last_where(array: Column, condition: Callable[[Column], Column]) -> Column:
    """Last element that meets the condition, else NULL."""
    return F.try_element_at(F.filter(array, condition), F.lit(-1))


def flatten_nested(df: DataFrame, separator: str = ".") -> DataFrame:
    """Nested structs to top-level columns named by their path; lists stay whole."""

    def leaves(schema: T.StructType, path: tuple[str, ...]) -> list[Column]:
        found: list[Column] = []
        for field in schema.fields:
            here = (*path, field.name)
            if isinstance(field.dataType, T.StructType):
                found += leaves(field.dataType, here)
            else:
                source = F.col(".".join(f"`{part}`" for part in here))
                found.append(source.alias(separator.join(here)))
        return found

    return df.select(*leaves(df.schema, ()))
