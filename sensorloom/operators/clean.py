"""Projections that clean raw messages before they are reshaped."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from sensorloom.functions.text import drop_last, starts_with_any

# Fixed values of the particulate-matter sensor messages.
PARTICULATE_LABEL = "?g/m^3|PM1|PM2.5|PM10"
PARTICULATE_TYPE = "Micrograms|Micrograms|Micrograms"
PARTICULATE_TYPE_ALIGNED = "Micrograms|Micrograms|Micrograms|Micrograms"
PARTICULATE_ORDER = (0, 3, 1, 2)
RAW_DELIMITER = "%7c"

REJECT = "reject_reason"


def rename_columns(df: DataFrame, names: Mapping[str, str]) -> DataFrame:
    return df.withColumnsRenamed(dict(names))


def drop_columns(df: DataFrame, names: Sequence[str], strict: bool = False) -> DataFrame:
    """Drop the columns; ``strict`` refuses names that the frame lacks."""
    missing = [name for name in names if name not in df.columns]
    if strict and missing:
        raise ValueError(f"no such columns: {missing}")
    return df.drop(*names)


def cast_columns(df: DataFrame, types: Mapping[str, str], lenient: bool = False) -> DataFrame:
    """Cast columns.  Bad values fail the query, or become NULL when ``lenient``."""
    casts = {
        name: F.col(name).try_cast(target) if lenient else F.col(name).cast(target)
        for name, target in types.items()
    }
    return df.withColumns(casts)


def cast_failures(df: DataFrame, types: Mapping[str, str]) -> dict[str, Column]:
    """Reject conditions for :func:`with_reject_reason`: present, but not of the type."""
    return {
        f"{name} is not {target}": F.col(name).isNotNull() & F.col(name).try_cast(target).isNull()
        for name, target in types.items() if name in df.columns
    }


def flag_words_to_boolean(df: DataFrame, column: str) -> DataFrame:
    """Words ``True`` / ``False`` -> boolean; a frame without the column is returned as it is."""
    if column not in df.columns:
        return df
    words = F.col(column).cast("string")
    flag = (
        F.when(words == "True", F.lit(True))
        .when(words == "False", F.lit(False))
        .otherwise(words.try_cast("boolean"))
    )
    return df.withColumn(column, flag)


def flag_word_unknown(column: str) -> Column:
    """True for words that are no flag, which would become NULL."""
    words = F.col(column).cast("string")
    return words.isNotNull() & ~words.isin("True", "False") & words.try_cast("boolean").isNull()


def trim_suffix_by_prefix(
    df: DataFrame, prefixes: Sequence[str], name: str = "sensorName", value: str = "rawData", count: int = 4
) -> DataFrame:
    """Cut the last characters of ``value`` where ``name`` begins with a listed prefix."""
    trimmed = F.coalesce(drop_last(F.col(value).cast("string"), count), F.lit(""))
    matches = F.coalesce(starts_with_any(F.col(name), prefixes), F.lit(False))
    return df.withColumn(value, F.when(matches, trimmed).otherwise(F.col(value)))


def particulate_too_short(label: str = "plotLabels", raw: str = "rawData") -> Column:
    """Particulate rows that lack a value to reorder."""
    parts = F.size(F.split(F.coalesce(F.col(raw), F.lit("")), RAW_DELIMITER))
    needed = len(PARTICULATE_ORDER) - 1
    return F.coalesce((F.col(label) == PARTICULATE_LABEL) & (parts < needed), F.lit(False))


def align_particulate(
    df: DataFrame, label: str = "plotLabels", raw: str = "rawData", value: str = "dataValue", kind: str = "dataType"
) -> DataFrame:
    """Make the four cells of particulate rows line up by position.

    Both value cells get a leading 0, the raw parts are put in label order, and a three-part type
    cell gets a fourth part (the last for any row with that type).
    """
    chosen = F.col(label) == PARTICULATE_LABEL
    parts = F.split(F.concat(F.lit("0" + RAW_DELIMITER), F.col(raw)), RAW_DELIMITER)
    reordered = F.concat_ws(RAW_DELIMITER, *[F.get(parts, F.lit(index)) for index in PARTICULATE_ORDER])
    return df.withColumns({
        raw: F.when(chosen, reordered).otherwise(F.col(raw)),
        value: F.when(chosen, F.concat(F.lit("0|"), F.col(value))).otherwise(F.col(value)),
        kind: F.when(F.col(kind) == PARTICULATE_TYPE, F.lit(PARTICULATE_TYPE_ALIGNED)).otherwise(F.col(kind)),
    })


def overlay(base: DataFrame, over: DataFrame, keys: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """Values of ``over`` win where they are not NULL; ``over`` has one row per key."""
    patch = over.select(*keys, *[F.col(name).alias(f"_over_{name}") for name in columns])
    joined = base.join(patch, list(keys), "left")
    return joined.select(*[
        F.coalesce(F.col(f"_over_{name}"), F.col(name)).alias(name) if name in columns else F.col(name)
        for name in base.columns
    ])


def with_reject_reason(df: DataFrame, reasons: Mapping[str, Column]) -> DataFrame:
    """Add ``reject_reason``: the first reason that holds, else NULL."""
    return df.withColumn(REJECT, F.coalesce(*[F.when(cond, F.lit(reason)) for reason, cond in reasons.items()]))


def split_rejects(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(accepted rows, rejected rows with their reason)."""
    return df.filter(F.col(REJECT).isNull()).drop(REJECT), df.filter(F.col(REJECT).isNotNull())
